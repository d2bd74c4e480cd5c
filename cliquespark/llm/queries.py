"""The corpus operators as registered queries, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cliquespark.llm import classifier, decontamination, language, linededup, neardup, packing, quality, secrets, tokencounts, tokenfiles
from cliquespark.llm.shared import documents


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_digests(documents(spark, sf_dir))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.line_digests(documents(spark, sf_dir))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencounts.count_tokens(documents(spark, sf_dir))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rows(documents(spark, sf_dir))


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(documents(spark, sf_dir), documents(spark, sf_dir, "benchmark"))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(documents(spark, sf_dir)).select("doc_id", "n_assign", "n_access", "n_hex", F.sha2("base", 256).alias("base_sha256"), "spans")


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.language_rows(documents(spark, sf_dir))


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenfiles.token_digests(documents(spark, sf_dir))


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.classes(documents(spark, sf_dir))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classifier.quality_scores(documents(spark, sf_dir), documents(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_line_dedup": op2_line_dedup,
    "op3_token_counts": op3_token_counts,
    "op4_quality_rules": op4_quality_rules,
    "op5_benchmark_decontamination": op5_benchmark_decontamination,
    "op6_secret_scan": op6_secret_scan,
    "op7_language_id": op7_language_id,
    "op8_token_files": op8_token_files,
    "op9_near_dedup": op9_near_dedup,
    "op10_quality_classifier": op10_quality_classifier,
}

OP2_SQL = r"""
WITH lines AS (
  SELECT doc_id, line, pos, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS line_key
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents)
), dup AS (
  SELECT line_key, min(doc_id) AS first_doc FROM lines WHERE length(line_key) >= 10 GROUP BY line_key HAVING count(DISTINCT doc_id) >= 2
), marked AS (
  SELECT l.doc_id, l.line, l.pos, coalesce(d.first_doc < l.doc_id, false) AS dropped FROM lines l LEFT JOIN dup d ON l.line_key = d.line_key
)
SELECT doc_id, count(*) AS n_lines, CAST(sum(CASE WHEN dropped THEN 1 ELSE 0 END) AS BIGINT) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

JS = "CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) ELSE 0 END + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0 END"
OP4_SQL = rf"""
WITH d AS (
  SELECT doc_id, lang, coalesce(text, '') AS t, list_filter(string_split_regex(coalesce(text, ''), '[ \t\n\x0B\f\r]+'), lambda x: x <> '') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^ \t\n\x0B\f\r]')) AS l FROM documents
), w AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM d),
g AS (SELECT doc_id, pos, word AS a, lead(word) OVER p AS b, lead(word, 2) OVER p AS c FROM w WINDOW p AS (PARTITION BY doc_id ORDER BY pos)),
r AS (SELECT doc_id, pos FROM g WHERE c IS NOT NULL QUALIFY count(*) OVER (PARTITION BY doc_id, a, b, c) > 1),
covered AS (SELECT doc_id, count(DISTINCT pos + k) AS n FROM r, (VALUES (0), (1), (2)) v(k) GROUP BY 1),
counted AS (
  SELECT d.doc_id, lang, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars, length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS n_symbols, len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words, length(t) AS n_all,
    length(t) - length(regexp_replace(t, '\p{{Ll}}+', '', 'g')) AS n_lower, length(regexp_replace(t, '[^\p{{Lu}}]+', '', 'g')) AS n_upper, length(regexp_replace(t, '[^\p{{Nd}}]+', '', 'g')) AS n_digit, length(regexp_replace(t, '[^.,;:?''"()\-]+', '', 'g')) AS n_point,
    length(regexp_replace(t, '[^!]+', '', 'g')) AS n_bang, list_filter(list_transform(list_filter(w, lambda x: length(x) <= 8), lambda x: lower(rtrim(x, '.,;:!?'))), lambda x: length(x) BETWEEN 1 AND 5) AS short
  FROM d LEFT JOIN covered ON covered.doc_id = d.doc_id
), f AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, [n_lower, n_upper, n_digit, n_all - word_chars, n_point, n_bang, n_symbols, word_chars - n_lower - n_upper - n_digit - n_point - n_bang - n_symbols] AS classes FROM counted
), plain AS (SELECT * FROM f WHERE NOT base_failed AND lang IS NOT NULL AND n_symbols <= 0.02 * n_all AND n_upper <= 0.2 * (n_lower + n_upper)),
total AS (SELECT lang, sum(n_words) AS words FROM plain GROUP BY 1 HAVING sum(n_words) >= 2000),
class_ref AS (SELECT lang, k, n / sum(n) OVER (PARTITION BY lang) AS q FROM (SELECT lang, k, CAST(sum(n) AS DOUBLE) AS n FROM (SELECT lang, unnest(classes) AS n, generate_subscripts(classes, 1) AS k FROM plain) WHERE lang IN (SELECT lang FROM total) GROUP BY ALL)),
common AS (SELECT lang, word, n FROM (SELECT lang, word, count(*) AS n FROM (SELECT lang, unnest(short) AS word FROM plain) GROUP BY ALL) WHERE lang IN (SELECT lang FROM total) QUALIFY row_number() OVER (PARTITION BY lang ORDER BY n DESC, word) <= 24),
word_ref AS (SELECT c.lang, c.word, c.n / t.words AS q FROM common c JOIN total t ON t.lang = c.lang),
pairs AS (SELECT f.doc_id, f.n_words, f.n_all, f.classes, f.short, t.lang AS ref FROM f JOIN total t ON t.lang = f.lang OR f.lang IS NULL WHERE NOT base_failed),
class_d AS (
  SELECT doc_id, ref, sqrt(greatest(0, sum({JS}) / 2)) AS c FROM (SELECT x.doc_id, x.ref, x.n / CAST(x.n_all AS DOUBLE) AS p, r.q FROM (SELECT doc_id, ref, n_all, unnest(classes) AS n, generate_subscripts(classes, 1) AS k FROM pairs) x JOIN class_ref r ON r.lang = x.ref AND r.k = x.k) GROUP BY ALL
), bins AS (
  SELECT p.doc_id, p.ref, r.word, len(list_filter(p.short, lambda x: x = r.word)) / CAST(p.n_words AS DOUBLE) AS p, r.q FROM pairs p JOIN word_ref r ON r.lang = p.ref
), all_bins AS (SELECT doc_id, ref, p, q FROM bins UNION ALL SELECT doc_id, ref, 1 - sum(p), 1 - sum(q) FROM bins GROUP BY ALL),
word_d AS (SELECT doc_id, ref, sqrt(greatest(0, sum({JS}) / 2)) AS w FROM all_bins GROUP BY ALL),
nearest AS (SELECT c.doc_id, c.c, w.w FROM class_d c JOIN word_d w ON w.doc_id = c.doc_id AND w.ref = c.ref QUALIFY row_number() OVER (PARTITION BY c.doc_id ORDER BY c.c + w.w) = 1)
SELECT f.doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
  NOT base_failed AND NOT coalesce(n_all >= 200 AND c > 0.10 + 4.0 / sqrt(n_all), false) AND NOT coalesce(n_words >= 50 AND w > 0.12 + 2.4 / sqrt(n_words), false) AS kept, round(c, 6) AS class_distance, round(w, 6) AS word_distance
FROM f LEFT JOIN nearest ON nearest.doc_id = f.doc_id
"""

ORACLE_SQL: dict[str, str] = {
    "op4_quality_rules": OP4_SQL,
    "op2_line_dedup": OP2_SQL,
}
