"""Quality rules: base statistics, then divergence from language references.

Each document's histogram of character classes and its histogram of common words are
compared to the references of its language by Jensen-Shannon distance (base 2, so between 0
and 1). The references are sums over every document that passes the base rules and is plain
prose (few symbols, few capitals): class counts, and the most frequent short words of the
language with a bin for all other words. Short texts diverge by chance, so each test's
limit falls with the square root of the length, and texts below a minimum length skip it.
A document with no language is held against the nearest reference; where a language has too
little text for a reference, only the base rules decide.

DataFrame functions only. One pass over the texts writes narrow features; the references
and the verdicts come from those.

Common words are short ones by definition (``COMMON_CHARS``): function words, which tell prose from
lists and junk whatever it is about.

Defined results: a null text has no words and fails the base rules; a null language is compared to
all references; a language with too few words is not compared; without any reference (a tiny table)
only the base rules decide; of words as frequent as each other the first in code point order is
the more common, of references at equal distance the one with the smaller class distance counts; very
long texts are judged in whole; rows with a null or repeated ``doc_id`` are judged like any
other, each on its own text; other columns pass through in ``row`` whatever their names, or are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cliquespark.llm.shared import materialize, ship_package

SPACES = " \t\n\x0b\x0c\r"
SPACE_CLASS = r"[ \t\n\x0B\f\r]+"
ENDS = ".,;:!?"
LEAST_WORDS = 50
REPEAT_PERCENT = 50
#: Common words of a language: how many, and the longest that counts as one.
COMMON_WORDS = 24
COMMON_CHARS = 5
#: A language has a reference from so many words on.
REFERENCE_WORDS = 2_000
#: Plain prose, from which references are made: at most these shares of symbols and of capitals.
SYMBOL_SHARE = 0.02
CAPITAL_SHARE = 0.2
#: Limits of the distances: floor + slope / sqrt(length), and the least length for the test.
CLASS_FLOOR, CLASS_SLOPE, CLASS_LEAST_CHARS = 0.10, 4.0, 200
WORD_FLOOR, WORD_SLOPE, WORD_LEAST_WORDS = 0.12, 2.4, 50

CLASSES = ("n_lower", "n_upper", "n_digit", "n_space", "n_point", "n_bang", "n_symbols", "n_other")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, also where ``body`` uses it inside a lambda."""
    return F.transform(F.array(value), body)[0]


def count_of(text: Column, others: str) -> Column:
    """Code points that are left when ``others`` (a regular expression) is removed."""
    return F.length(F.regexp_replace(text, others, "")).cast("long")


def repeated_words(words: Column) -> Column:
    """Words inside three-word windows that occur at least twice in the text. Windows are compared by 64-bit hash."""

    def covered(grams: Column) -> Column:
        return let(
            F.sort_array(F.transform(grams, lambda g, i: F.struct(g.alias("g"), i.alias("i")))),
            lambda s: F.size(
                F.array_distinct(
                    F.flatten(
                        F.transform(
                            F.filter(s, lambda x, k: ((k > 0) & (s[F.greatest(k - 1, F.lit(0))]["g"] == x["g"])) | ((k < F.size(s) - 1) & (s[F.least(k + 1, F.size(s) - 1)]["g"] == x["g"]))),
                            lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2),
                        )
                    )
                )
            ),
        )

    hashed = F.transform(words, lambda w: F.xxhash64(w))
    grams = let(hashed, lambda h: F.transform(F.sequence(F.lit(0), F.size(h) - 3), lambda i: F.xxhash64(h[i], h[i + 1], h[i + 2])))
    count = let(grams, lambda g: F.when(F.size(F.array_distinct(g)) == F.size(g), F.lit(0)).otherwise(covered(g)))
    return F.when(F.size(words) >= 4, count).otherwise(F.lit(0)).cast("long")


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", rows: bool = False) -> DataFrame:
    """Base statistics, class counts and the short words of every whole text; ``rows``: also the whole row as one column ``row``."""
    ship_package(docs.sparkSession)
    row = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if rows else []
    base = docs.select(*row, F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("t"), F.col(lang_col).cast("string").alias("lang"))
    t = F.col("t")
    base = base.withColumns({"w": F.filter(F.split(t, SPACE_CLASS), lambda w: w != ""), "l": F.filter(F.split(t, "\n", -1), lambda x: F.btrim(x, F.lit(SPACES)) != "")})
    n_chars = F.length(t).cast("long")
    word_chars = F.length(F.array_join("w", "")).cast("long")
    short = F.filter(F.transform(F.filter("w", lambda w: F.length(w) <= COMMON_CHARS + 3), lambda w: F.lower(F.rtrim(w, F.lit(ENDS)))), lambda w: (F.length(w) > 0) & (F.length(w) <= COMMON_CHARS))
    found = base.select(
        "doc_id",
        "lang",
        F.size("w").cast("long").alias("n_words"),
        word_chars.alias("word_chars"),
        count_of(t, r"[^#*$%&|<>]+").alias("n_symbols"),
        (F.size("l") - F.size(F.array_distinct("l"))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("w")).alias("n_repeat_words"),
        n_chars.alias("n_all"),
        (n_chars - count_of(t, r"\p{Ll}+")).alias("n_lower"),
        count_of(t, r"[^\p{Lu}]+").alias("n_upper"),
        count_of(t, r"[^\p{Nd}]+").alias("n_digit"),
        (n_chars - word_chars).alias("n_space"),
        count_of(t, r"[^.,;:?'\"()\-]+").alias("n_point"),
        count_of(t, r"[^!]+").alias("n_bang"),
        short.alias("short"),
        *(["row"] if rows else []),
    )
    known = F.col("n_lower") + F.col("n_upper") + F.col("n_digit") + F.col("n_space") + F.col("n_point") + F.col("n_bang") + F.col("n_symbols")
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    return found.withColumns({"n_other": F.col("n_all") - known, "base_failed": failed})


def references(feats: DataFrame) -> DataFrame:
    """``lang, ref`` of every language with enough words: class shares, common words and their shares with the rest last."""
    plain = feats.filter(~F.col("base_failed") & F.col("lang").isNotNull() & (F.col("n_symbols") <= SYMBOL_SHARE * F.col("n_all")) & (F.col("n_upper") <= CAPITAL_SHARE * (F.col("n_lower") + F.col("n_upper"))))
    totals = plain.groupBy("lang").agg(F.sum("n_words").alias("words"), *[F.sum(c).alias(c) for c in CLASSES]).filter(F.col("words") >= REFERENCE_WORDS)
    counts = plain.select("lang", F.explode("short").alias("word")).groupBy("lang", "word").agg(F.count("*").alias("n"))
    nth = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "word"))
    common = counts.withColumn("nth", nth).filter(F.col("nth") <= COMMON_WORDS).groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("nth", "word", "n"))).alias("common"))
    made = totals.join(common, "lang", "left").withColumn("common", F.coalesce("common", F.expr("CAST(array() AS array<struct<nth: int, word: string, n: bigint>>)")))
    shares = F.transform("common", lambda x: x["n"].cast("double") / F.col("words").cast("double"))
    rest = F.lit(1.0) - F.aggregate(shares, F.lit(0.0), lambda a, x: a + x)
    total = sum((F.col(c) for c in CLASSES[1:]), F.col(CLASSES[0])).cast("double")
    classes = F.array(*[F.col(c).cast("double") / total for c in CLASSES])
    return made.select("lang", F.struct(classes.alias("classes"), F.transform("common", lambda x: x["word"]).alias("words"), F.concat(shares, F.array(rest)).alias("shares")).alias("ref"))


def distance(counts: Column, total: Column, shares: Column) -> Column:
    """Jensen-Shannon distance of a histogram from reference shares."""

    def part(p: Column, q: Column) -> Column:
        m = (p + q) / 2
        one = lambda x: F.when(x > 0, x * F.log2(x / m)).otherwise(F.lit(0.0))
        return one(p) + one(q)

    terms = F.zip_with(counts, shares, lambda c, q: part(c / total, q))
    return F.sqrt(F.greatest(F.lit(0.0), F.aggregate(terms, F.lit(0.0), lambda a, x: a + x) / 2))


def literal(reference: dict) -> Column:
    doubles = lambda xs: F.array(*[F.lit(float(x)) for x in xs])
    return F.struct(doubles(reference["classes"]).alias("classes"), F.array(*[F.lit(w) for w in reference["words"]]).cast("array<string>").alias("words"), doubles(reference["shares"]).alias("shares"))


def with_references(feats: DataFrame, refs: DataFrame) -> DataFrame | None:
    """Adds ``chosen``: the reference of a row's language or none, all of them for a row without a language. None if there are no references.

    Languages find their reference by a join of two written tables, which is sent out or split by
    measured size. All references together are a literal: one or two KB for each language that
    has one.
    """
    refs = materialize(refs, "references")
    every = [r["ref"].asDict() for r in refs.orderBy("lang").collect()]
    if not every:
        return None
    found = feats.join(refs, "lang", "left")
    return found.withColumn("chosen", F.when(F.col("lang").isNull(), F.array(*map(literal, every))).when(F.col("ref").isNotNull(), F.array("ref"))).drop("ref")


def verdicts(feats: DataFrame, refs: DataFrame) -> DataFrame:
    """Adds ``class_distance``, ``word_distance`` and ``kept``."""
    found = with_references(feats, refs)
    if found is None:
        return feats.withColumns({"class_distance": F.lit(None).cast("double"), "word_distance": F.lit(None).cast("double"), "kept": ~F.col("base_failed")})
    n_all, n_words = F.col("n_all").cast("double"), F.col("n_words").cast("double")
    classes = F.array(*[F.col(c).cast("double") for c in CLASSES])

    def word_counts(ref: Column) -> Column:
        common = F.transform(ref["words"], lambda c: (F.size("short") - F.size(F.array_remove(F.col("short"), c))).cast("double"))
        return let(common, lambda cs: F.concat(cs, F.array(n_words - F.aggregate(cs, F.lit(0.0), lambda a, x: a + x))))

    def distances(ref: Column) -> Column:
        return F.struct(distance(classes, n_all, ref["classes"]).alias("c"), distance(word_counts(ref), n_words, ref["shares"]).alias("w"))

    compared = found.withColumn("d", F.when(~F.col("base_failed"), F.transform("chosen", distances)))
    nearest = F.array_min(F.transform("d", lambda d: F.struct((d["c"] + d["w"]).alias("s"), d["c"].alias("c"), d["w"].alias("w"))))
    compared = compared.withColumn("d", nearest).withColumns({"class_distance": F.col("d.c"), "word_distance": F.col("d.w")})
    off_class = (F.col("n_all") >= CLASS_LEAST_CHARS) & (F.col("class_distance") > CLASS_FLOOR + CLASS_SLOPE / F.sqrt(n_all))
    off_words = (F.col("n_words") >= WORD_LEAST_WORDS) & (F.col("word_distance") > WORD_FLOOR + WORD_SLOPE / F.sqrt(n_words))
    return compared.drop("d", "chosen").withColumn("kept", ~F.col("base_failed") & ~F.coalesce(off_class, F.lit(False)) & ~F.coalesce(off_words, F.lit(False)))


def judge(docs: DataFrame, rows: bool = False) -> DataFrame:
    """Every document with its statistics, distances and verdict; ``rows``: and the whole row, so that a verdict needs no join to take effect."""
    feats = materialize(features(docs, rows=rows), "quality")
    return verdicts(feats, references(feats))


def quality_rows(docs: DataFrame) -> DataFrame:
    """The contract's rows."""
    return judge(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", F.round("class_distance", 6).alias("class_distance"), F.round("word_distance", 6).alias("word_distance"))
