"""Merging two normalized sources, and statistics of the result.

Sources have ``entity_id, label, types, equivalents`` with ``equivalents`` an array of ``identifier, label``.
Results add ``sources``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cliquespark.functions.exprs import append_missing, confidence, type_priority, union_sorted

FIELDS = ("label", "types", "equivalents")


def side_by_side(a: DataFrame, b: DataFrame, how: str) -> DataFrame:
    """Both sources' entities as structs ``a`` and ``b`` joined on the entity."""
    wrap = lambda df, name: df.select("entity_id", F.struct(*FIELDS, *[c for c in ("score",) if c in df.columns]).alias(name))
    return wrap(a, "a").join(wrap(b, "b"), "entity_id", how)


def merged(joined: DataFrame, a_name: str, b_name: str) -> DataFrame:
    """The first source's entity with what the second adds."""
    both = F.col("a").isNotNull() & F.col("b").isNotNull()
    one = lambda c: F.coalesce(F.col(f"a.{c}"), F.col(f"b.{c}"))
    sources = F.when(both, F.sort_array(F.array(F.lit(a_name), F.lit(b_name)))).when(F.col("a").isNotNull(), F.array(F.lit(a_name))).otherwise(F.array(F.lit(b_name)))
    return joined.withColumns(
        {
            "label": F.when(F.col("a").isNotNull(), F.col("a.label")).otherwise(F.col("b.label")),
            "types": F.when(both, union_sorted("a.types", "b.types")).otherwise(F.sort_array(one("types"))),
            "equivalents": F.when(both, append_missing("a.equivalents", "b.equivalents")).otherwise(one("equivalents")),
            "sources": sources,
        }
    )


def merge_union(a: DataFrame, b: DataFrame, a_name: str = "PrimeKG", b_name: str = "SemMed") -> DataFrame:
    return merged(side_by_side(a, b, "full"), a_name, b_name).drop("a", "b")


def merge_intersection(a: DataFrame, b: DataFrame, a_name: str = "PrimeKG", b_name: str = "SemMed") -> DataFrame:
    return merged(side_by_side(a, b, "inner"), a_name, b_name).drop("a", "b")


def merge_confidence(a: DataFrame, b: DataFrame, weight: float = 0.6, a_name: str = "PrimeKG", b_name: str = "SemMed") -> DataFrame:
    """The second source's entity replaces the first's only with a higher score; else it is merged into it."""
    scored = lambda df, w, bonus: df.withColumn("score", confidence(F.size("equivalents"), F.size("types"), w, bonus))
    joined = merged(side_by_side(scored(a, weight, 0.1), scored(b, 1 - weight, 0.05), "full"), a_name, b_name)
    wins = F.coalesce(F.col("b.score") > F.col("a.score"), F.lit(False))
    changed = {c: F.when(wins, F.sort_array(F.col("b.types")) if c == "types" else F.col(f"b.{c}")).otherwise(F.col(c)) for c in FIELDS}
    return joined.withColumns(changed | {"confidence_score": F.when(wins, F.col("b.score")).otherwise(F.coalesce("a.score", "b.score"))}).drop("a", "b")


def merge_type_priority(sources: dict[str, DataFrame]) -> DataFrame:
    """Of each entity the source with the highest type rank, the first on a tie; all sources are named."""
    rows = [df.select("entity_id", F.lit(k).alias("ord"), F.lit(name).alias("source"), *FIELDS) for k, (name, df) in enumerate(sources.items())]
    ranked = reduce(DataFrame.unionByName, rows).withColumn("priority", type_priority("types"))
    best = F.max_by(F.struct(*FIELDS, "priority"), F.struct("priority", -F.col("ord")))
    return ranked.groupBy("entity_id").agg(best.alias("best"), F.sort_array(F.collect_set("source")).alias("sources")).select("entity_id", "best.label", F.sort_array("best.types").alias("types"), "best.equivalents", "sources", F.col("best.priority").alias("priority"))


def merge_stats(entities: DataFrame) -> DataFrame:
    """``metric, key, value``: totals, per source, per type, per base type, several sources, mean equivalents."""
    total = entities.agg(
        F.count("*").cast("double").alias("total"), F.coalesce(F.sum((F.size("sources") > 1).cast("int")), F.lit(0)).cast("double").alias("multi"), F.coalesce(F.avg(F.size("equivalents")), F.lit(0.0)).alias("avg")
    )
    head = total.select(F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.lit("").alias("key"), F.col(c).alias("value")) for m, c in (("total", "total"), ("multi_source", "multi"), ("avg_equivalents", "avg"))])).alias("x")).select("x.*")
    count = lambda df, metric: df.groupBy("key").agg(F.count("*").cast("double").alias("value")).select(F.lit(metric).alias("metric"), "key", "value")
    types = entities.select(F.explode("types").alias("key"))
    return head.unionByName(count(entities.select(F.explode("sources").alias("key")), "by_source")).unionByName(count(types, "by_type")).unionByName(count(types.select(F.substring_index("key", ":", -1).alias("key")), "by_base_type"))


def type_distribution(entities: DataFrame, top: int = 10) -> DataFrame:
    """The most frequent types; ties in order of name."""
    return entities.select(F.explode("types").alias("type")).groupBy("type").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "type").limit(top)


def source_counts(entities: DataFrame, a_name: str = "PrimeKG", b_name: str = "SemMed") -> DataFrame:
    """``only_a, only_b, both``."""
    is_ = lambda *names: F.coalesce(F.sum((F.col("sources") == F.array(*map(F.lit, sorted(names)))).cast("long")), F.lit(0))
    return entities.agg(is_(a_name).alias("only_a"), is_(b_name).alias("only_b"), is_(a_name, b_name).alias("both"))
