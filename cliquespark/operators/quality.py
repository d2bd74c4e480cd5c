"""Checks and metrics of merged entities (``entity_id, identifier, label, types, equivalents, sources``)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

REQUIRED = {"id": "identifier", "equivalent_identifiers": "equivalents", "type": "types", "source_databases": "sources"}


def integrity_issues(entities: DataFrame) -> DataFrame:
    """``entity_id, rule, detail``: missing fields, malformed ids and equivalents, types outside the model."""
    rule = lambda name, bad, detail="": F.when(bad, F.struct(F.lit(name).alias("rule"), (detail if not isinstance(detail, str) else F.lit(detail)).alias("detail")))
    fixed = [rule("missing_field", F.col(c).isNull(), name) for name, c in REQUIRED.items()]
    fixed.append(rule("malformed_id", F.col("identifier").isNotNull() & F.col("label").isNull()))
    blank = F.array().cast("array<struct<rule: string, detail: string>>")
    equivalents = F.filter(F.transform("equivalents", lambda x, k: rule("malformed_equivalent", x["identifier"].isNull() | x["label"].isNull(), k.cast("string"))), lambda x: x.isNotNull())
    types = F.transform(F.filter("types", lambda t: ~F.coalesce(t.startswith("biolink:"), F.lit(False))), lambda t: F.struct(F.lit("invalid_type").alias("rule"), F.coalesce(t, F.lit("")).alias("detail")))
    issues = F.concat(F.filter(F.array(*fixed), lambda x: x.isNotNull()), F.coalesce(equivalents, blank), F.coalesce(types, blank))
    return entities.select("entity_id", F.explode(issues).alias("x")).select("entity_id", "x.*")


def consistency_issues(entities: DataFrame) -> DataFrame:
    """Entities whose key is not their identifier, or is not among their equivalents."""
    blank = F.when(F.lit(False), F.lit(""))
    wrong = F.when(F.col("entity_id") != F.col("identifier"), F.lit("key_mismatch")).otherwise(blank)
    absent = F.when(~F.array_contains(F.transform("equivalents", lambda x: x["identifier"]), F.col("entity_id")), F.lit("not_in_equivalents"))
    return entities.select("entity_id", F.explode(F.filter(F.array(wrong, absent), lambda x: x.isNotNull())).alias("rule"))


def source_type_counts(entities: DataFrame) -> DataFrame:
    return entities.select(F.explode("sources").alias("source"), "types").select("source", F.explode("types").alias("type")).groupBy("source", "type").agg(F.count("*").alias("n"))


def source_overlap(entities: DataFrame) -> DataFrame:
    """``combination, n, overlap``: sorted sources joined, and the class they count for."""
    named = entities.groupBy(F.array_join(F.sort_array("sources"), "_").alias("combination"), (F.size("sources") > 1).alias("several")).agg(F.count("*").alias("n"))
    return named.select("combination", "n", F.when(F.col("several"), F.lit("multi_source")).otherwise(F.lit("single_source")).alias("overlap"))


def duplicate_identifiers(entities: DataFrame) -> DataFrame:
    """``identifier, n_entities, distinct_entities`` of identifiers that occur more than once, as main id or equivalent."""
    main = entities.filter("identifier IS NOT NULL").select("identifier", "entity_id")
    others = entities.select(F.explode(F.transform("equivalents", lambda x: x["identifier"])).alias("identifier"), "entity_id").filter("identifier IS NOT NULL")
    counted = main.unionByName(others).groupBy("identifier", "entity_id").agg(F.count("*").alias("n"))
    return counted.groupBy("identifier").agg(F.sum("n").alias("n_entities"), F.count("*").alias("distinct_entities")).filter("n_entities > 1")


def quality_metrics(entities: DataFrame) -> DataFrame:
    """``metric, value``: counts, means, distinct types, and the share of entities whose key is their identifier."""
    n = F.count("*")
    mean = lambda c: F.coalesce(F.avg(F.size(c)), F.lit(0.0))
    row = entities.agg(
        n.cast("double").alias("total"),
        F.coalesce(F.sum((F.size("sources") > 1).cast("int")), F.lit(0)).cast("double").alias("multi_source"),
        mean("types").alias("avg_types"),
        mean("equivalents").alias("avg_equivalents"),
        F.coalesce(F.avg((F.col("entity_id") == F.col("identifier")).cast("double")), F.lit(0.0)).alias("identifier_consistency"),
    )
    names = row.columns
    flat = row.select(F.explode(F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).alias("value")) for c in names])).alias("x")).select("x.*")
    diversity = entities.select(F.explode("types").alias("t")).agg(F.countDistinct("t").cast("double").alias("value")).select(F.lit("type_diversity").alias("metric"), "value")
    return flat.unionByName(diversity)


def quality_report(entities: DataFrame) -> dict[str, DataFrame]:
    return {
        "integrity": integrity_issues(entities),
        "consistency": consistency_issues(entities),
        "source_types": source_type_counts(entities),
        "overlap": source_overlap(entities),
        "duplicates": duplicate_identifiers(entities),
        "metrics": quality_metrics(entities),
    }
