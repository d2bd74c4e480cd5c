"""Writers."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cliquespark.plans.schema import Index

LAYOUT = {"curie_map": ("curie_key",), "cliques": ("canonical_id",), "conflation": ("member",), "type_ancestors": ("type",), "prefix_counts": ("semantic_type", "prefix")}


def write_index(index: Index, folder: str, partitions: int | None = None, dry_run: bool = False) -> Index:
    """Tables as Parquet, ranged and sorted by lookup key so that file statistics prune; ``dry_run`` writes nothing."""
    if dry_run:
        return index
    spark = index.curie_map.sparkSession
    for name, df in index.tables().items():
        if name in ("curie_map", "cliques"):
            df = df.repartitionByRange(*([partitions] if partitions else []), *LAYOUT[name]).sortWithinPartitions(*LAYOUT[name])
        writer = df.write.mode("overwrite")
        if name == "conflation":
            writer = writer.partitionBy("name")
        writer.parquet(f"{folder}/{name}")
    return read_index(spark, folder)


def write_bucketed_index(index: Index, database: str = "default", buckets: int = 64) -> Index:
    """The two large tables as bucketed and sorted tables: lookups then join without a shuffle of the index."""
    spark = index.curie_map.sparkSession
    for name in ("curie_map", "cliques"):
        key = LAYOUT[name][0]
        index.tables()[name].write.mode("overwrite").bucketBy(buckets, key).sortBy(key).saveAsTable(f"{database}.{name}")
    return replace(index, curie_map=spark.table(f"{database}.curie_map"), cliques=spark.table(f"{database}.cliques"))


def read_index(spark: SparkSession, folder: str) -> Index:
    return Index(**{name: spark.read.parquet(f"{folder}/{name}") for name in LAYOUT})


def write_json(df: DataFrame, path: str) -> None:
    """One object per line; null fields are left out."""
    df.write.mode("overwrite").json(path)


def compendium_lines(records: DataFrame) -> DataFrame:
    """``value``: a clique per line, as the loader reads it."""
    return records.select(F.to_json(F.struct("type", "identifiers")).alias("value"))


def write_compendium(records: DataFrame, path: str) -> None:
    compendium_lines(records).write.mode("overwrite").text(path)


def normalized_csv_rows(nodes: DataFrame) -> DataFrame:
    """Flat rows with lists joined by semicolons and blanks for what is missing."""
    blank = lambda c: F.coalesce(c, F.lit(""))
    return nodes.select(
        F.col("curie").alias("input_curie"),
        blank(F.col("identifier")).alias("preferred_identifier"),
        blank(F.col("label")).alias("preferred_label"),
        blank(F.array_join("types", ";")).alias("types"),
        blank(F.array_join(F.transform("equivalent_identifiers", lambda x: x["identifier"]), ";")).alias("equivalent_identifiers"),
    )


def write_normalized_csv(nodes: DataFrame, path: str) -> None:
    normalized_csv_rows(nodes).write.mode("overwrite").csv(path, header=True)


def normalized_json_rows(nodes: DataFrame) -> DataFrame:
    """``curie`` and ``node``, the answer's JSON or null where the identifier is unknown."""
    node = F.struct(F.struct(F.col("identifier"), F.col("label"), F.col("description")).alias("id"), "equivalent_identifiers", F.col("types").alias("type"), "information_content")
    return nodes.select("curie", F.when(F.col("identifier").isNotNull(), F.to_json(node)).alias("node"))


def normalized_json_lines(nodes: DataFrame) -> DataFrame:
    """``value``: a line ``{curie: node}`` per answer, null for unknown identifiers; ``scan_normalized(lines=True)`` reads it."""
    rows = normalized_json_rows(nodes)
    return rows.select(F.concat(F.lit("{"), F.to_json(F.array("curie")).substr(F.lit(2), F.length(F.to_json(F.array("curie"))) - 2), F.lit(": "), F.coalesce("node", F.lit("null")), F.lit("}")).alias("value"))


def write_normalized_json(nodes: DataFrame, path: str) -> None:
    normalized_json_lines(nodes).write.mode("overwrite").text(path)


def write_report(report: dict[str, DataFrame], folder: str) -> None:
    """Each part of a report as JSON lines in a folder of its name."""
    for name, df in report.items():
        write_json(df, f"{folder}/{name}")
