"""Prefix statistics and the state of the tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cliquespark.plans.schema import Index


def merged_prefix_counts(index: Index) -> DataFrame:
    """``semantic_type, prefix, cnt`` over all files."""
    return index.prefix_counts.groupBy("semantic_type", "prefix").agg(F.sum("cnt").alias("cnt"))


def semantic_types(index: Index) -> DataFrame:
    return index.prefix_counts.select("semantic_type").distinct()


def curie_prefixes(index: Index, requested: DataFrame | None = None) -> DataFrame:
    """``semantic_type, curie_prefix`` (prefix to count, as text) for the requested types, or all; null map: not found."""
    found = merged_prefix_counts(index).groupBy("semantic_type").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("prefix", F.col("cnt").cast("string"))))).alias("curie_prefix"))
    if requested is None:
        return found
    return requested.select("semantic_type").distinct().join(found, "semantic_type", "left")


def status(index: Index) -> DataFrame:
    """Rows of each table."""
    return reduce(DataFrame.unionByName, [df.agg(F.count("*").alias("n_rows")).select(F.lit(n).alias("table_name"), "n_rows") for n, df in index.tables().items()])


def stored_sizes(index: Index) -> DataFrame:
    """Files and bytes of each table of an index that was read from files."""

    def size(name: str, df: DataFrame) -> DataFrame:
        files = df.select(F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_size").alias("s")).distinct()
        return files.agg(F.count("*").alias("n_files"), F.coalesce(F.sum("s"), F.lit(0)).alias("bytes")).select(F.lit(name).alias("table_name"), "n_files", "bytes")

    return reduce(DataFrame.unionByName, [size(n, df) for n, df in index.tables().items()])
