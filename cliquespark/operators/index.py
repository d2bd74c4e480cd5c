"""Building the lookup tables from compendia and conflations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cliquespark.functions.exprs import curie_key, prefix_of
from cliquespark.functions.rounding import rounded_ic
from cliquespark.plans.schema import NAMED_THING, Index
from cliquespark.sources.shipping import ship_package


def ordered(cliques: DataFrame) -> DataFrame:
    """Adds ``at``, the order of writing: a later line of a later file wins."""
    return cliques.withColumn("at", F.struct("file_idx", "line_no"))


def curie_map(cliques: DataFrame) -> DataFrame:
    """Each identifier's key with the canonical identifier of the clique that names it last."""
    exploded = ordered(cliques).select("at", F.col("identifiers")[0]["i"].alias("canonical_id"), F.posexplode("identifiers").alias("pos", "x"))
    keyed = exploded.select(curie_key(F.col("x.i")).alias("curie_key"), "canonical_id", F.struct("at", "pos").alias("at"))
    return keyed.groupBy("curie_key").agg(F.max_by("canonical_id", "at").alias("canonical_id"))


def clique_table(cliques: DataFrame) -> DataFrame:
    """One wide row per canonical identifier; a line without information content does not erase an earlier one's."""
    ship_package(cliques.sparkSession)
    rows = ordered(cliques).select(F.col("identifiers")[0]["i"].alias("canonical_id"), "at", "type", "ic", "identifiers")
    found = rows.groupBy("canonical_id").agg(
        F.max_by("type", "at").alias("type"), F.max_by("identifiers", "at").alias("identifiers"), F.max_by("ic", F.when(F.col("ic").isNotNull(), F.col("at"))).alias("ic_raw")
    )
    raw = F.col("ic_raw").cast("double")
    return found.select("canonical_id", "type", F.when(raw.isNotNull(), rounded_ic(raw)).alias("ic"), "ic_raw", "identifiers")


def leaf_counts(cliques: DataFrame) -> DataFrame:
    """Identifiers per file, leaf type and prefix, every occurrence counted."""
    exploded = cliques.select("file", "type", F.explode("identifiers").alias("x"))
    return exploded.groupBy("file", "type", prefix_of(F.col("x.i")).alias("prefix")).agg(F.count("*").alias("cnt"))


def prefix_counts(cliques: DataFrame, type_ancestors: DataFrame) -> DataFrame:
    """Identifiers per file, ancestor type and prefix. Leaf types are summed before they are spread over their ancestors."""
    leaves = leaf_counts(cliques).join(type_ancestors, "type", "left")
    spread = leaves.select("file", F.explode(F.coalesce("ancestors", F.array("type"))).alias("semantic_type"), "prefix", "cnt")
    return spread.groupBy("file", "semantic_type", "prefix").agg(F.sum("cnt").alias("cnt"))


def build_index(cliques: DataFrame, conflation: DataFrame, type_ancestors: DataFrame) -> Index:
    """All tables of the index from cliques (``file, file_idx, line_no, type, ic, identifiers``)."""
    return Index(curie_map(cliques), clique_table(cliques), type_ancestors, conflation, prefix_counts(cliques, type_ancestors))


def ancestors_or_fallback(type_: Column, ancestors: Column, named_thing: str = NAMED_THING) -> Column:
    """A missing type is a thing; a type without known ancestors is its own only one."""
    return F.when(type_.isNull(), F.array(F.lit(named_thing))).otherwise(F.coalesce(ancestors, F.array(type_)))
