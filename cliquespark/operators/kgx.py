"""Export of cliques as nodes and edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cliquespark.functions.exprs import edge_md5
from cliquespark.operators.index import ancestors_or_fallback


def kgx_nodes(cliques: DataFrame, type_ancestors: DataFrame) -> DataFrame:
    """A node per identifier: ``id, name, category, equivalent_identifiers``."""
    typed = cliques.join(type_ancestors, "type", "left").withColumn("category", ancestors_or_fallback(F.col("type"), F.col("ancestors")))
    return typed.select(F.explode("identifiers").alias("x"), "category", F.transform("identifiers", lambda x: x["i"]).alias("equivalent_identifiers")).select(
        F.col("x.i").alias("id"), F.coalesce("x.l", F.lit("")).alias("name"), "category", "equivalent_identifiers"
    )


def kgx_edges(cliques: DataFrame) -> DataFrame:
    """A ``same_as`` edge per pair inside a clique, in order of position.

    No join: first the members are exploded and then what follows each of them, so that not even a
    large clique's pairs are ever in one row.
    """
    ids = cliques.filter(F.size("identifiers") > 1).select("file", F.transform("identifiers", lambda x: x["i"]).alias("ids"))
    firsts = ids.select("file", "ids", F.posexplode("ids").alias("k", "subject")).filter("k + 1 < size(ids)")
    found = firsts.select("file", "subject", F.explode(F.slice("ids", F.col("k") + 2, F.size("ids"))).alias("object"))
    return found.select(edge_md5("subject", "object", "file").alias("id"), "subject", F.lit("biolink:same_as").alias("predicate"), "object")


def export_kgx(cliques: DataFrame, type_ancestors: DataFrame, folder: str) -> None:
    kgx_nodes(cliques, type_ancestors).write.mode("overwrite").json(f"{folder}/nodes")
    kgx_edges(cliques).write.mode("overwrite").json(f"{folder}/edges")
