"""Connected components of a link table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cliquespark.sources.tables import materialize


def _oriented(pairs: DataFrame) -> DataFrame:
    return pairs.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _large_star(edges: DataFrame, rows: int) -> DataFrame:
    """Link each larger neighbour of a node to the node's smallest."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = materialize(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "least", 2 * rows)
    return _oriented(both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")))


def _small_star(edges: DataFrame, rows: int) -> DataFrame:
    """Link each smaller neighbour of a node, and the node, to the smallest."""
    least = materialize(edges.groupBy("a").agg(F.min("b").alias("m")), "least", rows)
    moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return _oriented(moved.unionByName(least.select("a", F.col("m").alias("b"))))


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame, rows: int | None = None) -> DataFrame:
    """``a, b``: each node of a link other than the smallest of its component, with that smallest.

    Every step is a minimum per node, which combines before the shuffle, and an equi-join. The minima
    are written first, so that both sides of the join are read from tables and adaptive execution
    can split it where one node has most of the links. The number of rounds grows with the
    logarithm of the size. ``rows``: how many links there are at most, if known.
    """
    edges = materialize(_oriented(links), "links", rows)
    mark = _mark(edges)
    while mark[0]:
        edges = materialize(_small_star(_large_star(edges, mark[0]), mark[0]), "stars", mark[0])
        before, mark = mark, _mark(edges)
        if before == mark:
            break
    return edges
