"""The graph of entities that are equivalents of each other."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cliquespark.operators.components import components
from cliquespark.sources.tables import materialize


def equivalence_edges(entities: DataFrame) -> DataFrame:
    """``a, b``: undirected edges between entities, once each, none to itself."""
    named = entities.select("entity_id", F.explode(F.transform("equivalents", lambda x: x["identifier"])).alias("other")).filter("other <> entity_id")
    known = named.join(entities.select(F.col("entity_id").alias("other")).distinct(), "other", "left_semi")
    return known.select(F.least("entity_id", "other").alias("a"), F.greatest("entity_id", "other").alias("b")).distinct()


def component_sizes(entities: DataFrame, edges: DataFrame | None = None) -> DataFrame:
    """``component, n``: the smallest entity of each component and its size, single entities included."""
    stars = components(equivalence_edges(entities) if edges is None else edges)
    named = entities.select("entity_id").distinct().join(stars.select(F.col("a").alias("entity_id"), "b"), "entity_id", "left")
    return named.groupBy(F.coalesce("b", "entity_id").alias("component")).agg(F.count("*").alias("n"))


def triangles(edges: DataFrame) -> DataFrame:
    """``v, n``: triangles through each vertex. Edges point from the end of lower degree, so hubs make few pairs."""
    degree = edges.select(F.col("a").alias("v")).unionAll(edges.select(F.col("b").alias("v"))).groupBy("v").agg(F.count("*").alias("deg"))
    both = edges.join(degree.select(F.col("v").alias("a"), F.col("deg").alias("da")), "a").join(degree.select(F.col("v").alias("b"), F.col("deg").alias("db")), "b")
    forward = (F.col("da") < F.col("db")) | ((F.col("da") == F.col("db")) & (F.col("a") < F.col("b")))
    out = both.select(F.when(forward, F.col("a")).otherwise(F.col("b")).alias("u"), F.when(forward, F.col("b")).otherwise(F.col("a")).alias("w"))
    wedges = out.alias("x").join(out.alias("y"), F.col("x.u") == F.col("y.u")).filter("x.w < y.w").select(F.col("x.u").alias("u"), F.col("x.w").alias("a"), F.col("y.w").alias("b"))
    closed = wedges.join(edges, ["a", "b"])
    return closed.select(F.explode(F.array("u", "a", "b")).alias("v")).groupBy("v").agg(F.count("*").alias("n"))


def graph_summary(entities: DataFrame) -> DataFrame:
    """``metric, value``: nodes, edges, components, and the mean clustering coefficient over all nodes, single ones included as 0."""
    entities = materialize(entities.select("entity_id", "equivalents"), "graph-entities")
    edges = materialize(equivalence_edges(entities), "graph-edges")
    degree = edges.select(F.col("a").alias("v")).unionAll(edges.select(F.col("b").alias("v"))).groupBy("v").agg(F.count("*").alias("d"))
    local = degree.join(triangles(edges), "v", "left").select("v", F.when(F.col("d") >= 2, 2.0 * F.coalesce("n", F.lit(0)) / (F.col("d") * (F.col("d") - 1))).otherwise(F.lit(0.0)).alias("c"))
    nodes = entities.select("entity_id").distinct().agg(F.count("*").cast("double").alias("value"))
    parts = {
        "nodes": nodes,
        "edges": edges.agg(F.count("*").cast("double").alias("value")),
        "components": component_sizes(entities, edges).agg(F.count("*").cast("double").alias("value")),
        "average_clustering": entities.select("entity_id").distinct().join(local, F.col("entity_id") == F.col("v"), "left").agg(F.coalesce(F.avg(F.coalesce("c", F.lit(0.0))), F.lit(0.0)).alias("value")),
    }
    out = None
    for name, df in parts.items():
        row = df.select(F.lit(name).alias("metric"), "value")
        out = row if out is None else out.unionByName(row)
    return out


def graph_tables(entities: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Vertices ``id, entity_id, label`` with numbers of their own, and edges ``source, target`` between these numbers."""
    names = entities.groupBy("entity_id").agg(F.min("label").alias("label"))
    vertices = materialize(names.select(F.monotonically_increasing_id().alias("id"), "entity_id", "label"), "graph-vertices")
    named = lambda a, b: vertices.select(F.col("entity_id").alias(a), F.col("id").alias(b))
    edges = equivalence_edges(entities).join(named("a", "source"), "a").join(named("b", "target"), "b")
    return vertices, edges.select("source", "target")


def gml_lines(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """``part, value``: the graph as GML text, one vertex or edge a line; ``part`` orders head, vertices, edges and end."""
    spark = vertices.sparkSession
    quoted = lambda c: F.concat(F.lit('"'), F.regexp_replace(F.regexp_replace(F.coalesce(c, F.lit("")), "&", "&amp;"), '"', "&quot;"), F.lit('"'))
    ends = spark.createDataFrame([(0, "graph ["), (3, "]")], "part int, value string")
    nodes = vertices.select(F.lit(1).alias("part"), F.concat(F.lit("  node [ id "), F.col("id").cast("string"), F.lit(" label "), quoted(F.col("entity_id")), F.lit(" name "), quoted(F.col("label")), F.lit(" ]")).alias("value"))
    links = edges.select(F.lit(2).alias("part"), F.concat(F.lit("  edge [ source "), F.col("source").cast("string"), F.lit(" target "), F.col("target").cast("string"), F.lit(" ]")).alias("value"))
    return ends.unionByName(nodes).unionByName(links)


def write_gml(entities: DataFrame, folder: str) -> None:
    """Text files whose concatenation in order of their names is a GML graph."""
    lines = gml_lines(*graph_tables(entities))
    lines.repartitionByRange("part", "value").sortWithinPartitions("part", "value").select("value").write.mode("overwrite").text(folder)
