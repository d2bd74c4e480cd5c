"""Compendia, conflations, graphs and source lists derived from order-processing tables.

The derivation is deterministic and is written once here and once in SQL (``catalog_queries``), so
that every operator can be compared with a SQL engine at any scale.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cliquespark.operators.graph import ATTRIBUTES
from cliquespark.operators.index import build_index
from cliquespark.plans.schema import Config, Index
from cliquespark.sources.scan import keyed_conflation
from cliquespark.sources.sinks import read_index, write_index
from cliquespark.sources.tables import shared_path

#: The derived model's own conflations; no boosted prefixes.
CONFIG = Config(boost_prefixes={}, conflations=("A", "B"), named_thing="cat:NamedThing", entity="cat:Entity")
BOOSTED = Config(boost_prefixes={"cat:Party": ("ACCT",)}, demote_labels_longer_than=100, conflations=("A", "B"), named_thing="cat:NamedThing", entity="cat:Entity")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def curie(prefix: str, key) -> F.Column:
    return F.concat(F.lit(f"{prefix}:"), (F.col(key) if isinstance(key, str) else key).cast("string"))


def identifier(i, label=None, description=None) -> F.Column:
    described = F.lit(None) if description is None else F.array(description)
    return F.struct(i.alias("i"), (label if label is not None else F.lit(None)).cast("string").alias("l"), described.cast("array<string>").alias("d"))


def compendium(spark: SparkSession, sf_dir: str) -> DataFrame:
    part, supplier, customer = (table(spark, sf_dir, t) for t in ("part", "supplier", "customer"))
    k = F.col("p_partkey")
    parts = part.select(
        F.lit("part").alias("file"), F.lit(0).alias("file_idx"), k.alias("line_no"), F.concat(F.lit("cat:"), "p_type").alias("type"), F.when(k % 4 != 0, F.col("p_size")).cast("string").alias("ic"),
        F.array(identifier(curie("PART", k), F.col("p_name")), identifier(curie("SKU", k)), identifier(curie("CHEMBL.COMPOUND", k), F.concat(F.lit("CHEMBL"), k.cast("string")))).alias("identifiers"),
    )
    s = F.col("s_suppkey")
    suppliers = supplier.select(
        F.lit("supplier").alias("file"), F.lit(1).alias("file_idx"), s.alias("line_no"), F.lit("cat:Supplier").alias("type"), F.lit(None).cast("string").alias("ic"),
        F.array(identifier(curie("SUPP", s), F.col("s_name")), identifier(curie("VEND", s), description=F.concat(F.lit("vendor "), s.cast("string")))).alias("identifiers"),
    )
    c = F.col("c_custkey")
    two = F.array(identifier(curie("CUST", c), F.col("c_name")), identifier(curie("ACCT", c), F.col("c_mktsegment")))
    customers = customer.select(
        F.lit("customer").alias("file"), F.lit(2).alias("file_idx"), c.alias("line_no"), F.lit("cat:Customer").alias("type"), F.lit(None).cast("string").alias("ic"),
        F.when(c < 50, F.concat(two, F.array(identifier(curie("VEND", c))))).otherwise(two).alias("identifiers"),
    )
    return parts.unionByName(suppliers).unionByName(customers)


def type_ancestors(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = F.concat(F.lit("cat:"), "p_type")
    parts = table(spark, sf_dir, "part").select(own.alias("type")).distinct().withColumn("ancestors", F.array("type", *map(F.lit, ("cat:Part", "cat:Product", "cat:NamedThing"))))
    parties = spark.createDataFrame([(t, [t, "cat:Party", "cat:NamedThing"]) for t in ("cat:Supplier", "cat:Customer")], "type string, ancestors array<string>")
    return parts.unionByName(parties)


def conflation(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("k"))
    supplier = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("k"))
    a = part.join(supplier, "k").select(F.lit("A").alias("name"), F.col("k").alias("at"), F.array(curie("PART", "k"), curie("SUPP", "k")).alias("members"))
    even = part.filter("k % 2 = 0").join(part.select((F.col("k") - 1).alias("k")), "k")
    b = even.select(F.lit("B").alias("name"), F.col("k").alias("at"), F.array(curie("PART", "k"), curie("PART", F.col("k") + 1)).alias("members"))
    return keyed_conflation(a.unionByName(b))


def built_index(spark: SparkSession, sf_dir: str) -> Index:
    return build_index(compendium(spark, sf_dir), conflation(spark, sf_dir), type_ancestors(spark, sf_dir))


_STORED: dict[tuple[str, str], str] = {}


def index(spark: SparkSession, sf_dir: str) -> Index:
    """The index as a service has it: written once by the session, read by every lookup."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _STORED:
        folder = shared_path(spark, "index")
        write_index(built_index(spark, sf_dir), folder)
        _STORED[key] = folder
    return read_index(spark, _STORED[key])


def all_identifiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every identifier of the compendia in lower case, and a hundred unknown ones."""
    known = compendium(spark, sf_dir).select(F.explode("identifiers").alias("x")).select(F.lower("x.i").alias("curie"))
    return known.unionByName(spark.range(100).select(curie("UNKNOWN", "id").alias("curie"))).distinct()


def line_identifiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(F.concat(F.lit("sku:"), F.col("l_partkey").cast("string")).alias("curie"))


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus").distinct()
    subject = F.when(F.col("l_linenumber") % 2 == 0, curie("VEND", "l_suppkey")).otherwise(curie("SUPP", "l_suppkey"))
    object_ = F.when(F.col("l_linenumber") % 3 == 0, curie("SKU", "l_partkey")).otherwise(curie("PART", "l_partkey"))
    status = F.create_map(F.lit("attribute_type_id"), F.lit('"status"'), F.lit("value"), F.concat(F.lit('"'), "l_linestatus", F.lit('"')))
    edge_id = F.concat_ws("-", *[F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus")])
    return line.select(
        (F.col("l_orderkey") % 4).cast("string").alias("msg_id"), edge_id.alias("pos"), edge_id.alias("edge_id"), subject.alias("subject"), F.col("l_returnflag").alias("predicate"), object_.alias("object"),
        F.array(status).cast(ATTRIBUTES).alias("attributes"), F.lit(None).cast("string").alias("rest"),
    )


def nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The end points of the edges; the identifier orders them."""
    e = edges(spark, sf_dir)
    ends = e.select("msg_id", F.explode(F.array("subject", "object")).alias("node_id")).distinct()
    note = F.create_map(F.lit("attribute_type_id"), F.lit('"note"'), F.lit("value"), F.concat(F.lit('"'), "node_id", F.lit('"')))
    return ends.select("msg_id", F.col("node_id").alias("pos"), "node_id", F.lit(None).cast("string").alias("name"), F.array(F.lit("cat:NamedThing")).alias("categories"), F.array(note).cast(ATTRIBUTES).alias("attributes"))


def query_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A query node per order with the suppliers and parts of its lines."""
    e = edges(spark, sf_dir).select("msg_id", F.split("edge_id", "-")[0].alias("code"), F.explode(F.array("subject", "object")).alias("id"))
    return e.groupBy("msg_id", "code").agg(F.collect_set("id").alias("ids")).withColumn("rest", F.lit(None).cast("string"))


def bindings(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """A result per order: nodes ``s`` and ``o`` are the lines' ends, edges ``e`` the lines."""
    e = edges(spark, sf_dir)
    order = F.split("edge_id", "-")[0].cast("long")
    base = e.select("msg_id", order.alias("result_pos"), "edge_id", "subject", "object")
    node = base.select("msg_id", "result_pos", F.posexplode(F.array(F.struct(F.lit("s").alias("code"), F.col("subject").alias("id")), F.struct(F.lit("o").alias("code"), F.col("object").alias("id")))).alias("code_pos", "x"), F.col("edge_id").alias("bind_pos"))
    node = node.select("msg_id", "result_pos", "code_pos", "x.code", "bind_pos", "x.id", F.lit(None).cast(ATTRIBUTES).alias("attributes"), F.lit(None).cast("string").alias("rest"))
    edge = base.select("msg_id", "result_pos", F.lit(0).alias("analysis_pos"), F.lit(0).alias("code_pos"), F.lit("e").alias("code"), F.col("edge_id").alias("bind_pos"), F.col("edge_id").alias("id"), F.lit(None).cast("string").alias("rest"))
    return node, edge


def sets(spark: SparkSession, sf_dir: str, conflations: list[str]) -> DataFrame:
    """The parts of each order."""
    line = table(spark, sf_dir, "lineitem")
    return line.groupBy(F.col("l_orderkey").alias("key")).agg(F.collect_list(curie("SKU", "l_partkey")).alias("curies")).withColumn("conflations", F.array(*map(F.lit, conflations)).cast("array<string>"))


def merge_sources(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    part = table(spark, sf_dir, "part").withColumn("k", F.col("p_partkey"))
    item = lambda prefix, label: F.struct(curie(prefix, "k").alias("identifier"), F.col(label).alias("label"))
    five = F.col("k") % 5 == 0
    a = part.filter("k % 3 <> 0").select(
        curie("PART", "k").alias("entity_id"), F.col("p_name").alias("label"), F.array(F.when(five, F.lit("biolink:GeneFamily")).otherwise(F.lit("biolink:ChemicalEntity")), F.lit("biolink:NamedThing")).alias("types"), F.array(item("PART", "p_name"), item("SKU", "p_name")).alias("equivalents")
    )
    two = F.array(item("PART", "p_brand"), item("MFG", "p_brand"))
    b = part.filter("k % 2 = 0").select(
        curie("PART", "k").alias("entity_id"), F.col("p_brand").alias("label"), F.array(F.when(five, F.lit("biolink:Protein")).otherwise(F.lit("biolink:Disease")), F.lit("biolink:NamedThing")).alias("types"),
        F.when(F.col("k") % 4 == 0, F.concat(two, F.array(item("ALT", "p_brand"), F.struct(curie("PART", F.col("k") + 2).alias("identifier"), F.col("p_brand").alias("label"))))).otherwise(two).alias("equivalents"),
    )
    return a, b


def merged_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cliquespark.operators.merge import merge_union

    return merge_union(*merge_sources(spark, sf_dir), "A", "B").withColumn("identifier", F.col("entity_id"))


def flawed_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The merged entities with missing labels, foreign types and shifted identifiers on some keys."""
    k = F.split("entity_id", ":")[1].cast("long")
    return merged_entities(spark, sf_dir).withColumns(
        {"label": F.when(k % 10 != 1, F.col("label")), "types": F.when(k % 7 == 2, F.concat("types", F.array(F.lit("thing")))).otherwise(F.col("types")), "identifier": F.when(k % 9 == 4, F.concat("entity_id", F.lit("x"))).otherwise(F.col("identifier"))}
    )


def source_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A node list with all kinds of identifiers, types and sources."""
    k, pick = F.col("p_partkey"), lambda key, *values: F.element_at(F.array(*map(F.lit, values)), (key % len(values) + 1).cast("int"))
    t = k.cast("string")
    node_id = (
        F.when(k % 13 == 0, F.concat(F.lit("http://mouse.brain-map.org/atlas/index.html#"), t)).when(k % 11 == 0, F.concat(F.lit("NCBIGene:"), t)).when(k % 7 == 0, F.concat(F.lit("mondo:"), t)).when(k % 5 == 0, F.concat(F.lit("NCBI:"), t))
        .when(k % 3 == 0, F.concat(F.lit(" C"), F.lpad(t, 7, "0"), F.lit(" "))).otherwise(t)
    )
    return table(spark, sf_dir, "part").select(
        k.alias("pos"), node_id.alias("node_id"), pick(k, "gene/protein", "disease", "drug", "Gene", "anatomy", "other").alias("node_type"), F.when(k % 8 != 0, F.col("p_name")).alias("node_name"), pick(k, "NCBI", "DrugBank", "MONDO_grouped", "XYZ", "GO").alias("node_source")
    )


def text_cliques(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of the same text as cliques whose canonical member is the smallest."""
    return table(spark, sf_dir, "documents").groupBy(F.sha2("text", 256).alias("h")).agg(F.min("doc_id").alias("canonical_id"), F.count("*").alias("n_members")).select("canonical_id", "n_members")
