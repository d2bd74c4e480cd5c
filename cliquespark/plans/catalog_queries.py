"""The normalization operators as registered queries with the equivalent SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cliquespark.functions import exprs as X
from cliquespark.operators import eqgraph, graph, kgx, mappers, merge, normalize, prefixes, quality, setid
from cliquespark.plans import catalog
from cliquespark.sources import sinks

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}

# ---- the derivation in SQL -------------------------------------------------------------------------------------
BASE = """
ids AS (
  SELECT 0 AS file_idx, 'part' AS file, p_partkey AS line_no, 0 AS pos, 'PART:' || p_partkey AS i, p_name AS l, 'cat:' || p_type AS type, CASE WHEN p_partkey % 4 <> 0 THEN p_size END AS ic, 'PART:' || p_partkey AS canonical_id FROM part
  UNION ALL SELECT 0, 'part', p_partkey, 1, 'SKU:' || p_partkey, NULL, 'cat:' || p_type, NULL, 'PART:' || p_partkey FROM part
  UNION ALL SELECT 0, 'part', p_partkey, 2, 'CHEMBL.COMPOUND:' || p_partkey, 'CHEMBL' || p_partkey, 'cat:' || p_type, NULL, 'PART:' || p_partkey FROM part
  UNION ALL SELECT 1, 'supplier', s_suppkey, 0, 'SUPP:' || s_suppkey, s_name, 'cat:Supplier', NULL, 'SUPP:' || s_suppkey FROM supplier
  UNION ALL SELECT 1, 'supplier', s_suppkey, 1, 'VEND:' || s_suppkey, NULL, 'cat:Supplier', NULL, 'SUPP:' || s_suppkey FROM supplier
  UNION ALL SELECT 2, 'customer', c_custkey, 0, 'CUST:' || c_custkey, c_name, 'cat:Customer', NULL, 'CUST:' || c_custkey FROM customer
  UNION ALL SELECT 2, 'customer', c_custkey, 1, 'ACCT:' || c_custkey, c_mktsegment, 'cat:Customer', NULL, 'CUST:' || c_custkey FROM customer
  UNION ALL SELECT 2, 'customer', c_custkey, 2, 'VEND:' || c_custkey, NULL, 'cat:Customer', NULL, 'CUST:' || c_custkey FROM customer WHERE c_custkey < 50
),
curie_map AS (SELECT upper(i) AS curie_key, arg_max(canonical_id, (file_idx, line_no, pos)) AS canonical_id FROM ids GROUP BY 1),
anc AS (
  SELECT DISTINCT 'cat:' || p_type AS type, unnest(['cat:' || p_type, 'cat:Part', 'cat:Product', 'cat:NamedThing']) AS a, unnest([1, 2, 3, 4]) AS n FROM part
  UNION ALL SELECT t, unnest([t, 'cat:Party', 'cat:NamedThing']), unnest([1, 2, 3]) FROM (VALUES ('cat:Supplier'), ('cat:Customer')) v(t)
),
types AS (SELECT type, string_agg(a, '|' ORDER BY n) AS types FROM anc GROUP BY type),
clique AS (
  SELECT canonical_id, min(type) AS type, max(ic) AS ic, count(*) AS n_equiv, string_agg(i, '|' ORDER BY pos) AS equivalents,
    coalesce(arg_min(l, pos) FILTER (WHERE l <> '' AND NOT starts_with(l, 'CHEMBL') AND length(l) <= 15), arg_min(l, pos) FILTER (WHERE l <> '' AND NOT starts_with(l, 'CHEMBL'))) AS label
  FROM ids GROUP BY canonical_id
),
asked AS (SELECT DISTINCT lower(i) AS curie FROM ids UNION SELECT 'UNKNOWN:' || range FROM range(100)),
found AS (SELECT a.curie, m.canonical_id FROM asked a LEFT JOIN curie_map m ON upper(a.curie) = m.curie_key)
"""
CONF = """
conf AS (
  SELECT 'A' AS name, unnest(['PART:' || p_partkey, 'SUPP:' || p_partkey]) AS member, ['PART:' || p_partkey, 'SUPP:' || p_partkey] AS members FROM part JOIN supplier ON p_partkey = s_suppkey
  UNION ALL SELECT 'B', unnest(['PART:' || p.p_partkey, 'PART:' || q.p_partkey]), ['PART:' || p.p_partkey, 'PART:' || q.p_partkey] FROM part p JOIN part q ON q.p_partkey = p.p_partkey + 1 WHERE p.p_partkey % 2 = 0
),
spread AS (SELECT name, member AS canonical_id, unnest(members) AS m, generate_subscripts(members, 1) AS mpos FROM conf WHERE name IN ({names})),
rows_ AS (SELECT s.canonical_id, s.name, s.mpos, s.m, d.pos, d.i, d.l, d.type FROM spread s JOIN ids d ON d.canonical_id = s.m),
parts AS (
  SELECT canonical_id, name, mpos, m, coalesce(arg_min(l, pos) FILTER (WHERE l <> '' AND NOT starts_with(l, 'CHEMBL') AND length(l) <= 15), arg_min(l, pos) FILTER (WHERE l <> '' AND NOT starts_with(l, 'CHEMBL'))) AS label,
    bool_or(coalesce(l, '') <> '') AS labelled FROM rows_ GROUP BY ALL
),
types_in AS (SELECT DISTINCT r.canonical_id, r.name, r.mpos, a.a, a.n FROM rows_ r JOIN anc a ON a.type = r.type),
types_of AS (SELECT canonical_id, string_agg(a, '|' ORDER BY k) AS types FROM (SELECT canonical_id, a, min((name, mpos, n)) AS k FROM types_in GROUP BY 1, 2) GROUP BY 1),
whole AS (SELECT canonical_id, count(*) AS n_equiv, string_agg(i, '|' ORDER BY name, mpos, pos) AS equivalents, arg_min(i, (name, mpos, pos)) AS identifier FROM rows_ GROUP BY 1),
labels_of AS (SELECT canonical_id, arg_min(label, (name, mpos)) FILTER (WHERE labelled) AS label FROM (SELECT canonical_id, name, mpos, coalesce(label, '') AS label, labelled FROM parts) GROUP BY 1)
"""


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def keep(query: Query) -> Query:
        QUERIES[name] = query
        if sql is not None:
            ORACLE_SQL[name] = sql
        return query

    return keep


def joined(values, by: str = "|") -> F.Column:
    return F.array_join(values, by)


def asked(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    options = {"config": catalog.CONFIG, "conflations": []} | options
    return normalize.normalize(catalog.all_identifiers(spark, sf_dir), catalog.index(spark, sf_dir), **options)


# ---- lookup ----------------------------------------------------------------------------------------------------
@register(
    "normalize_basic",
    f"WITH {BASE} SELECT s.curie, m.canonical_id AS preferred_id, c.label AS preferred_label, c.n_equiv, c.type AS leaf_type FROM (SELECT DISTINCT 'sku:' || l_partkey AS curie FROM lineitem) s "
    "LEFT JOIN curie_map m ON upper(s.curie) = m.curie_key LEFT JOIN clique c ON c.canonical_id = m.canonical_id",
)
def normalize_basic(spark, d):
    nodes = normalize.normalize(catalog.line_identifiers(spark, d), catalog.index(spark, d), conflations=[], config=catalog.CONFIG)
    return nodes.select("curie", F.col("identifier").alias("preferred_id"), F.col("label").alias("preferred_label"), F.size("equivalent_identifiers").cast("long").alias("n_equiv"), F.get("types", F.lit(0)).alias("leaf_type"))


@register("normalize_unknown", f"WITH {BASE} SELECT curie, canonical_id IS NOT NULL AS found FROM found")
def normalize_unknown(spark, d):
    return asked(spark, d).select("curie", F.col("identifier").isNotNull().alias("found"))


@register(
    "normalize_labels",
    f"WITH {BASE}, lab AS (SELECT canonical_id, arg_min(l, (CASE WHEN type IN ('cat:Customer', 'cat:Supplier') AND starts_with(i, 'ACCT:') THEN 0 ELSE 1 END, pos)) FILTER (WHERE l <> '' AND NOT starts_with(l, 'CHEMBL')) AS label FROM ids GROUP BY 1) "
    "SELECT f.curie, f.canonical_id AS preferred_id, lab.label AS preferred_label FROM found f LEFT JOIN lab ON lab.canonical_id = f.canonical_id",
)
def normalize_labels(spark, d):
    return asked(spark, d, config=catalog.BOOSTED).select("curie", F.col("identifier").alias("preferred_id"), F.col("label").alias("preferred_label"))


@register("normalize_types", f"WITH {BASE} SELECT f.curie, t.types FROM found f LEFT JOIN clique c ON c.canonical_id = f.canonical_id LEFT JOIN types t ON t.type = c.type")
def normalize_types(spark, d):
    return asked(spark, d).select("curie", joined("types").alias("types"))


@register(
    "normalize_individual_types",
    f"WITH {BASE} SELECT f.curie, i.i AS identifier, i.type FROM found f JOIN ids i ON i.canonical_id = f.canonical_id",
)
def normalize_individual_types(spark, d):
    return asked(spark, d, individual_types=True).select("curie", F.explode("equivalent_identifiers").alias("x")).select("curie", "x.identifier", "x.type")


@register("normalize_ic", f"WITH {BASE} SELECT f.curie, CAST(c.ic AS DOUBLE) AS information_content FROM found f LEFT JOIN clique c ON c.canonical_id = f.canonical_id")
def normalize_ic(spark, d):
    return asked(spark, d).select("curie", "information_content")


def conflated_sql(names: str) -> str:
    return (
        f"WITH {BASE}, {CONF.format(names=names)} SELECT f.curie, coalesce(w.identifier, f.canonical_id) AS preferred_id, CASE WHEN w.canonical_id IS NULL THEN c.label ELSE l.label END AS preferred_label, "
        "coalesce(w.n_equiv, c.n_equiv, 0) AS n_equiv, coalesce(w.equivalents, c.equivalents) AS equivalents, coalesce(o.types, t.types) AS types, CAST(c.ic AS DOUBLE) AS information_content "
        "FROM found f LEFT JOIN clique c ON c.canonical_id = f.canonical_id LEFT JOIN types t ON t.type = c.type LEFT JOIN whole w ON w.canonical_id = f.canonical_id "
        "LEFT JOIN types_of o ON o.canonical_id = f.canonical_id LEFT JOIN labels_of l ON l.canonical_id = f.canonical_id"
    )


def conflated(names: list[str]) -> Query:
    def query(spark, d):
        nodes = asked(spark, d, conflations=names)
        return nodes.select(
            "curie", F.col("identifier").alias("preferred_id"), F.col("label").alias("preferred_label"), F.when(F.col("identifier").isNotNull(), F.size("equivalent_identifiers")).otherwise(0).cast("long").alias("n_equiv"),
            joined(F.transform("equivalent_identifiers", lambda x: x["identifier"])).alias("equivalents"), joined("types").alias("types"), "information_content",
        )

    return query


for _name, _names in (("normalize_conflate_a", ["A"]), ("normalize_conflate_b", ["B"]), ("normalize_conflate_both", ["A", "B"])):
    register(_name, conflated_sql(", ".join(f"'{n}'" for n in _names)))(conflated(_names))


@register(
    "normalize_descriptions",
    f"WITH {BASE}, de AS (SELECT canonical_id, CASE WHEN file = 'supplier' AND pos = 1 THEN 'vendor ' || line_no END AS d FROM ids), one AS (SELECT canonical_id, min(d) AS description, count(d) AS n_described FROM de GROUP BY 1) "
    "SELECT f.curie, one.description, coalesce(one.n_described, 0) AS n_described FROM found f LEFT JOIN one ON one.canonical_id = f.canonical_id",
)
def normalize_descriptions(spark, d):
    nodes = asked(spark, d, descriptions=True)
    described = F.size(F.filter(F.coalesce("equivalent_identifiers", F.array()), lambda x: x["description"].isNotNull()))
    return nodes.select("curie", "description", described.cast("long").alias("n_described"))


@register(
    "normalize_fallback_types",
    f"WITH {BASE} SELECT f.curie, CASE c.type WHEN 'cat:Customer' THEN c.type WHEN 'cat:Supplier' THEN 'cat:NamedThing' ELSE t.types END AS types FROM found f LEFT JOIN clique c ON c.canonical_id = f.canonical_id LEFT JOIN types t ON t.type = c.type",
)
def normalize_fallback_types(spark, d):
    """Types without ancestors, cliques without a type, and the general type that is left out."""
    index = catalog.index(spark, d)
    known = index.type_ancestors.filter("type <> 'cat:Customer'").withColumn("ancestors", F.concat("ancestors", F.array(F.lit("cat:Entity"))))
    untyped = index.cliques.withColumn("type", F.when(F.col("type") != "cat:Supplier", F.col("type")))
    nodes = normalize.normalize(catalog.all_identifiers(spark, d), replace(index, type_ancestors=known, cliques=untyped), conflations=[], config=catalog.CONFIG)
    return nodes.select("curie", joined("types").alias("types"))


@register("normalize_hit_rate", f"WITH {BASE} SELECT count(canonical_id) AS n_found, count(*) AS n_total, count(canonical_id) / count(*) AS rate FROM found")
def normalize_hit_rate(spark, d):
    return normalize.hit_rate(asked(spark, d))


@register(
    "normalized_csv",
    f"WITH {BASE} SELECT f.curie AS input_curie, coalesce(f.canonical_id, '') AS preferred_identifier, coalesce(c.label, '') AS preferred_label, coalesce(replace(t.types, '|', ';'), '') AS types, coalesce(replace(c.equivalents, '|', ';'), '') AS equivalent_identifiers "
    "FROM found f LEFT JOIN clique c ON c.canonical_id = f.canonical_id LEFT JOIN types t ON t.type = c.type",
)
def normalized_csv(spark, d):
    return sinks.normalized_csv_rows(asked(spark, d))


# ---- index and statistics --------------------------------------------------------------------------------------
@register("index_last_write_wins", f"WITH {BASE} SELECT curie_key, canonical_id FROM curie_map")
def index_last_write_wins(spark, d):
    return catalog.built_index(spark, d).curie_map


COUNTS = f"WITH {BASE}, pc AS (SELECT i.file, a.a AS semantic_type, split_part(i.i, ':', 1) AS prefix, count(*) AS cnt FROM ids i JOIN anc a ON a.type = i.type GROUP BY ALL) "


@register("prefix_counts_per_file", COUNTS + "SELECT * FROM pc")
def prefix_counts_per_file(spark, d):
    return catalog.built_index(spark, d).prefix_counts


@register("prefix_counts_merged", COUNTS + "SELECT semantic_type, prefix, CAST(sum(cnt) AS BIGINT) AS cnt FROM pc GROUP BY ALL")
def prefix_counts_merged(spark, d):
    return prefixes.merged_prefix_counts(catalog.index(spark, d))


@register("semantic_types", COUNTS + "SELECT DISTINCT semantic_type FROM pc")
def semantic_types(spark, d):
    return prefixes.semantic_types(catalog.index(spark, d))


@register(
    "curie_prefixes_not_found",
    COUNTS + "SELECT r.semantic_type, coalesce((SELECT string_agg(prefix || '=' || n, '|' ORDER BY prefix) FROM (SELECT prefix, CAST(sum(cnt) AS BIGINT) AS n FROM pc WHERE pc.semantic_type = r.semantic_type GROUP BY prefix)), 'Not found') AS curie_prefix "
    "FROM (VALUES ('cat:Party'), ('cat:Product'), ('cat:Nothing')) r(semantic_type)",
)
def curie_prefixes_not_found(spark, d):
    requested = spark.createDataFrame([("cat:Party",), ("cat:Product",), ("cat:Nothing",)], "semantic_type string")
    found = prefixes.curie_prefixes(catalog.index(spark, d), requested)
    text = joined(F.sort_array(F.transform(F.map_entries("curie_prefix"), lambda e: F.concat(e["key"], F.lit("="), e["value"]))))
    return found.select("semantic_type", F.coalesce(F.when(F.col("curie_prefix").isNotNull(), text), F.lit("Not found")).alias("curie_prefix"))


@register(
    "status_counts",
    COUNTS + f", {CONF.format(names=repr('A'))} SELECT 'curie_map' AS table_name, count(*) AS n_rows FROM curie_map UNION ALL SELECT 'cliques', count(*) FROM clique UNION ALL SELECT 'type_ancestors', count(DISTINCT type) FROM anc "
    "UNION ALL SELECT 'conflation', count(*) FROM (SELECT DISTINCT name, member FROM conf) UNION ALL SELECT 'prefix_counts', count(*) FROM pc",
)
def status_counts(spark, d):
    return prefixes.status(catalog.index(spark, d))


# ---- set identifiers -------------------------------------------------------------------------------------------
def set_sql(leader: str) -> str:
    name = "CAST(unhex('14ef168c14cb49798442da6aaca55572') AS BLOB) || encode(s)"
    return (
        f"WITH {BASE}, {CONF.format(names=repr('A') + ', ' + repr('B'))}, named AS (SELECT l_orderkey AS key, string_agg(DISTINCT p, '||' ORDER BY p) AS s FROM (SELECT l_orderkey, {leader} AS p FROM lineitem LEFT JOIN whole w ON w.canonical_id = 'PART:' || l_partkey) GROUP BY 1), "
        f"hashed AS (SELECT key, s, sha1({name}) AS h FROM named) "
        "SELECT key, s AS normalized_string, 'uuid:' || h[1:8] || '-' || h[9:12] || '-5' || h[14:16] || '-' || substr('89ab', (strpos('0123456789abcdef', h[17:17]) - 1) % 4 + 1, 1) || h[18:20] || '-' || h[21:32] AS setid FROM hashed"
    )


@register("set_id", set_sql("'PART:' || l_partkey"))
def set_id(spark, d):
    return setid.set_id(catalog.sets(spark, d, []), catalog.index(spark, d), ("A", "B")).select("key", "normalized_string", "setid")


@register("set_id_conflated", set_sql("coalesce(w.identifier, 'PART:' || l_partkey)"))
def set_id_conflated(spark, d):
    return setid.set_id(catalog.sets(spark, d, ["B", "A"]), catalog.index(spark, d), ("A", "B")).select("key", "normalized_string", "setid")


# ---- graph -----------------------------------------------------------------------------------------------------
GRAPH = f"""WITH {BASE}, {CONF.format(names=repr('A') + ', ' + repr('B'))},
edge AS (
  SELECT DISTINCT CAST(l_orderkey % 4 AS VARCHAR) AS msg_id, concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, l_linestatus) AS edge_id,
    CASE WHEN l_linenumber % 2 = 0 THEN 'VEND:' ELSE 'SUPP:' END || l_suppkey AS subject, l_returnflag AS predicate, CASE WHEN l_linenumber % 3 = 0 THEN 'SKU:' ELSE 'PART:' END || l_partkey AS object, l_linestatus AS status
  FROM lineitem
),
primary_ AS (SELECT upper(m.curie_key) AS node_id, coalesce(w.identifier, m.canonical_id) AS primary_id, m.canonical_id FROM curie_map m LEFT JOIN whole w ON w.canonical_id = m.canonical_id),
node AS (SELECT DISTINCT msg_id, unnest([subject, object]) AS node_id FROM edge),
mapped AS (SELECT n.msg_id, n.node_id, coalesce(p.primary_id, n.node_id) AS primary_id, p.canonical_id FROM node n LEFT JOIN primary_ p ON p.node_id = n.node_id),
rewritten AS (SELECT e.msg_id, e.edge_id, s.primary_id AS subject, e.predicate, o.primary_id AS object, e.status FROM edge e JOIN mapped s ON s.msg_id = e.msg_id AND s.node_id = e.subject JOIN mapped o ON o.msg_id = e.msg_id AND o.node_id = e.object),
kept AS (SELECT msg_id, subject, predicate, object, status, min(edge_id) AS kept_id FROM rewritten GROUP BY ALL)
"""


def kgraph(spark: SparkSession, sf_dir: str, *parts: str) -> dict[str, DataFrame]:
    return graph.normalize_kgraph(catalog.nodes(spark, sf_dir), catalog.edges(spark, sf_dir), catalog.index(spark, sf_dir), catalog.CONFIG, parts)


@register(
    "kg_nodes",
    GRAPH + ", lead AS (SELECT msg_id, primary_id, min(node_id) AS node_id, arg_min(canonical_id, node_id) AS canonical_id, count(*) AS n FROM mapped GROUP BY ALL) "
    "SELECT e.msg_id, e.primary_id AS node_id, coalesce(CASE WHEN w.canonical_id IS NULL THEN c.label ELSE l.label END, '') AS name, coalesce(o.types, t.types) AS categories, "
    "CAST(e.n + 1 + CASE WHEN own.ic IS NULL THEN 0 ELSE 1 END AS BIGINT) AS n_attributes, e.n > 1 AS merged FROM lead e JOIN clique c ON c.canonical_id = e.canonical_id JOIN types t ON t.type = c.type LEFT JOIN whole w ON w.canonical_id = e.canonical_id "
    "LEFT JOIN types_of o ON o.canonical_id = e.canonical_id LEFT JOIN labels_of l ON l.canonical_id = e.canonical_id LEFT JOIN clique own ON own.canonical_id = e.node_id",
)
def kg_nodes(spark, d):
    nodes = kgraph(spark, d, "nodes")["nodes"]
    merged = F.exists(F.map_keys(F.get("attributes", F.lit(0))), lambda k: k.endswith(".1"))
    return nodes.select("msg_id", "node_id", "name", joined("categories").alias("categories"), F.size("attributes").cast("long").alias("n_attributes"), merged.alias("merged"))


@register("kg_edges_dedup", GRAPH + "SELECT msg_id, kept_id AS edge_id, subject, predicate, object FROM kept")
def kg_edges_dedup(spark, d):
    edges = kgraph(spark, d, "edges")["edges"]
    return edges.select("msg_id", "edge_id", "subject", "predicate", "object")


@register("edge_id_map", GRAPH + "SELECT r.msg_id, r.edge_id, k.kept_id FROM rewritten r JOIN kept k ON r.msg_id = k.msg_id AND r.subject = k.subject AND r.predicate = k.predicate AND r.object = k.object AND r.status = k.status")
def edge_id_map(spark, d):
    return kgraph(spark, d, "edge_id_map")["edge_id_map"]


@register(
    "kg_node_notes",
    GRAPH + "SELECT msg_id, primary_id AS node_id, CASE WHEN n > 1 THEN 'value.' || nth ELSE 'value' END AS key, '\"' || node_id || '\"' AS value FROM "
    "(SELECT *, row_number() OVER (PARTITION BY msg_id, primary_id ORDER BY node_id) AS nth, count(*) OVER (PARTITION BY msg_id, primary_id) AS n FROM mapped)",
)
def kg_node_notes(spark, d):
    """The numbered keys under which merged nodes keep their own attributes."""
    entries = kgraph(spark, d, "nodes")["nodes"].select("msg_id", "node_id", F.explode("attributes").alias("m")).select("msg_id", "node_id", F.explode("m").alias("key", "value"))
    return entries.filter(F.col("key").startswith("value") & ~F.col("key").startswith("value_") & F.col("value").startswith('"'))


@register("kg_edge_signatures", GRAPH + "SELECT msg_id, kept_id AS edge_id FROM kept")
def kg_edge_signatures(spark, d):
    """Values that are objects: of two spellings of one value the first edge stays."""
    edges = catalog.edges(spark, d)
    even = F.pmod(F.xxhash64("edge_id"), F.lit(2)) == 0
    status = F.get("attributes", F.lit(0))["value"]
    value = F.when(even, F.concat(F.lit('{"b": [1, 2.0], "a": '), status, F.lit("}"))).otherwise(F.concat(F.lit('{"a":'), status, F.lit(',"b":[1,2]}')))
    odd = F.when(even, F.map_from_arrays(F.array(F.lit("value"), F.lit("attribute_type_id")), F.array(value, F.lit('"status"')))).otherwise(F.map_from_arrays(F.array(F.lit("attribute_type_id"), F.lit("value")), F.array(F.lit('"status"'), value)))
    parts = graph.normalize_kgraph(catalog.nodes(spark, d), edges.withColumn("attributes", F.array(odd)), catalog.index(spark, d), catalog.CONFIG, ("edges",))
    return parts["edges"].select("msg_id", "edge_id")


@register(
    "qgraph_ids",
    GRAPH + "SELECT q.msg_id, q.code, string_agg(DISTINCT m.primary_id, '|' ORDER BY m.primary_id) AS ids FROM (SELECT msg_id, split_part(edge_id, '-', 1) AS code, unnest([subject, object]) AS id FROM edge) q JOIN mapped m ON m.msg_id = q.msg_id AND m.node_id = q.id GROUP BY ALL",
)
def qgraph_ids(spark, d):
    return graph.normalize_qgraph(catalog.query_nodes(spark, d), catalog.index(spark, d), catalog.CONFIG).select("msg_id", "code", joined("ids").alias("ids"))


BOUND = (
    GRAPH + ", bound AS (SELECT e.msg_id, CAST(split_part(e.edge_id, '-', 1) AS BIGINT) AS result_pos, x.code, m.primary_id AS id, min(e.edge_id) AS first_at FROM edge e, LATERAL (VALUES ('s', e.subject), ('o', e.object)) x(code, id) JOIN mapped m ON m.msg_id = e.msg_id AND m.node_id = x.id GROUP BY ALL), "
    "ebound AS (SELECT r.msg_id, CAST(split_part(r.edge_id, '-', 1) AS BIGINT) AS result_pos, k.kept_id AS id, min(r.edge_id) AS first_at FROM rewritten r JOIN kept k ON r.msg_id = k.msg_id AND r.subject = k.subject AND r.predicate = k.predicate AND r.object = k.object AND r.status = k.status GROUP BY ALL) "
)


@register(
    "results_dedup",
    BOUND + ", n AS (SELECT msg_id, result_pos, string_agg(id, '|' ORDER BY code, first_at) AS nodes FROM bound GROUP BY ALL), e AS (SELECT msg_id, result_pos, string_agg(id, '|' ORDER BY first_at) AS edges FROM ebound GROUP BY ALL) "
    "SELECT msg_id, min(result_pos) AS result_pos, nodes, edges FROM n JOIN e USING (msg_id, result_pos) GROUP BY msg_id, nodes, edges",
)
def results_dedup(spark, d):
    node, edge = catalog.bindings(spark, d)
    message = graph.Message(kg_nodes=catalog.nodes(spark, d), kg_edges=catalog.edges(spark, d), node_bindings=node, edge_bindings=edge)
    results = graph.normalize_message(message, catalog.index(spark, d), catalog.CONFIG)["results"]
    found = lambda pattern: joined(F.regexp_extract_all("result", F.lit(pattern), F.lit(0)))
    return results.select("msg_id", "result_pos", found("[A-Z]+:[0-9]+").alias("nodes"), found("[0-9]+-[0-9]+-[0-9]+-[0-9]+-[A-Z]-[A-Z]").alias("edges"))


@register("result_edge_bindings", BOUND + "SELECT msg_id, result_pos, id FROM ebound")
def result_edge_bindings(spark, d):
    return graph.remap_edge_bindings(catalog.bindings(spark, d)[1], kgraph(spark, d, "edge_id_map")["edge_id_map"]).select("msg_id", "result_pos", "id")


@register(
    "result_bindings",
    GRAPH + "SELECT DISTINCT e.msg_id, CAST(split_part(e.edge_id, '-', 1) AS BIGINT) AS result_pos, x.code, m.primary_id AS id FROM edge e, LATERAL (VALUES ('s', e.subject), ('o', e.object)) x(code, id) JOIN mapped m ON m.msg_id = e.msg_id AND m.node_id = x.id",
)
def result_bindings(spark, d):
    return graph.remap_node_bindings(catalog.bindings(spark, d)[0], kgraph(spark, d, "node_id_map")["node_id_map"], catalog.index(spark, d)).select("msg_id", "result_pos", "code", "id")


@register(
    "kgx_nodes",
    f"WITH {BASE}, mem AS (SELECT file, line_no, string_agg(i, '|' ORDER BY pos) AS m FROM ids GROUP BY ALL) SELECT i.i AS id, coalesce(i.l, '') AS name, t.types AS category, m.m AS equivalent_identifiers FROM ids i JOIN types t ON t.type = i.type JOIN mem m ON m.file = i.file AND m.line_no = i.line_no",
)
def kgx_nodes(spark, d):
    nodes = kgx.kgx_nodes(catalog.compendium(spark, d), catalog.type_ancestors(spark, d))
    return nodes.select("id", "name", joined("category").alias("category"), joined("equivalent_identifiers").alias("equivalent_identifiers"))


@register(
    "kgx_edges",
    f"WITH {BASE} SELECT md5(a.i || b.i || a.file) AS id, a.i AS subject, 'biolink:same_as' AS predicate, b.i AS object FROM ids a JOIN ids b ON a.file = b.file AND a.line_no = b.line_no AND a.pos < b.pos",
)
def kgx_edges(spark, d):
    return kgx.kgx_edges(catalog.compendium(spark, d))


# ---- mappers ---------------------------------------------------------------------------------------------------
ROWS = """WITH rows_ AS (
  SELECT p_partkey AS pos, CASE WHEN p_partkey % 13 = 0 THEN 'http://mouse.brain-map.org/atlas/index.html#' || p_partkey WHEN p_partkey % 11 = 0 THEN 'NCBIGene:' || p_partkey WHEN p_partkey % 7 = 0 THEN 'mondo:' || p_partkey
    WHEN p_partkey % 5 = 0 THEN 'NCBI:' || p_partkey WHEN p_partkey % 3 = 0 THEN ' C' || lpad(CAST(p_partkey AS VARCHAR), 7, '0') || ' ' ELSE CAST(p_partkey AS VARCHAR) END AS node_id,
    (['gene/protein', 'disease', 'drug', 'Gene', 'anatomy', 'other'])[p_partkey % 6 + 1] AS node_type, CASE WHEN p_partkey % 8 <> 0 THEN p_name END AS node_name, (['NCBI', 'DrugBank', 'MONDO_grouped', 'XYZ', 'GO'])[p_partkey % 5 + 1] AS node_source
  FROM part
), curies AS (
  SELECT *, CASE WHEN contains(node_id, ':') AND upper(split_part(trim(node_id), ':', 1)) IN ('DRUGBANK', 'CHEMBL.COMPOUND', 'PUBCHEM.COMPOUND', 'GO', 'UBERON', 'REACTOME', 'MONDO', 'UMLS', 'HP', 'MESH', 'OMIM', 'DOID', 'SNOMEDCT', 'NCIT', 'HGNC', 'UNIPROT', 'CTD') THEN upper(trim(node_id))
    ELSE CASE node_source WHEN 'NCBI' THEN 'NCBIGene' WHEN 'DrugBank' THEN 'DRUGBANK' WHEN 'GO' THEN 'GO' WHEN 'MONDO_grouped' THEN 'MONDO' END || ':' || trim(node_id) END AS curie FROM rows_
)
"""


def mapper(name: str, sql: str, column: Callable[[], F.Column]) -> None:
    register(name, ROWS + f"SELECT pos, {sql} AS curie FROM rows_")(lambda spark, d: catalog.source_rows(spark, d).select("pos", column().alias("curie")))


mapper("map_biokde", "CASE WHEN starts_with(node_id, 'http://mouse.brain-map.org/atlas/index.html#') THEN 'ABA:' || split_part(node_id, '#', 2) END", mappers.map_biokde)
mapper("map_ikraph", "CASE WHEN node_type = 'Gene' AND starts_with(node_id, 'NCBI:') THEN node_id END", mappers.map_ikraph)
mapper("map_primekg", "CASE node_type WHEN 'gene/protein' THEN 'NCBIGene:' || trim(node_id) WHEN 'disease' THEN 'MONDO:' || trim(node_id) WHEN 'drug' THEN 'CHEBI:' || trim(node_id) END", mappers.map_primekg)
mapper("map_semmeddb", "CASE WHEN regexp_full_match(trim(node_id), 'C[0-9]{7}') THEN 'UMLS:' || trim(node_id) END", mappers.map_semmeddb)
register("map_source_aware", ROWS + "SELECT pos, curie FROM curies")(lambda spark, d: catalog.source_rows(spark, d).select("pos", mappers.map_by_source().alias("curie")))


@register(
    "sample_per_type",
    ROWS + "SELECT pos, node_type, curie, CASE node_type WHEN 'gene/protein' THEN 'biolink:Gene' WHEN 'drug' THEN 'biolink:ChemicalEntity' WHEN 'anatomy' THEN 'biolink:AnatomicalEntity' WHEN 'disease' THEN 'biolink:Disease' ELSE 'biolink:NamedThing' END AS class "
    "FROM curies WHERE curie IS NOT NULL QUALIFY row_number() OVER (PARTITION BY node_type ORDER BY pos) <= 20",
)
def sample_per_type(spark, d):
    return mappers.sample_per_type(catalog.source_rows(spark, d), 20).select("pos", "node_type", "curie", "class")


@register("mapping_totals", ROWS + "SELECT count(*) AS n_seen, count(curie) AS n_mapped, round(100.0 * count(curie) / count(*), 6) AS percent FROM curies")
def mapping_totals(spark, d):
    return mappers.mapping_totals(catalog.source_rows(spark, d)).withColumn("percent", F.round("percent", 6))


@register("mapping_counts", ROWS + "SELECT node_type, count(*) AS n_seen, count(curie) AS n_mapped, round(100.0 * count(curie) / count(*), 6) AS percent FROM curies GROUP BY 1")
def mapping_counts(spark, d):
    return mappers.mapping_counts(catalog.source_rows(spark, d)).withColumn("percent", F.round("percent", 6))


@register(
    "unmapped_examples",
    ROWS + "SELECT node_type, CAST(row_number() OVER (PARTITION BY node_type ORDER BY pos) AS INTEGER) AS nth, node_id || ' (' || coalesce(node_name, '') || ') [source: ' || node_source || ']' AS example FROM curies WHERE curie IS NULL QUALIFY nth <= 5",
)
def unmapped_examples(spark, d):
    return mappers.unmapped_examples(catalog.source_rows(spark, d))


@register("compendium_records", ROWS + "SELECT 'biolink:' || node_type AS type, curie AS i, coalesce(node_name, curie) AS l, 'PRIMEKG' AS source FROM (SELECT *, CASE node_type WHEN 'gene/protein' THEN 'NCBIGene:' || trim(node_id) WHEN 'disease' THEN 'MONDO:' || trim(node_id) WHEN 'drug' THEN 'CHEBI:' || trim(node_id) END AS curie FROM rows_) WHERE curie IS NOT NULL")
def compendium_records(spark, d):
    records = mappers.csv_record(catalog.source_rows(spark, d), mappers.map_primekg(), "primekg")
    return records.select("type", F.col("identifiers")[0]["i"].alias("i"), F.col("identifiers")[0]["l"].alias("l"), "source")


# ---- merging ---------------------------------------------------------------------------------------------------
MERGE = """WITH a AS (
  SELECT p_partkey AS k, 'PART:' || p_partkey AS entity_id, p_name AS label, [CASE WHEN p_partkey % 5 = 0 THEN 'biolink:GeneFamily' ELSE 'biolink:ChemicalEntity' END, 'biolink:NamedThing'] AS types, ['PART:' || p_partkey, 'SKU:' || p_partkey] AS eq FROM part WHERE p_partkey % 3 <> 0
), b AS (
  SELECT p_partkey AS k, 'PART:' || p_partkey AS entity_id, p_brand AS label, [CASE WHEN p_partkey % 5 = 0 THEN 'biolink:Protein' ELSE 'biolink:Disease' END, 'biolink:NamedThing'] AS types,
    CASE WHEN p_partkey % 4 = 0 THEN ['PART:' || p_partkey, 'MFG:' || p_partkey, 'ALT:' || p_partkey, 'PART:' || (p_partkey + 2)] ELSE ['PART:' || p_partkey, 'MFG:' || p_partkey] END AS eq FROM part WHERE p_partkey % 2 = 0
), j AS (
  SELECT coalesce(a.entity_id, b.entity_id) AS entity_id, coalesce(a.k, b.k) AS k, a.k IS NOT NULL AS in_a, b.k IS NOT NULL AS in_b, a.types AS ta, b.types AS tb, a.eq AS ae, b.eq AS be, a.label AS al, b.label AS bl FROM a FULL JOIN b ON a.entity_id = b.entity_id
), m AS (
  SELECT entity_id, k, in_a, in_b, ta, tb, ae, be, bl, CASE WHEN in_a THEN al ELSE bl END AS label, list_sort(list_distinct(coalesce(ta, []) || coalesce(tb, []))) AS types,
    coalesce(ae, []) || list_filter(coalesce(be, []), lambda x: NOT list_contains(coalesce(ae, []), x)) AS eq, CASE WHEN in_a AND in_b THEN ['A', 'B'] WHEN in_a THEN ['A'] ELSE ['B'] END AS sources FROM j
)
"""
FLAT = "entity_id, label, array_to_string(types, '|') AS types, array_to_string(eq, '|') AS equivalents, array_to_string(sources, '|') AS sources"


def flat(df: DataFrame, *more: str) -> DataFrame:
    return df.select("entity_id", "label", joined("types").alias("types"), joined(F.transform("equivalents", lambda x: x["identifier"])).alias("equivalents"), joined("sources").alias("sources"), *more)


@register("merge_union", MERGE + f"SELECT {FLAT} FROM m")
def merge_union(spark, d):
    return flat(merge.merge_union(*catalog.merge_sources(spark, d), "A", "B"))


@register("merge_intersection", MERGE + f"SELECT {FLAT} FROM m WHERE in_a AND in_b")
def merge_intersection(spark, d):
    return flat(merge.merge_intersection(*catalog.merge_sources(spark, d), "A", "B"))


SCORE = "least(1.0::DOUBLE, 0.5::DOUBLE + least(0.2::DOUBLE, len({eq})::DOUBLE * 0.05::DOUBLE) + least(0.1::DOUBLE, len({t})::DOUBLE * 0.01::DOUBLE) + {bonus}::DOUBLE)"


@register(
    "merge_confidence",
    MERGE + f", s AS (SELECT *, CASE WHEN in_a THEN {SCORE.format(eq='ae', t='ta', bonus='0.1')} END AS sa, CASE WHEN in_b THEN {SCORE.format(eq='be', t='tb', bonus='0.05')} END AS sb FROM m), w AS (SELECT *, coalesce(sb > sa, false) AS win FROM s) "
    "SELECT entity_id, CASE WHEN win THEN bl ELSE label END AS label, array_to_string(CASE WHEN win THEN list_sort(tb) ELSE types END, '|') AS types, array_to_string(CASE WHEN win THEN be ELSE eq END, '|') AS equivalents, array_to_string(sources, '|') AS sources, "
    "round(CASE WHEN win THEN sb ELSE coalesce(sa, sb) END, 6) AS confidence_score FROM w",
)
def merge_confidence(spark, d):
    return flat(merge.merge_confidence(*catalog.merge_sources(spark, d), 0.5, "A", "B"), F.round("confidence_score", 6).alias("confidence_score"))


@register(
    "merge_type_priority",
    MERGE + ", u AS (SELECT entity_id, 0 AS ord, label, types, eq, CASE WHEN k % 5 = 0 THEN 10 ELSE 8 END AS priority FROM a UNION ALL SELECT entity_id, 1, label, types, eq, CASE WHEN k % 5 = 0 THEN 9 ELSE 6 END FROM b) "
    "SELECT u.entity_id, u.label, array_to_string(list_sort(u.types), '|') AS types, array_to_string(u.eq, '|') AS equivalents, array_to_string(m.sources, '|') AS sources, u.priority FROM u JOIN m ON m.entity_id = u.entity_id QUALIFY row_number() OVER (PARTITION BY u.entity_id ORDER BY priority DESC, ord) = 1",
)
def merge_type_priority(spark, d):
    a, b = catalog.merge_sources(spark, d)
    return flat(merge.merge_type_priority({"A": a, "B": b}), "priority")


@register(
    "merge_stats",
    MERGE + "SELECT 'total' AS metric, '' AS key, count(*)::DOUBLE AS value FROM m UNION ALL SELECT 'multi_source', '', sum(CASE WHEN len(sources) > 1 THEN 1 ELSE 0 END)::DOUBLE FROM m UNION ALL SELECT 'avg_equivalents', '', round(avg(len(eq)), 6) FROM m "
    "UNION ALL SELECT 'by_source', s, count(*)::DOUBLE FROM (SELECT unnest(sources) AS s FROM m) GROUP BY s UNION ALL SELECT 'by_type', t, count(*)::DOUBLE FROM (SELECT unnest(types) AS t FROM m) GROUP BY t UNION ALL SELECT 'by_base_type', split_part(t, ':', 2), count(*)::DOUBLE FROM (SELECT unnest(types) AS t FROM m) GROUP BY 2",
)
def merge_stats(spark, d):
    return merge.merge_stats(catalog.merged_entities(spark, d)).withColumn("value", F.round("value", 6))


@register("type_distribution", MERGE + "SELECT t AS type, count(*) AS n FROM (SELECT unnest(types) AS t FROM m) GROUP BY 1 ORDER BY n DESC, type LIMIT 10")
def type_distribution(spark, d):
    return merge.type_distribution(catalog.merged_entities(spark, d))


@register("source_counts", MERGE + "SELECT count(*) FILTER (WHERE in_a AND NOT in_b) AS only_a, count(*) FILTER (WHERE in_b AND NOT in_a) AS only_b, count(*) FILTER (WHERE in_a AND in_b) AS both FROM m")
def source_counts(spark, d):
    return merge.source_counts(catalog.merged_entities(spark, d), "A", "B")


@register("source_overlap", MERGE + "SELECT array_to_string(sources, '_') AS combination, count(*) AS n, CASE WHEN len(sources) > 1 THEN 'multi_source' ELSE 'single_source' END AS overlap FROM m GROUP BY sources")
def source_overlap(spark, d):
    return quality.source_overlap(catalog.merged_entities(spark, d))


@register("source_type_counts", MERGE + "SELECT s AS source, t AS type, count(*) AS n FROM (SELECT s, unnest(types) AS t FROM (SELECT types, unnest(sources) AS s FROM m)) GROUP BY ALL")
def source_type_counts(spark, d):
    return quality.source_type_counts(catalog.merged_entities(spark, d))


@register(
    "duplicate_identifiers",
    MERGE + "SELECT identifier, count(*) AS n_entities, count(DISTINCT entity_id) AS distinct_entities FROM (SELECT entity_id AS identifier, entity_id FROM m UNION ALL SELECT unnest(eq), entity_id FROM m) GROUP BY 1 HAVING count(*) > 1",
)
def duplicate_identifiers(spark, d):
    return quality.duplicate_identifiers(catalog.merged_entities(spark, d))


FLAWED = MERGE + ", f AS (SELECT entity_id, k, CASE WHEN k % 10 <> 1 THEN label END AS label, CASE WHEN k % 7 = 2 THEN types || ['thing'] ELSE types END AS types, CASE WHEN k % 9 = 4 THEN entity_id || 'x' ELSE entity_id END AS identifier, eq, sources FROM m) "


@register(
    "quality_metrics",
    FLAWED + "SELECT 'total' AS metric, count(*)::DOUBLE AS value FROM f UNION ALL SELECT 'multi_source', sum(CASE WHEN len(sources) > 1 THEN 1 ELSE 0 END)::DOUBLE FROM f UNION ALL SELECT 'avg_types', round(avg(len(types)), 6) FROM f UNION ALL SELECT 'avg_equivalents', round(avg(len(eq)), 6) FROM f "
    "UNION ALL SELECT 'identifier_consistency', round(avg(CASE WHEN identifier = entity_id THEN 1.0 ELSE 0.0 END), 6) FROM f UNION ALL SELECT 'type_diversity', count(DISTINCT t)::DOUBLE FROM (SELECT unnest(types) AS t FROM f)",
)
def quality_metrics(spark, d):
    return quality.quality_metrics(catalog.flawed_entities(spark, d)).withColumn("value", F.round("value", 6))


@register(
    "integrity_issues",
    FLAWED + "SELECT entity_id, 'malformed_id' AS rule, '' AS detail FROM f WHERE label IS NULL UNION ALL SELECT entity_id, 'invalid_type', 'thing' FROM f WHERE list_contains(types, 'thing')",
)
def integrity_issues(spark, d):
    return quality.integrity_issues(catalog.flawed_entities(spark, d))


@register(
    "quality_report",
    FLAWED + "SELECT 'integrity' AS part, count(*) AS n FROM (SELECT 1 FROM f WHERE label IS NULL UNION ALL SELECT 1 FROM f WHERE list_contains(types, 'thing')) UNION ALL SELECT 'consistency', count(*) FROM (SELECT 1 FROM f WHERE identifier <> entity_id UNION ALL SELECT 1 FROM f WHERE NOT list_contains(eq, entity_id)) "
    "UNION ALL SELECT 'source_types', count(*) FROM (SELECT DISTINCT s, t FROM (SELECT s, unnest(types) AS t FROM (SELECT types, unnest(sources) AS s FROM f))) UNION ALL SELECT 'overlap', count(DISTINCT sources) FROM f "
    "UNION ALL SELECT 'duplicates', count(*) FROM (SELECT 1 FROM (SELECT identifier AS i FROM f UNION ALL SELECT unnest(eq) FROM f) GROUP BY i HAVING count(*) > 1) UNION ALL SELECT 'metrics', 6",
)
def quality_report(spark, d):
    """Every part of the report with its number of rows."""
    parts = quality.quality_report(catalog.flawed_entities(spark, d))
    counts = [df.agg(F.count("*").alias("n")).select(F.lit(name).alias("part"), "n") for name, df in parts.items()]
    return reduce(DataFrame.unionByName, counts)


@register("consistency_issues", FLAWED + "SELECT entity_id, 'key_mismatch' AS rule FROM f WHERE identifier <> entity_id UNION ALL SELECT entity_id, 'not_in_equivalents' FROM f WHERE NOT list_contains(eq, entity_id)")
def consistency_issues(spark, d):
    return quality.consistency_issues(catalog.flawed_entities(spark, d))


# ---- equivalence graph -----------------------------------------------------------------------------------------
EDGES = MERGE + ", e AS (SELECT DISTINCT least(x.entity_id, x.o) AS a, greatest(x.entity_id, x.o) AS b FROM (SELECT entity_id, unnest(eq) AS o FROM m) x JOIN m y ON y.entity_id = x.o WHERE x.o <> x.entity_id) "


@register("eq_graph_edges", EDGES + "SELECT a, b FROM e")
def eq_graph_edges(spark, d):
    return eqgraph.equivalence_edges(catalog.merged_entities(spark, d))


@register(
    "eq_graph_components",
    EDGES.replace("WITH a AS", "WITH RECURSIVE a AS", 1) + ", both_ AS (SELECT a, b FROM e UNION SELECT b, a FROM e), r AS (SELECT entity_id AS v, entity_id AS w FROM m UNION SELECT r.v, t.b FROM r JOIN both_ t ON t.a = r.w), c AS (SELECT v, min(w) AS component FROM r GROUP BY v) SELECT component, count(*) AS n FROM c GROUP BY 1",
)
def eq_graph_components(spark, d):
    return eqgraph.component_sizes(catalog.merged_entities(spark, d))


@register(
    "eq_graph_vertices_edges",
    EDGES + "SELECT entity_id, label, (SELECT count(*) FROM e WHERE e.a = m.entity_id OR e.b = m.entity_id) AS degree FROM m",
)
def eq_graph_vertices_edges(spark, d):
    vertices, edges = eqgraph.graph_tables(catalog.merged_entities(spark, d))
    degree = edges.select(F.explode(F.array("source", "target")).alias("id")).groupBy("id").agg(F.count("*").alias("degree"))
    return vertices.join(degree, "id", "left").select("entity_id", "label", F.coalesce("degree", F.lit(0)).cast("long").alias("degree"))


@register(
    "eq_graph_summary",
    EDGES.replace("WITH a AS", "WITH RECURSIVE a AS", 1)
    + ", both_ AS (SELECT a, b FROM e UNION SELECT b, a FROM e), r AS (SELECT entity_id AS v, entity_id AS w FROM m UNION SELECT r.v, t.b FROM r JOIN both_ t ON t.a = r.w), c AS (SELECT v, min(w) AS component FROM r GROUP BY v), "
    "deg AS (SELECT a AS v, count(*) AS d FROM both_ GROUP BY a), closed AS (SELECT x.a AS v, count(*) AS n FROM both_ x JOIN both_ y ON x.a = y.a AND x.b < y.b JOIN e ON e.a = x.b AND e.b = y.b GROUP BY x.a), "
    "local_ AS (SELECT m.entity_id, CASE WHEN d >= 2 THEN 2.0::DOUBLE * coalesce(n, 0) / (d * (d - 1)) ELSE 0 END AS c FROM m LEFT JOIN deg ON deg.v = m.entity_id LEFT JOIN closed ON closed.v = m.entity_id) "
    "SELECT 'nodes' AS metric, count(*)::DOUBLE AS value FROM m UNION ALL SELECT 'edges', count(*)::DOUBLE FROM e UNION ALL SELECT 'components', count(DISTINCT component)::DOUBLE FROM c UNION ALL SELECT 'average_clustering', round(avg(c), 6) FROM local_",
)
def eq_graph_summary(spark, d):
    return eqgraph.graph_summary(catalog.merged_entities(spark, d)).withColumn("value", F.round("value", 6))


@register("doc_cliques", "SELECT min(doc_id) AS canonical_id, count(*) AS n_members FROM documents GROUP BY text")
def doc_cliques(spark, d):
    return catalog.text_cliques(spark, d)


# ---- text functions --------------------------------------------------------------------------------------------
@register(
    "curie_functions",
    "SELECT p_partkey, upper(split_part(c, ':', 1)) AS upper_prefix, split_part(c, ':', 2) AS local_part, upper(split_part(c, ':', 1)) || ':' || split_part(c, ':', 2) AS upper_curie, 'Obo:' || p_partkey AS obo, '<http://purl.obolibrary.org/obo/Sku_' || p_partkey || '>' AS url, "
    "'UMLS:' || p_partkey AS umls, replace(replace(replace(p_name || ',a-b', ',', '_'), '-', '_'), ' ', '_') AS snake, left(p_name || p_name, 10) || '...' AS short FROM (SELECT p_partkey, 'Sku:' || p_partkey AS c, p_name FROM part)",
)
def curie_functions(spark, d):
    c, k = catalog.curie("Sku", "p_partkey"), F.col("p_partkey").cast("string")
    return catalog.table(spark, d, "part").select(
        "p_partkey", X.upper_prefix(c).alias("upper_prefix"), X.local_part(c).alias("local_part"), X.upper_curie(c).alias("upper_curie"), X.url_to_curie(F.concat(F.lit("http://purl.obolibrary.org/obo/Obo_"), k)).alias("obo"),
        X.curie_to_obo(c).alias("url"), X.url_to_curie(F.concat(F.lit("http://linkedlifedata.com/resource/umls/"), k)).alias("umls"), X.snakify(F.concat("p_name", F.lit(",a-b"))).alias("snake"), X.shorten(F.concat("p_name", "p_name"), 10).alias("short"),
    )
