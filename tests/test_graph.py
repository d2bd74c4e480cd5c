"""Messages, export, sources and sinks, merging and checks."""

import json

import pytest
from pyspark.sql import functions as F

from cliquespark.functions import exprs
from cliquespark.operators import eqgraph, graph, kgx, mappers, merge, prefixes, quality
from cliquespark.operators.normalize import normalize
from cliquespark.sources import scan, settings, sinks, tables
from cliquespark.streaming.lookups import answer_table, normalize_stream
from tests.fixtures import CLIQUE, CLIQUES, small_index

ATTRS = graph.ATTRIBUTES


@pytest.fixture(scope="module")
def index(spark):
    return small_index(spark)


def attr(value, name="a"):
    return {"attribute_type_id": json.dumps(name), "value": json.dumps(value)}


NODES = f"msg_id string, pos int, node_id string, name string, categories array<string>, attributes {ATTRS}"
EDGES = f"msg_id string, pos int, edge_id string, subject string, predicate string, object string, attributes {ATTRS}, rest string"


@pytest.fixture(scope="module")
def message(spark):
    nodes = [("m", 0, "HGNC:11603", "n0", ["c"], [attr(1)]), ("m", 1, "NCBIGene:9496", "n1", ["c"], [attr(2)]), ("m", 2, "MONDO:0005002", "lung", None, None), ("m", 3, "DOID:3812", None, None, None), ("m", 4, "NODE:1", "kept", ["k"], None), ("m", 5, "nocolon", None, None, [attr(3)])]
    edges = [
        ("m", 0, "e0", "HGNC:11603", "p", "MONDO:0005002", [attr("x"), attr("y")], None),
        ("m", 1, "e1", "NCBIGene:9496", "p", "DOID:3812", [attr("y"), attr("x"), attr("x")], None),
        ("m", 2, "e2", "NCBIGene:9496", "p", "DOID:3812", None, None),
        ("m", 3, "e3", "HGNC:11603", None, "NODE:1", [], None),
        ("m", 4, "e4", "HGNC:11603", None, "NODE:1", [], None),
        ("m", 5, "e5", "HGNC:11603", "p", "ABSENT:1", None, None),
    ]
    return spark.createDataFrame(nodes, NODES), spark.createDataFrame(edges, EDGES)


def test_knowledge_graph(spark, index, message):
    out = graph.normalize_kgraph(*message, index)
    nodes = {r["node_id"]: r for r in out["nodes"].collect()}
    assert set(nodes) == {"UniProtKB:P1", "MONDO:0005002", "NODE:1"}
    gene = nodes["UniProtKB:P1"]
    assert gene["name"] == "protein name" and gene["categories"][0] == "biolink:Protein"
    assert [sorted(k.rsplit(".", 1)[1] for k in a) for a in gene["attributes"]] == [["1"] * 2, ["1"] * 5 if len(gene["attributes"][1]) == 5 else ["1"] * 4, ["2"] * 2, ["3"] * 2]
    assert json.loads(gene["attributes"][1]["value.1"])[0] == "UniProtKB:P1"
    lung = nodes["MONDO:0005002"]
    assert lung["name"] == "lung" and len(lung["attributes"]) == 2 and json.loads(lung["attributes"][1]["value"]) == round(78.35, 1)
    assert nodes["NODE:1"]["name"] == "kept" and nodes["NODE:1"]["attributes"] is None
    ids = {r["edge_id"]: r["kept_id"] for r in out["edge_id_map"].collect()}
    assert ids == {"e0": "e0", "e1": "e0", "e2": "e2", "e3": "e3", "e4": "e3", "e5": "e5"}
    kept = {r["edge_id"]: r for r in out["edges"].collect()}
    assert set(kept) == set(ids.values()) and kept["e0"]["subject"] == "UniProtKB:P1" and kept["e5"]["object"] == "ABSENT:1"


def test_attribute_signatures(spark):
    rows = [([attr(1)],), ([attr(2)],), (None,), ([],), ([attr(1), attr(1)],), ([{**attr(1), "value_type_id": ""}],), ([{**attr(1), "description": "d"}],)]
    got = [r[0] for r in spark.createDataFrame(rows, f"a {ATTRS}").select(graph.attribute_signature("a")).collect()]
    assert got[0] == got[4] == got[5] == got[6] and len({got[0], got[1], got[2], got[3]}) == 4


def test_objects_in_values_compare_by_content(spark, index):
    a = [{"attribute_type_id": '"x"', "value": '{"a": 1, "b": [1, 2.0]}'}]
    b = [{"value": '{"b":[1,2],"a":1}', "attribute_type_id": '"x"'}]
    c = [{"value": '{"b":[2,1],"a":1}', "attribute_type_id": '"x"'}]
    got = [r[0] for r in spark.createDataFrame([(a,), (b,), (c,)], f"a {ATTRS}").select(graph.attribute_signature("a")).collect()]
    assert got[0] == got[1] != got[2]
    nb = f"msg_id string, result_pos int, code_pos int, code string, bind_pos int, id string, attributes {ATTRS}, rest string"
    eb = "msg_id string, result_pos int, analysis_pos int, code_pos int, code string, bind_pos int, id string, rest string"
    nodes = spark.createDataFrame([("m", k, 0, "n", 0, "X", x, '{"q":1, "p": 2}' if k else '{"p": 2, "q": 1}') for k, x in enumerate((a, b, c))], nb)
    edges = spark.createDataFrame([("m", k, 0, 0, "e", 0, "E", None) for k in range(3)], eb)
    assert sorted(r["result_pos"] for r in graph.nested_results(nodes, edges).collect()) == [0, 2]
    one = lambda c: spark.range(1).select(c).first()[0]
    assert one(exprs.canonical_json(F.lit("not json"))) == "not json" and one(exprs.canonical_json(F.lit('{"b":[ 1.50 ],"a":null}'))) == '{"a":null,"b":[1.5]}'


@pytest.mark.parametrize(("count", "own", "new"), [(0, "1", "2"), (1, None, "3")])
def test_attribute_merge(spark, count, own, new):
    key = "k" if own else "k.1"
    row = spark.createDataFrame([([{key: "1"}], [{"k": "2"}])], f"a {ATTRS}, b {ATTRS}").select(graph.merge_attributes(F.col("a"), F.col("b"), F.lit(count)).alias("m")).first()
    assert row["m"] == [{f"k.{own}" if own else "k.1": "1"}, {f"k.{new}": "2"}]


def test_results(spark, index, message):
    nb = f"msg_id string, result_pos int, code_pos int, code string, bind_pos int, id string, attributes {ATTRS}, rest string"
    eb = "msg_id string, result_pos int, analysis_pos int, code_pos int, code string, bind_pos int, id string, rest string"
    nodes = [("m", r, k, c, b, i, None, None) for r in (0, 1) for k, c, b, i in ((0, "n0", 0, "HGNC:11603"), (0, "n0", 1, "NCBIGene:9496"), (1, "n1", 0, "DOID:3812"), (2, "n2", 0, "NCBIGene:9496"))]
    edges = [("m", r, 0, k, c, b, i, "x") for r in (0, 1) for k, c, b, i in ((0, "e", 0, "e1"), (0, "e", 1, "e0"), (1, "f", 0, "e1"))]
    parts = graph.Message(kg_nodes=message[0], kg_edges=message[1], node_bindings=spark.createDataFrame(nodes, nb), edge_bindings=spark.createDataFrame(edges, eb))
    fixed, compat = graph.normalize_message(parts, index), graph.normalize_message(parts, index, compat=True)
    count = lambda out, name: out[name].filter("result_pos = 0").count()
    assert count(fixed, "node_bindings") == 3 and count(compat, "node_bindings") == 2
    assert count(fixed, "edge_bindings") == 2 and count(compat, "edge_bindings") == 1
    assert fixed["results"].count() == compat["results"].count() == 1
    assert set(graph.normalize_message(graph.Message(), index)) == set()


NODE_BINDINGS = f"msg_id string, result_pos int, code_pos int, code string, bind_pos int, id string, attributes {ATTRS}, rest string"
EDGE_BINDINGS = "msg_id string, result_pos int, analysis_pos int, code_pos int, code string, bind_pos int, id string, rest string"


def test_whole_messages(spark, index):
    """Equal edges between unresolved nodes become one and so do their bindings, with what else they carry; sets of nodes stay sets."""
    nodes = [("dupe", 0, "N:1", "one", ["c"], None), ("dupe", 1, "N:2", "two", ["c"], None)]
    nodes += [("set", 0, "MONDO:0005002", "d", ["c"], None), ("set", 1, "D:1", "x", ["c"], None), ("set", 2, "D:2", "y", ["c"], None)]
    listed = [{"attribute_type_id": '"pubs"', "value": '["P:1", "P:2"]'}]
    edges = [("dupe", k, f"E{k + 1}", "N:1", "p", "N:2", [attr("x")], None) for k in range(2)]
    edges += [("set", k, f"T{k}", f"D:{k + 1}", "treats", "MONDO:0005002", listed, None) for k in range(2)]
    bound = [("dupe", 0, k, f"q{k}", 0, f"N:{k + 1}", None, '{"coalescence_method": "graph", "p_values": []}') for k in range(2)]
    bound += [("set", 0, 0, "disease", 0, "MONDO:0005002", None, None), ("set", 0, 1, "drug", 0, "D:1", None, None), ("set", 0, 1, "drug", 1, "D:2", None, None)]
    links = [("dupe", 0, 0, 0, "e", k, f"E{2 - k}", '{"properties": null}') for k in range(2)] + [("set", 0, 0, 0, "treats", k, f"T{k}", None) for k in range(2)]
    queried = [("dupe", "q0", ["N:1"], None), ("dupe", "q1", None, '{"is_set": true}'), ("set", "disease", ["DOID:3812"], None)]
    message = graph.Message(
        spark.createDataFrame(queried, "msg_id string, code string, ids array<string>, rest string"), spark.createDataFrame(nodes, NODES), spark.createDataFrame(edges, EDGES),
        spark.createDataFrame(bound, NODE_BINDINGS), spark.createDataFrame(links, EDGE_BINDINGS),
    )
    out = graph.normalize_message(message, index)
    rows = lambda name, *c: sorted(tuple(r) for r in out[name].select(*c).collect())
    assert rows("qnodes", "msg_id", "code", F.to_json("ids"), "rest") == [("dupe", "q0", '["N:1"]', None), ("dupe", "q1", None, '{"is_set": true}'), ("set", "disease", '["MONDO:0005002"]', None)]
    assert rows("edges", "msg_id", "edge_id") == [("dupe", "E1"), ("set", "T0"), ("set", "T1")]
    assert rows("edge_bindings", "msg_id", "code", "id", "rest") == [("dupe", "e", "E1", '{"properties": null}'), ("set", "treats", "T0", None), ("set", "treats", "T1", None)]
    assert rows("node_bindings", "msg_id", "code", "id") == [("dupe", "q0", "N:1"), ("dupe", "q1", "N:2"), ("set", "disease", "MONDO:0005002"), ("set", "drug", "D:1"), ("set", "drug", "D:2")]
    assert out["results"].count() == 2 and out["nodes"].count() == 5
    assert all("coalescence_method" in r["result"] for r in out["results"].filter("msg_id = 'dupe'").collect())


def test_query_graph(spark, index):
    q = spark.createDataFrame([("m", "a", ["HGNC:11603", "NCBIGene:9496", "Q:1"], None), ("m", "b", None, None)], "msg_id string, code string, ids array<string>, rest string")
    got = {r["code"]: r["ids"] for r in graph.normalize_qgraph(q, index).collect()}
    assert got == {"a": ["Q:1", "UniProtKB:P1"], "b": None}


def test_kgx(spark):
    cliques = spark.createDataFrame(CLIQUES, CLIQUE)
    edges = [(r["subject"], r["object"]) for r in kgx.kgx_edges(cliques.filter("file_idx = 0 and line_no = 4")).collect()]
    assert edges == [("NCBIGene:9496", "HGNC:11603"), ("NCBIGene:9496", "nocolon"), ("HGNC:11603", "nocolon")]


def test_compendium_files(spark, tmp_path):
    good, bad = tmp_path / "a.txt", tmp_path / "b.txt"
    good.write_text("".join(json.dumps({"type": "t", "ic": 5, "identifiers": [{"i": f"A:{k}", "l": "x"}]}) + "\n" for k in range(7)))
    bad.write_text(json.dumps({"id": {"identifier": "A:1"}, "equivalent_identifiers": [], "type": ["t"]}) + "\n")
    assert scan.is_compendium(spark, str(good)) and not scan.is_compendium(spark, str(bad))
    rows = scan.scan_compendium(spark, [str(bad), str(good)]).orderBy("line_no").collect()
    assert [r["identifiers"][0]["i"] for r in rows] == [f"A:{k}" for k in range(7)] and rows[0]["ic"] == "5"
    with pytest.raises(scan.InvalidFile):
        scan.scan_compendium(spark, [str(bad)], strict=True)
    # names with blanks, and one that ends like another; a missing file is warned of
    for k, name in enumerate(("Gene Protein.txt", "Protein.txt", "Gene+Protein.txt")):
        (tmp_path / name).write_text(json.dumps({"type": "t", "identifiers": [{"i": f"N:{k}"}]}) + "\n")
    paths = scan.compendium_paths(str(tmp_path), ["Gene Protein.txt", "absent.txt", "Protein.txt", "Gene+Protein.txt"])
    with pytest.warns(UserWarning, match="file not found: absent.txt"):
        found = scan.scan_compendium(spark, paths)
    assert sorted((r["identifiers"][0]["i"], r["file_idx"]) for r in found.collect()) == [("N:0", 0), ("N:1", 2), ("N:2", 3)]
    (tmp_path / "empty.txt").write_text("")
    with pytest.raises(scan.InvalidFile, match="is empty"):
        scan.scan_compendium(spark, [str(tmp_path / "empty.txt")])
    lists = tmp_path / "c.txt"
    lists.write_text('["A", "B"]\n["B", "C"]\n')
    assert {r["member"]: r["members"] for r in scan.scan_conflation(spark, str(lists), "n").collect()} == {"A": ["A", "B"], "B": ["B", "C"], "C": ["B", "C"]}


def test_settings(spark, index, tmp_path):
    (tmp_path / "comps").mkdir()
    (tmp_path / "confs").mkdir()
    for k, name in enumerate(("B.txt", "A.txt")):
        (tmp_path / "comps" / name).write_text(json.dumps({"type": "biolink:Gene", "identifiers": [{"i": f"N:{k}", "l": name}, {"i": "SAME:1"}]}) + "\n")
    (tmp_path / "confs" / "GeneProtein.txt").write_text('["N:0", "N:1"]\n')
    made = {"compendium_directory": str(tmp_path / "comps"), "conflation_directory": str(tmp_path / "confs"), "redis_host": "x", "data_files": ["B.txt", "A.txt"], "conflations": [{"types": [], "file": "GeneProtein.txt", "redis_db": "x"}], "test_mode": 0, "preferred_name_boost_prefixes": {"t": ["X"]}, "demote_labels_longer_than": 9}
    (tmp_path / "config.json").write_text(json.dumps(made, indent=1))
    found = settings.load_settings(spark, str(tmp_path / "config.json"))
    assert found.data_files == ("B.txt", "A.txt") and found.conflations == (("GeneProtein", "GeneProtein.txt"),) and not found.dry_run
    assert found.config.boost_prefixes == {"t": ("X",)} and found.config.demote_labels_longer_than == 9 and found.config.conflations == ("GeneProtein",)
    built = settings.index_from_settings(spark, found, index.type_ancestors)
    got = normalize(spark.createDataFrame([("same:1",), ("n:1",)], "curie string"), built, conflate=False).collect()
    assert {r["curie"]: r["identifier"] for r in got} == {"same:1": "N:1", "n:1": "N:1"}


def test_intermediate_tables_are_released(spark):
    kept = dict(tables._WRITTEN)
    tables._WRITTEN.clear()
    df = tables.materialize(spark.range(3), "some")
    assert df.count() == 3 and tables.release(spark) == 1
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        spark.read.parquet(df.inputFiles()[0]).count()
    tables._WRITTEN.update(kept)


def test_source_files(spark, tmp_path):
    (tmp_path / "b.csv").write_text('x:1,T,,,,Name,,8th\nshort,row\n\nx:2,T,,,,N2,,8,Own\nx:3,"a, b",,,,"say ""x""",,\nx:4,"a,b,c,d,e,f,g,h",,\nx:5,T,,,,N5,,8,\n')
    assert [tuple(r) for r in scan.scan_biokde(spark, str(tmp_path / "b.csv")).collect()] == [("x:1", "T", "Name", "BioKDE"), ("x:2", "T", "N2", "Own"), ("x:3", "a, b", 'say "x"', "BioKDE"), ("x:5", "T", "N5", "")]
    (tmp_path / "s.csv").write_text("0,1,2,C1,name,type,6,7,8,9,10,11,\n0,1,2,C2,n,t,6,7,8,9,10,11\n0,1,2,C3,n,t,6,7,8,9,10,11,S,more\n")
    assert [tuple(r) for r in scan.scan_semmeddb(spark, str(tmp_path / "s.csv")).collect()] == [("C1", "type", "name", ""), ("C3", "t", "n", "S")]
    (tmp_path / "i.csv").write_text("id,type,external_id,official_name\n1,Gene,NCBI:5,\n")
    assert [tuple(r) for r in scan.scan_ikraph(spark, str(tmp_path / "i.csv")).collect()] == [("NCBI:5", "Gene", "", "iKGraph")]
    (tmp_path / "p.csv").write_text('node_id,node_type,node_name,node_source\n1,drug,"a, b",DrugBank\n')
    assert [tuple(r) for r in scan.scan_primekg(spark, str(tmp_path / "p.csv")).collect()] == [("1", "drug", "a, b", "PrimeKG")]
    assert [tuple(r) for r in scan.scan_primekg_sources(spark, str(tmp_path / "p.csv")).collect()] == [("1", "drug", "a, b", "DrugBank")]
    (tmp_path / "c.csv").write_text("input_curie\n A:1 \n\nB:2\n")
    assert [r[0] for r in scan.scan_curies(spark, str(tmp_path / "c.csv")).collect()] == ["A:1", "B:2"]
    assert [r[0] for r in scan.scan_curies(spark, str(tmp_path / "c.csv"), 1).collect()] == ["A:1"]
    (tmp_path / "n.json").write_text(json.dumps({"A:1": {"id": {"identifier": "A:1"}, "equivalent_identifiers": [{"identifier": "A:1"}], "type": ["t"]}}, indent=1))
    assert scan.scan_normalized(spark, str(tmp_path / "n.json")).first()["id"]["identifier"] == "A:1"


def test_index_round_trip(spark, index, tmp_path):
    back = sinks.write_index(index, str(tmp_path / "index"), 2)
    sizes = {r["table_name"]: (r["n_files"], r["bytes"]) for r in prefixes.stored_sizes(back).collect()}
    files = list((tmp_path / "index" / "curie_map").glob("*.parquet"))
    assert sizes["curie_map"] == (len(files), sum(f.stat().st_size for f in files)) and len(sizes) == 5
    assert sorted(back.curie_map.collect()) == sorted(index.curie_map.collect())
    assert sorted(back.conflation.select("name", "member", "members").collect()) == sorted(index.conflation.collect())
    assert sinks.write_index(index, str(tmp_path / "none"), dry_run=True) is index and not (tmp_path / "none").exists()


def test_stream(spark, index, tmp_path):
    spark.createDataFrame([("doid:3812",), ("HGNC:11603",), ("nothing",)], "curie string").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("curie string").parquet(str(tmp_path / "in"))
    answers = answer_table(index, ("GeneProtein", "DrugChemical"))
    whole = normalize(spark.createDataFrame([("doid:3812",), ("HGNC:11603",)], "curie string"), index, drug_chemical_conflate=True)
    expected = {r["curie"]: (r["identifier"], r["label"], r["types"]) for r in whole.collect()}
    query = normalize_stream(stream, index, answers).writeStream.format("memory").queryName("answers").start()
    query.processAllAvailable()
    query.stop()
    got = {r["curie"]: (r["identifier"], r["label"], r["types"]) for r in spark.table("answers").collect()}
    assert got == {**expected, "nothing": (None, None, None)} and expected["HGNC:11603"][0] == "UniProtKB:P1"


def test_mappers(spark):
    rows = [(0, " MONDO:1 ", "disease", "n", "X"), (1, "NCBIGene:1", "gene/protein", "n", "NCBI"), (2, "7", "disease", "", "MONDO_grouped"), (3, "7", "disease", "n", "nowhere"), (4, "C1234567", None, None, None), (5, None, "drug", "n", "GO")]
    df = spark.createDataFrame(rows, "pos int, node_id string, node_type string, node_name string, node_source string")
    got = [r[0] for r in df.orderBy("pos").select(mappers.map_by_source()).collect()]
    assert got == ["MONDO:1", "NCBIGene:NCBIGene:1", "MONDO:7", None, None, "GO:"]
    assert [r[0] for r in df.orderBy("pos").select(mappers.map_semmeddb()).collect()][4] == "UMLS:C1234567"
    assert mappers.compendium_records(df, 1).count() == 3
    assert {r["node_type"]: r["n_seen"] for r in mappers.mapping_counts(df).collect()}["disease"] == 3
    assert mappers.unmapped_examples(df).filter("node_type = 'disease'").first()["example"] == "7 (n) [source: nowhere]"


def test_text_functions(spark):
    one = lambda c: spark.range(1).select(c).first()[0]
    assert one(exprs.url_to_curie(F.lit("http://identifiers.org/hgnc/5"))) == "HGNC:5"
    assert one(exprs.url_to_curie(F.lit("http://www.orpha.net/ORDO/Orphanet_5"))) == "Orphanet:5"
    assert one(exprs.local_part(F.lit("a:b:c"))) == "b:c" and one(exprs.local_part(F.lit("abc"))) == "abc"
    assert one(exprs.upper_prefix(F.lit("abc"))) is None and one(exprs.upper_curie(F.lit("ab:c:d"))) == "AB:c:d"
    assert one(exprs.snakify(F.lit("a,b-c d  e"))) == "a_b_c_d_e" and one(exprs.shorten(F.lit("x" * 90))) == "x" * 80 + "..."
    assert one(exprs.gene_local(F.lit("http://x/y/5"))) == "5" and one(exprs.curie_to_obo(F.lit("A:1"))) == "<http://purl.obolibrary.org/obo/A_1>"
    assert one(exprs.confidence(F.lit(3), F.lit(2), 0.6, 0.1)) == min(1.0, 0.6 + min(0.2, 3 * 0.05) + min(0.1, 2 * 0.01) + 0.1)


ENTITY = "entity_id string, label string, types array<string>, equivalents array<struct<identifier: string, label: string>>"


def test_merging(spark):
    a = spark.createDataFrame([("1", "one", ["biolink:GeneFamily"], [("1", "x")]), ("2", "two", ["biolink:Disease"], [("2", "x")])], ENTITY)
    b = spark.createDataFrame([("2", "zwei", ["biolink:Gene", "t"], [("2", "y"), ("3", "y"), ("3", "y"), ("4", "y"), ("5", "y")]), ("3", "drei", [], [])], ENTITY)
    union = {r["entity_id"]: r for r in merge.merge_union(a, b, "A", "B").collect()}
    assert [x["identifier"] for x in union["2"]["equivalents"]] == ["2", "3", "3", "4", "5"] and union["2"]["label"] == "two" and union["2"]["sources"] == ["A", "B"]
    assert [r["entity_id"] for r in merge.merge_intersection(a, b).collect()] == ["2"]
    won = {r["entity_id"]: r for r in merge.merge_confidence(a, b, 0.45, "A", "B").collect()}
    assert won["2"]["label"] == "zwei" and won["3"]["sources"] == ["B"]
    best = {r["entity_id"]: r for r in merge.merge_type_priority({"A": a, "B": b}).collect()}
    assert best["2"]["label"] == "zwei" and best["1"]["priority"] == 10 and best["3"]["priority"] == 0 and best["2"]["sources"] == ["A", "B"]
    assert merge.source_counts(merge.merge_union(a, b)).first().asDict() == {"only_a": 1, "only_b": 1, "both": 1}


def test_checks(spark):
    rows = [("1", "1", "one", ["biolink:A"], [("1", "x")], ["A"]), ("2", "9", None, ["bad"], [("9", None)], ["A", "B"]), ("3", None, None, None, None, None)]
    df = spark.createDataFrame(rows, "entity_id string, identifier string, label string, types array<string>, equivalents array<struct<identifier: string, label: string>>, sources array<string>")
    issues = {(r["entity_id"], r["rule"], r["detail"]) for r in quality.integrity_issues(df).collect()}
    assert issues == {("2", "malformed_id", ""), ("2", "malformed_equivalent", "0"), ("2", "invalid_type", "bad")} | {("3", "missing_field", n) for n in quality.REQUIRED}
    assert {(r[0], r[1]) for r in quality.consistency_issues(df).collect()} == {("2", "key_mismatch"), ("2", "not_in_equivalents")}
    assert {r["identifier"]: (r["n_entities"], r["distinct_entities"]) for r in quality.duplicate_identifiers(df).collect()} == {"1": (2, 1), "9": (2, 1)}


def test_equivalence_graph(spark):
    links = {"a": "bc", "b": "c", "c": "d", "d": "", "e": "f", "f": "e", "g": "gz"}
    df = spark.createDataFrame([(k, [(x, x) for x in v]) for k, v in links.items()], "entity_id string, equivalents array<struct<identifier: string, label: string>>")
    assert {tuple(r) for r in eqgraph.equivalence_edges(df).collect()} == {("a", "b"), ("a", "c"), ("b", "c"), ("c", "d"), ("e", "f")}
    assert {r["component"]: r["n"] for r in eqgraph.component_sizes(df).collect()} == {"a": 4, "e": 2, "g": 1}
    got = {r["metric"]: r["value"] for r in eqgraph.graph_summary(df).collect()}
    assert (got["nodes"], got["edges"], got["components"]) == (7, 5, 3) and abs(got["average_clustering"] - (1 + 1 + 1 / 3) / 7) < 1e-9


def test_graph_files(spark, tmp_path):
    df = spark.createDataFrame([("a", 'an "a" & b', [("b", "x")]), ("b", None, [("a", "x"), ("z", "x")]), ("c", "c", [])], ENTITY.replace("types array<string>, ", ""))
    vertices, edges = eqgraph.graph_tables(df)
    names = {r["id"]: r["entity_id"] for r in vertices.collect()}
    assert sorted(names.values()) == ["a", "b", "c"] and [(names[r[0]], names[r[1]]) for r in edges.collect()] == [("a", "b")]
    eqgraph.write_gml(df, str(tmp_path / "gml"))
    text = "".join(p.read_text() for p in sorted((tmp_path / "gml").glob("part-*")))
    lines = text.splitlines()
    assert lines[0] == "graph [" and lines[-1] == "]" and len(lines) == 6
    assert sum(x.startswith("  node [ id ") for x in lines[1:4]) == 3 and lines[4].startswith("  edge [ source ")
    assert '"an &quot;a&quot; &amp; b"' in text


def test_reports(spark, tmp_path):
    rows = [(0, "1", "disease", "n", "MONDO"), (1, "7", "disease", "n", "nowhere"), (2, "2", "drug", None, "DrugBank")]
    df = spark.createDataFrame(rows, "pos int, node_id string, node_type string, node_name string, node_source string")
    report = mappers.mapping_report(df)
    assert tuple(report["totals"].first()) == (3, 2, 100.0 * 2 / 3)
    sinks.write_report(report, str(tmp_path / "mapping"))
    assert spark.read.json(str(tmp_path / "mapping" / "types")).count() == 2 and spark.read.json(str(tmp_path / "mapping" / "unmapped")).first()["example"] == "7 (n) [source: nowhere]"
    assert mappers.mapping_totals(df.limit(0)).first()["percent"] == 0
    merged = spark.createDataFrame([("1", "1", "one", ["biolink:A"], [("1", "x")], ["A"])], "entity_id string, identifier string, label string, types array<string>, equivalents array<struct<identifier: string, label: string>>, sources array<string>")
    sinks.write_report(quality.quality_report(merged), str(tmp_path / "quality"))
    assert {r["metric"]: r["value"] for r in spark.read.json(str(tmp_path / "quality" / "metrics")).collect()}["total"] == 1


def test_exports(spark, index, tmp_path):
    cliques = spark.createDataFrame(CLIQUES, CLIQUE)
    kgx.export_kgx(cliques, index.type_ancestors, str(tmp_path / "kgx"))
    assert spark.read.json(str(tmp_path / "kgx" / "edges")).count() == kgx.kgx_edges(cliques).count()
    assert set(spark.read.json(str(tmp_path / "kgx" / "nodes")).columns) == {"id", "name", "category", "equivalent_identifiers"}
    answers = normalize(spark.createDataFrame([("doid:3812",), ('odd"one',)], "curie string"), index)
    sinks.write_normalized_json(answers, str(tmp_path / "json"))
    back = {r["entity_id"]: r["id"] for r in scan.scan_normalized(spark, str(tmp_path / "json"), lines=True).collect()}
    assert back['odd"one'] is None and back["doid:3812"]["identifier"] == "MONDO:0005002"
    sinks.write_compendium(mappers.csv_record(spark.createDataFrame([("1", "disease", "", "own")], "node_id string, node_type string, node_name string, node_source string"), mappers.map_primekg(), "primekg"), str(tmp_path / "c"))
    assert spark.read.text(str(tmp_path / "c")).first()[0] == '{"type":"biolink:disease","identifiers":[{"i":"MONDO:1","l":"MONDO:1"}]}'
