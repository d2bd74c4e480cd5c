"""Index, normalization, set identifiers and prefix statistics."""

import pytest
from pyspark.sql import functions as F

from cliquespark.functions import exprs
from cliquespark.operators import normalize as N
from cliquespark.operators import prefixes, setid
from cliquespark.plans.schema import ALLOWED_CONFLATIONS
from tests.fixtures import small_index

GP, DC = "GeneProtein", "DrugChemical"


@pytest.fixture(scope="module")
def index(spark):
    made = small_index(spark)
    for df in made.tables().values():
        df.cache()
    return made


def ask(spark, index, *curies, **options):
    rows = N.normalize(spark.createDataFrame([(c,) for c in curies], "curie string"), index, **options).collect()
    return {r["curie"]: r for r in rows}


def test_case_is_ignored_and_unknown_is_null(spark, index):
    got = ask(spark, index, "doid:3812", "MONDO:0005002", "Doid:3813", "UNKNOWN:1", "doid:3812", conflate=False)
    assert len(got) == 4
    assert got["doid:3812"]["identifier"] == got["MONDO:0005002"]["identifier"] == "MONDO:0005002"
    assert got["Doid:3813"]["identifier"] == "MONDO:0005003"
    assert got["UNKNOWN:1"]["identifier"] is None and got["UNKNOWN:1"]["types"] is None


def test_last_write_wins_for_keys_and_counts_keep_every_occurrence(index):
    keys = {r["curie_key"]: r["canonical_id"] for r in index.curie_map.collect()}
    assert keys["SAME:1"] == "MONDO:0000010" and keys["MONDO:0000009"] == "MONDO:0000010"
    counts = {(r["semantic_type"], r["prefix"]): r["cnt"] for r in prefixes.merged_prefix_counts(index).collect()}
    assert counts["biolink:Disease", "SAME"] == 1 and counts["biolink:Disease", "same"] == 1
    assert counts["biolink:Gene", "nocolon"] == 1 and counts["biolink:NamedThing", "MONDO"] == 5


def test_information_content_is_rounded_as_python_does(spark, index):
    got = ask(spark, index, "MONDO:0005002", "UNII:63M8RYN44N", "SAME:1", conflate=False)
    assert got["MONDO:0005002"]["information_content"] == round(78.35, 1)
    assert got["UNII:63M8RYN44N"]["information_content"] == 0.2
    assert got["SAME:1"]["information_content"] is None
    stored = {r["canonical_id"]: r["ic"] for r in index.cliques.collect()}
    assert stored["MONDO:0000009"] == round(1.05, 1)


def test_types_and_individual_types(spark, index):
    got = ask(spark, index, "UNII:63M8RYN44N", "X:2", "HGNC:11603", conflate=True, individual_types=True)
    assert got["UNII:63M8RYN44N"]["types"][0] == "biolink:SmallMolecule" and "biolink:Entity" not in got["UNII:63M8RYN44N"]["types"]
    assert got["X:2"]["types"] == ["biolink:NamedThing"] and {x["type"] for x in got["X:2"]["equivalent_identifiers"]} == {None}
    assert [x["type"] for x in got["HGNC:11603"]["equivalent_identifiers"]] == ["biolink:Protein"] * 2 + ["biolink:Gene"] * 3


def test_labels(spark, index):
    got = ask(spark, index, "X:1", "CHEBI:15377", "UNII:63M8RYN44N", "MONDO:0005002", "PR:1", conflate=False)
    assert got["X:1"]["label"] == "drug"
    assert got["CHEBI:15377"]["label"] == "WATER" and got["UNII:63M8RYN44N"]["label"] == "WATER O 15"
    assert got["MONDO:0005002"]["label"] is None
    assert got["PR:1"]["label"] == "protein name"


def test_boosted_prefixes_are_preferred(spark):
    ids = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(label).alias("l")) for i, label in (("Z:1", "z"), ("B:1", "b"), ("A:1", "a"), ("B:2", "b2"))])
    row = spark.range(1).select(exprs.boosted(ids, F.array(F.lit("A"), F.lit("B"))).alias("s"), exprs.preferred_label(ids, F.array(F.lit("t")), {"t": ("A", "B")}, 15).alias("l")).first()
    assert [x["i"] for x in row["s"]] == ["A:1", "B:1", "B:2", "Z:1"] and row["l"] == "a"


def test_conflation(spark, index):
    got = ask(spark, index, "UNII:63M8RYN44N", "HGNC:11603", conflate=True, drug_chemical_conflate=True)
    water, gene = got["UNII:63M8RYN44N"], got["HGNC:11603"]
    assert water["identifier"] == "CHEBI:15377" and water["label"] == "WATER" and water["information_content"] == 0.2
    assert [x["identifier"] for x in water["equivalent_identifiers"]] == ["CHEBI:15377", "PUBCHEM.COMPOUND:10129877", "UNII:63M8RYN44N"]
    assert gene["identifier"] == "UniProtKB:P1" and gene["label"] == "protein name"
    assert gene["types"] == ["biolink:Protein", "biolink:NamedThing", "biolink:Gene"]
    plain = ask(spark, index, "UNII:63M8RYN44N", conflate=True)
    assert plain["UNII:63M8RYN44N"]["identifier"] == "PUBCHEM.COMPOUND:10129877"


def test_answers_do_not_depend_on_the_batch(spark, index):
    alone = ask(spark, index, "UNII:63M8RYN44N", drug_chemical_conflate=True)["UNII:63M8RYN44N"]
    together = ask(spark, index, "UNII:63M8RYN44N", "PUBCHEM.COMPOUND:10129877", "CHEBI:15377", drug_chemical_conflate=True)["UNII:63M8RYN44N"]
    assert alone == together


def test_normalizing_twice_changes_nothing(spark, index):
    once = ask(spark, index, "doid:3812", "hgnc:11603", "X:2", conflate=False)
    again = ask(spark, index, *[r["identifier"] for r in once.values()], conflate=False)
    assert {r["identifier"] for r in again.values()} == set(again)


def test_descriptions(spark, index):
    got = ask(spark, index, "UNII:63M8RYN44N", descriptions=True, conflate=False)["UNII:63M8RYN44N"]
    assert got["description"] == "a kind of water" and [x["description"] for x in got["equivalent_identifiers"]] == [None, "a kind of water"]
    assert ask(spark, index, "UNII:63M8RYN44N", conflate=False)["UNII:63M8RYN44N"]["description"] is None


def test_small_inputs_give_the_same(spark, index):
    asked = spark.createDataFrame([("doid:3812",), ("UNKNOWN:1",)], "curie string")
    assert sorted(N.normalize(asked, index).collect()) == sorted(N.normalize_small(asked, index).collect())


def test_no_python_on_the_lookup_path(spark, index):
    plan = N.normalize(spark.createDataFrame([("a",)], "curie string"), index)._jdf.queryExecution().executedPlan().toString()
    assert "EvalPython" not in plan.split("InMemoryRelation")[0]


# The numbers of a published set of a hundred unknown identifiers.
HUNDRED = """
    10111 10444 11018 11207 11304 11782 12572 13051 13237 14093 15815 15816 16589 17439 18228 18425 19841 21080 21874 23971
    24788 27338 27651 28744 29904 29972 31799 32169 33554 35060 36508 36822 36823 37847 37939 38292 39315 40687 42114 46486
    47029 48712 50159 50607 52910 52926 54177 56239 57302 58851 59644 59711 60525 61006 62554 63257 64822 65196 68589 68594
    68679 69092 70919 71057 71390 71720 71911 72510 73285 73348 74530 74772 75316 75654 75665 76080 76813 79128 79791 80884
    81324 81351 82342 84666 84725 87724 88546 93274 93668 94750 95196 95403 95994 97287 97410 97930 98753 98994 99397 99691
""".split()
REQUEST = "key int, curies array<string>, conflations array<string>"


def sets(spark, index, *requests):
    rows = setid.set_id(spark.createDataFrame([(k, *r) for k, r in enumerate(requests)], REQUEST), index).collect()
    return [r for r in sorted(rows)]


def test_published_set_identifiers(spark, index):
    first = ["DOID:3812", "MONDO:0005002", "MONDO:0005003", "UNII:63M8RYN44N", ""]
    odd = ["!#lk1l4", "09s90ma!:391nasa01AAa", "10.31", "9018", "-913"]
    rubbish = [f"RUBBISH:{n}" for n in reversed(HUNDRED)]
    got = sets(spark, index, (first, [GP]), (first, [GP, DC]), (odd, [GP, DC]), (rubbish, None), (first, ["DrugChemic"]), (["X:9", "X:9"], []))
    assert got[0]["normalized_string"] == "||MONDO:0005002||MONDO:0005003||PUBCHEM.COMPOUND:10129877"
    assert got[0]["setid"] == "uuid:08da0da0-4b47-55e6-b9b2-73ead9921494"
    assert got[1]["setid"] == "uuid:4b54135a-a151-561b-8b25-8a5a5b710700"
    assert got[2]["setid"] == "uuid:2fe78021-4a98-53cc-b911-a55962575095"
    assert got[3]["setid"] == "uuid:c81cd168-996a-5ca7-8107-2c82c36232fe"
    assert got[4]["setid"] is None and setid.ERROR in got[4]["error"]
    assert got[5]["normalized_string"] == "X:9||X:9"


def test_uuid5_is_pythons(spark):
    import uuid

    names = ["", "a", "é||日本", "x" * 1_000]
    rows = spark.createDataFrame([(n,) for n in names], "n string").select("n", exprs.uuid5("n").alias("u")).collect()
    assert all(r["u"] == str(uuid.uuid5(uuid.UUID(exprs.SET_NAMESPACE), r["n"])) for r in rows)


def test_sets_do_not_depend_on_order(spark, index):
    a, b = sets(spark, index, (["CHEBI:15377", "Q:2", "Q:1"], []), (["Q:1", "chebi:15377", "Q:2"], []))
    assert a["setid"] == b["setid"]


def test_prefix_reports(spark, index):
    asked = spark.createDataFrame([("biolink:Gene",), ("nothing",)], "semantic_type string")
    got = {r["semantic_type"]: r["curie_prefix"] for r in prefixes.curie_prefixes(index, asked).collect()}
    assert got == {"biolink:Gene": {"HGNC": "1", "NCBIGene": "1", "nocolon": "1"}, "nothing": None}
    assert {r[0] for r in prefixes.semantic_types(index).collect()} >= {"biolink:Gene", "biolink:NamedThing"}
    assert {r["table_name"]: r["n_rows"] for r in prefixes.status(index).collect()}["cliques"] == 9
    assert ALLOWED_CONFLATIONS == (GP, DC)
