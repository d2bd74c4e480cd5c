"""The registered queries against SQL, at the smallest scale."""

import os

import pytest

import __spark_entry__ as entry
from cliquespark.plans import catalog_queries

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")
SAMPLE = ["normalize_basic", "normalize_conflate_both", "index_last_write_wins", "set_id_conflated", "kg_nodes", "kg_edges_dedup", "merge_confidence", "eq_graph_components", "eq_graph_summary", "results_dedup", "kg_edge_signatures", "kg_node_notes", "normalize_descriptions", "normalize_fallback_types", "quality_report", "kgx_edges", "curie_functions"]


def rows(pdf):
    return sorted(str([None if x is None or x != x else x for x in r]) for r in pdf[sorted(pdf.columns)].astype(object).itertuples(index=False))


@pytest.mark.parametrize("name", SAMPLE)
def test_against_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    db = duckdb.connect()
    for f in os.listdir(SF):
        db.sql(f"create view {f.split('.')[0]} as select * from '{SF}/{f}'")
    got, expected = entry.queries()[name](spark, SF).toPandas(), db.sql(entry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(expected.columns) and rows(got) == rows(expected)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_registry():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(catalog_queries.QUERIES) == set(catalog_queries.ORACLE_SQL)
