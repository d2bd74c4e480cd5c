"""Plans: what is read and shuffled, and that nothing is a product of two tables."""

import os

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables here")
#: Most scans of files that a plan may have.
SCANS = {"normalize_basic": 8, "set_id": 8, "set_id_conflated": 12, "kg_nodes": 8, "kg_edges_dedup": 6, "edge_id_map": 4, "results_dedup": 4, "qgraph_ids": 14}


@pytest.mark.parametrize("name", sorted(SCANS))
def test_plans_read_each_table_few_times(spark, name):
    plan = entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") <= SCANS[name]
    assert "Cartesian" not in plan and "NestedLoop" not in plan and "Python" not in plan and "Pandas" not in plan
    assert "ReadSchema" in plan
