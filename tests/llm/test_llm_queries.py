"""Registered queries of the subpackage against DuckDB, where SQL can express them."""

import glob

import pytest
from compare import connect, difference

from cohortbench.llm.oracles import ORACLES
from cohortbench.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    if not glob.glob(f"{SF}/*.parquet"):
        pytest.skip("no driver tables")
    return connect(SF)


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_matches_sql(spark, con, name):
    assert difference(QUERIES[name](spark, SF), con, ORACLES[name]) is None


NATIVE = ["op1_url_rules", "op2_pii_spans", "op3_pfair_mix", "op10_chat_snapshots"]


@pytest.mark.parametrize("name", NATIVE)
def test_native_queries_run_no_python(spark, con, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    for node in ("Python", "InPandas", "InArrow", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in plan, node
