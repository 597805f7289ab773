"""Registered queries against DuckDB, and the shape of their plans."""

import glob
import re

import pytest
from compare import connect, difference

import __spark_entry__ as contract
from cohortbench.plans import orderbook, surveyed
from cohortbench.plans.queries import QUERIES, load_audit, published

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    if not glob.glob(f"{SF}/*.parquet"):
        pytest.skip("no driver tables")
    return connect(SF)


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in surveyed.QUERIES])
def test_query_matches_sql(spark, con, name):
    assert difference(QUERIES[name](spark, SF), con, contract.oracle_sql()[name]) is None


@pytest.fixture(scope="module")
def survey(spark, con):
    return surveyed.build(spark, SF)


@pytest.mark.parametrize("name", list(surveyed.QUERIES))
def test_survey_query_matches_sql(spark, con, survey, name):
    rows = published(surveyed.QUERIES[name](spark, SF, survey))
    assert difference(rows, con, contract.oracle_sql()[name]) is None


def test_entry_and_registry(spark, con):
    assert set(contract.oracle_sql()) <= set(contract.queries()) and set(QUERIES) <= set(contract.oracle_sql())
    assert contract.entry(spark).count() > 0


def executed(df):
    """Physical plan text as first planned, without any broadcast."""
    spark = df.sparkSession
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return df.select("*")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_fact_shuffles_each_input_once(spark, con):
    plan = executed(orderbook.outcomes(spark, SF))
    # Lines by order, orders by order, entity-years from lines, entity-years from orders.
    assert plan.count("Exchange hashpartitioning") == 4
    assert len(re.findall(r"FileScan parquet .*l_orderkey", plan)) == 1


def test_lines_are_aggregated_before_their_shuffle(spark, con):
    plan = executed(orderbook.line_counts(spark, SF))
    scan = plan.index("l_linestatus")
    shuffle = plan.index("Exchange hashpartitioning(l_orderkey")
    assert shuffle < scan and "partial_sum" in plan[shuffle:scan]


def test_only_needed_columns_are_read(spark, con):
    plan = executed(orderbook.outcomes(spark, SF).select("entity_id", "year", "grad_rate"))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert all("l_extendedprice" not in s and "o_totalprice" not in s for s in schemas)
    lines = next(s for s in schemas if "l_orderkey" in s)
    assert "l_linenumber" not in lines


def test_newest_year_is_pushed_to_the_scan(spark, con):
    plan = executed(orderbook.newest_profile(spark, SF))
    assert "GreaterThanOrEqual(o_orderdate,ScalarSubquery" in plan


def test_one_year_of_the_fact_reads_one_year(spark, con):
    plan = executed(orderbook.fact(spark, SF, latest=True))
    scans = re.findall(r"FileScan parquet [^\n]*o_orderdate[^\n]*", plan)
    assert scans and all("GreaterThanOrEqual(o_orderdate" in s or "IsNotNull(o_orderdate)" not in s for s in scans)
    assert plan.index("LeftSemi") > plan.index("partial_sum(")  # below the sums: lines go first


def test_years_of_the_audit_come_from_the_data(spark, tmp_path):
    day = "timestamp'%d-03-01 00:00:00'"
    spark.sql(f"SELECT 1L o_orderkey, 1L o_custkey, 'F' o_orderstatus, 1.0D o_totalprice, {day % 1980} o_orderdate, "
              f"'x' o_orderpriority UNION ALL SELECT 2L, 1L, 'F', 1.0D, {day % 1983}, 'x'").write.parquet(
        str(tmp_path / "orders.parquet"))
    spark.sql(f"SELECT 1L l_orderkey, {day % 1982} l_shipdate").write.parquet(str(tmp_path / "lineitem.parquet"))
    got = {(r.family, r.year): r.status for r in load_audit(spark, str(tmp_path)).collect()}
    assert {k for k, s in got.items() if s == "ok"} == {("orders", 1980), ("orders", 1983)}
    assert got["lineitem", 1982] == "empty" and got["lineitem", 1984] == "not_published" and len(got) == 10


def test_windows_are_pushed_to_the_scan(spark, con):
    plan = executed(orderbook.retention(spark, SF, window=(1996, 1999)))
    assert "GreaterThanOrEqual(o_orderdate,1996-01-01" in plan


def test_no_products_and_no_python(spark, con):
    written = {"raw_csv_clean_read", "yearly_stamp_union", "mixed_encoding_read",
               "export_roundtrip", "export_json", *surveyed.QUERIES}
    for name, query in QUERIES.items():
        if name in written:
            continue
        plan = query(spark, SF)._jdf.queryExecution().executedPlan().toString()
        for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "InPandas"):
            assert node not in plan, (name, node)
