"""Checks run together against the same checks one by one."""

from pyspark.sql import functions as F

from cohortbench.operators import quality as q


def tables(spark):
    parent = spark.createDataFrame([(1, "a"), (1, "b"), (2, None), (None, "c")], "id long, name string")
    child = spark.createDataFrame(
        [(1, 2020, 5.0), (1, 2020, 101.0), (1, None, -1.0), (7, 2021, None), (None, 2020, 3.0), (7, 2022, float("nan"))],
        "id long, year int, rate double")
    return {"p": parent, "c": child, "lone": child.select("rate"), "none": child.limit(0)}


CHECKS = [
    q.Unique("p_unique", "p", ("id",)), q.NotNull("p_id", "p", "id"), q.NotNull("p_name", "p", "name"),
    q.Unique("c_key", "c", ("id", "year")), q.Unique("c_year", "c", ("year",)), q.NotNull("c_id", "c", "id"),
    q.InRange("c_rate", "c", "rate", 0, 100), q.InRange("c_year_range", "c", "year", 2020, 2021),
    q.Related("c_in_p", "c", "id", "p", "id"), q.InRange("lone_rate", "lone", "rate", 0, 100),
    q.Unique("none_key", "none", ("id",)), q.NotNull("none_id", "none", "id"), q.Related("none_in_p", "none", "id", "p", "id"),
]


def one_by_one(t, c):
    match c:
        case q.Unique():
            return q.unique_summary(c.name, t[c.table], list(c.keys))
        case q.NotNull():
            return q.not_null_summary(c.name, t[c.table], c.column)
        case q.InRange():
            return q.range_summary(c.name, t[c.table], c.column, c.low, c.high)
        case q.Related():
            return q.relationship_summary(c.name, t[c.table], c.key, t[c.parent], c.parent_key)


def test_same_rows_as_one_by_one(spark):
    t = tables(spark)
    together = {r.check_name: tuple(r) for r in q.run_checks(t, CHECKS).collect()}
    assert len(together) == len(CHECKS)
    for c in CHECKS:
        assert together[c.name] == tuple(one_by_one(t, c).first()), c.name


def test_each_table_is_read_once(spark, tmp_path):
    for name, df in tables(spark).items():
        df.write.parquet(str(tmp_path / name))
    t = {name: spark.read.parquet(str(tmp_path / name)) for name in tables(spark)}
    plan = q._profile(t["c"], "c", CHECKS)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parquet") == 1 and plan.count("Expand") == 1
    left = q.run_checks(t, CHECKS)._jdf.queryExecution().optimizedPlan().toString()
    assert "parquet" not in left


def test_errors_of_columns_are_early(spark):
    import pytest
    from pyspark.errors import AnalysisException

    with pytest.raises(AnalysisException):
        q.run_checks({"t": spark.range(1).select(F.col("id"))}, [q.NotNull("x", "t", "y")])
