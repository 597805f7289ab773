"""Checks as DataFrames, load audit, exports."""

import json
from decimal import Decimal as D
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from cohortbench.operators import quality
from cohortbench.session import scratch_path
from cohortbench.sinks import exports
from cohortbench.sources import delimited


def summary(df):
    return [tuple(r) for r in df.collect()]


def test_unique(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (None, 3)], "k int, y int")
    assert summary(quality.unique_summary("u", df, ["k"])) == [("u", 1, 1)]
    assert summary(quality.unique_summary("u", df, ["k", "y"])) == [("u", 2, 1)]
    assert summary(quality.duplicates(df, ["k", "y"])) == [(1, 1, 2)]


def test_not_null(spark):
    df = spark.createDataFrame([(1,), (None,)], "k int")
    assert summary(quality.not_null_summary("n", df, "k")) == [("n", 2, 1)]
    assert quality.nulls(df, "k").count() == 1


def test_relationships_ignore_null_children(spark):
    child = spark.createDataFrame([(1,), (2,), (2,), (None,)], "c int")
    parent = spark.createDataFrame([(1,), (1,), (None,)], "p int")
    assert summary(quality.relationship_summary("r", child, "c", parent, "p")) == [("r", 3, 2)]
    assert summary(quality.orphans(child, "c", parent, "p")) == [(2, 2)]


def test_range_is_closed_and_nulls_pass(spark):
    df = spark.createDataFrame([(0.0,), (100.0,), (100.1,), (-1.0,), (None,)], "v double")
    assert summary(quality.range_summary("g", df, "v", 0, 100)) == [("g", 4, 2)]
    assert quality.out_of_range(df, "v", 0, 100).count() == 2


def test_clean_and_empty_tables_still_report(spark):
    empty = spark.createDataFrame([], "k int")
    checks = quality.all_checks(
        [
            quality.unique_summary("u", empty, ["k"]),
            quality.not_null_summary("n", empty, "k"),
            quality.relationship_summary("r", empty, "k", empty, "k"),
        ]
    )
    assert sorted(summary(checks)) == [("n", 0, 0), ("r", 0, 0), ("u", 0, 0)]


def audit(spark, rows):
    return spark.createDataFrame(rows, "family string, year int, row_count bigint, status string")


def test_thin_years(spark):
    loads = [("gr", 2020 + i, n, "ok") for i, n in enumerate([100, 100, 100, 40])]
    loads += [("hd", 2020, 100, "ok"), ("hd", 2021, 10, "ok")]  # too few years to judge
    loads += [("c_a", 2020 + i, 0, "ok") for i in range(3)]  # median of zero
    loads += [("sfa", 2020 + i, 50, "ok") for i in range(3)] + [("sfa", 2023, 1, "error")]
    got = quality.thin_years(audit(spark, loads))
    assert summary(got) == [("gr", 2023, 40, 100.0)]
    at_half = audit(spark, [("x", 2020, 100, "ok"), ("x", 2021, 100, "ok"), ("x", 2022, 50, "ok")])
    assert quality.thin_years(at_half).count() == 0
    loads.append(("gr", 2024, 0, "empty"))
    loads.append(("gr", 2025, None, "not_published"))
    assert summary(quality.load_totals(audit(spark, loads))) == [(12, 1, 2, 1)]


def test_load_states_and_summary(spark):
    df = spark.createDataFrame(
        [(None, None, None), (5, 0, None), (5, 5, None), (None, None, "broken")],
        "raw int, kept int, error string",
    )
    states = df.select(quality.load_status(F.col("raw"), F.col("kept"), F.col("error")))
    assert [r[0] for r in states.collect()] == ["not_published", "empty", "ok", "error"]
    loads = [("b", 2021, 1, "ok"), ("a", 2021, 1, "ok"), ("a", 2020, 0, "empty"), ("a", 2019, 1, "ok")]
    assert summary(quality.load_summary(audit(spark, loads))) == [
        ("empty", 1, "a 2020"),
        ("ok", 3, "a 2019, a 2021, b 2021"),
    ]
    report = quality.load_report(audit(spark, loads)).collect()
    assert [(r.family, r.year) for r in report] == [
        ("a", 2019), ("a", 2020), ("a", 2021), ("b", 2021),
    ]


# --- exports -----------------------------------------------------------------


def mart(spark):
    return spark.createDataFrame(
        [(1, "Peña, A", 2020, D("12.50"), None), (2, 'B "q"', 2021, None, 3)],
        "unitid bigint, institution_name string, year int, rate decimal(10,2), n int",
    )


def test_csv_starts_with_a_mark_and_reads_back_clean(spark, tmp_path):
    path = str(tmp_path / "m.csv")
    assert exports.write_csv(mart(spark), path) == 2
    parts = [p for p in Path(path).glob("part-*") if p.stat().st_size]
    assert parts and all(p.read_bytes().startswith(b"\xef\xbb\xbfunitid,") for p in parts)
    back = delimited.typed_columns(
        delimited.read_text_columns(spark, path),
        {"UNITID": "bigint", "INSTITUTION_NAME": "string", "RATE": "decimal(10,2)"},
    )
    assert sorted(tuple(r) for r in back.collect()) == [
        (1, "Peña, A", D("12.50")),
        (2, 'B "q"', None),
    ]


def test_formats_subsets_and_row_report(spark, tmp_path):
    tables = {"a": mart(spark), "b": mart(spark).limit(1)}
    report = exports.export_tables(spark, tables, str(tmp_path), "both")
    assert sorted(summary(report)) == [
        ("a", "csv", 2), ("a", "parquet", 2), ("b", "csv", 1), ("b", "parquet", 1),
    ]
    back = spark.read.parquet(str(tmp_path / "a.parquet"))
    assert back.schema == mart(spark).schema
    only = exports.export_tables(spark, tables, str(tmp_path / "x"), "csv", only=["b"])
    assert summary(only) == [("b", "csv", 1)]
    with pytest.raises(KeyError, match="zz"):
        exports.export_tables(spark, tables, str(tmp_path), "csv", only=["zz"])
    with pytest.raises(ValueError, match="xls"):
        exports.export_tables(spark, tables, str(tmp_path), "xls")


def test_yearly_folders_prune(spark, tmp_path):
    path = str(tmp_path / "landed")
    assert exports.write_yearly(mart(spark), path) == 2
    assert exports.write_yearly(mart(spark), path, rebalance=True) == 2
    assert sorted(p.name for p in Path(path).glob("year=*")) == ["year=2020", "year=2021"]
    plan = spark.read.parquet(path).where("year = 2021")._jdf.queryExecution().executedPlan()
    assert "PartitionFilters: [isnotnull(year" in plan.toString()


def test_json_records_keep_nulls_and_refuse_nothing(spark, tmp_path):
    columns = {"institution_name": "college", "year": "year", "rate": "grad", "n": "n"}
    records = exports.chart_records(mart(spark), 2020, 2020, columns)
    path = str(tmp_path / "j")
    assert exports.write_json(records, path) == 1
    text = "".join(p.read_text() for p in Path(path).glob("part-*"))
    assert json.loads(text) == {"college": "Peña, A", "year": 2020, "grad": 12.5, "n": None}
    with pytest.raises(exports.EmptyExport):
        exports.write_json(exports.chart_records(mart(spark), 1990, 1991, columns), path)
    assert json.loads("".join(p.read_text() for p in Path(path).glob("part-*")))["n"] is None


def test_json_has_no_text_for_numbers(spark):
    df = spark.createDataFrame([(float("nan"), 1), (float("inf"), 2), (1.5, 3)], "m double, year int")
    got = [json.loads(r.record) for r in exports.json_records(df).collect()]
    assert got == [{"m": None, "year": 1}, {"m": None, "year": 2}, {"m": 1.5, "year": 3}]
    assert exports.published_years(df.unionByName(df)) == [1, 2, 3]


class FakeSession:
    """Only the settings scratch_path reads."""

    def __init__(self, **settings):
        self.conf = {k.replace("_", "."): v for k, v in settings.items()}


def test_scratch_follows_the_session_setting():
    shared = FakeSession(spark_checkpoint_dir="hdfs:/x/", spark_master="yarn")
    first, second = scratch_path(shared, "l"), scratch_path(shared, "l")
    assert first.startswith("hdfs:/x/cohortbench/l-") and first != second
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_path(FakeSession(spark_master="yarn"), "l")
    assert "cohortbench" in scratch_path(FakeSession(spark_master="local[2]"), "l")
