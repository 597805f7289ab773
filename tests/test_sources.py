"""Files in, typed relations out."""

from decimal import Decimal as D

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from cohortbench.sources import delimited, headers, precedence, warehouse


def write(path, text, encoding="utf-8"):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode(encoding))
    return str(path)


def test_clean_name_drops_blanks_and_marks():
    assert headers.clean_name("\ufeffunitid") == "UNITID"
    assert headers.clean_name("ï»¿ Unitid ") == "UNITID"
    assert headers.clean_name("STUFACR ") == "STUFACR"


def test_required_columns_are_named_when_missing(spark):
    df = spark.createDataFrame([(1, "TX")], "`unitid ` int, STABBR string")
    assert headers.require_columns(df, ["UNITID", "STABBR"]) is df
    with pytest.raises(headers.MissingColumns, match="SECTOR"):
        headers.require_columns(df, ["UNITID", "SECTOR"])


def test_names_equal_after_cleaning_are_an_error(spark):
    df = spark.createDataFrame([(1, 2)], "`a` int, `a ` int")
    with pytest.raises(ValueError, match="equal after cleaning"):
        headers.clean_columns(df)


def test_null_markers_headers_and_numbers(spark, tmp_path):
    path = write(
        tmp_path / "f.csv",
        '\ufeffunitid,Ratio ,NOTE,N\n1,327.0,"a ""b"", c",.\n2,.,NULL,5\n3,,x,NULL\n4,2.5,.,""\n',
    )
    raw = delimited.read_text_columns(spark, path)
    assert raw.columns == ["UNITID", "RATIO", "NOTE", "N"]
    schema = {
        "UNITID": "bigint",
        "RATIO": "double",
        "NOTE": "string",
        "N": "decimal(10,0)",
        "GONE": "int",
    }
    rows = delimited.typed_columns(raw, schema).orderBy("UNITID").collect()
    assert [tuple(r) for r in rows] == [
        (1, 327.0, 'a "b", c', None, None),
        (2, None, None, D(5), None),
        (3, None, "x", None, None),
        (4, 2.5, None, None, None),
    ]


def test_integers_written_as_floats_and_bad_text(spark):
    df = spark.createDataFrame([("327.0",), ("12",), (None,)], "A string")
    assert [r.A for r in delimited.typed_columns(df, {"A": "int"}).collect()] == [327, 12, None]
    bad = spark.createDataFrame([("n/a",)], "A string")
    with pytest.raises(PySparkException):
        delimited.typed_columns(bad, {"A": "int"}).collect()
    assert delimited.typed_columns(bad, {"A": "int"}, strict=False).first().A is None


def test_a_fraction_is_no_integer(spark):
    df = spark.createDataFrame([("327.5",)], "A string")
    with pytest.raises(PySparkException, match="not a whole number"):
        delimited.typed_columns(df, {"A": "bigint"}).collect()
    assert delimited.typed_columns(df, {"A": "bigint"}, strict=False).first().A is None


def test_years_unite_by_name_after_typing(spark, tmp_path):
    write(tmp_path / "fam_2020.csv", "UNITID,STUFACR \n1,12.0\n")
    write(tmp_path / "fam_2021.csv", "EXTRA,STUFACR,UNITID,CODE\nq,x13,2,7\n")
    catalogue = delimited.Catalogue(str(tmp_path), {"fam": range(2020, 2022)})
    schema = {"UNITID": "bigint", "STUFACR": "string", "CODE": "int"}
    df = delimited.read_family(spark, catalogue, "fam", schema)
    assert df.columns == ["UNITID", "STUFACR", "CODE", "YEAR"]
    assert sorted(tuple(r) for r in df.collect()) == [
        (1, "12.0", None, 2020),
        (2, "x13", 7, 2021),
    ]


def test_a_missing_year_is_an_error(spark, tmp_path):
    write(tmp_path / "fam_2020.csv", "UNITID\n1\n")
    catalogue = delimited.Catalogue(str(tmp_path), {"fam": range(2020, 2022)})
    with pytest.raises(PySparkException):
        delimited.read_family(spark, catalogue, "fam", {"UNITID": "int"})


def test_union_keeps_duplicates_and_fills_gaps(spark):
    a = spark.createDataFrame([(1,), (1,)], "k int")
    b = spark.createDataFrame([("x", 1)], "v string, k int")
    got = delimited.unite([a, b]).collect()
    assert sorted((r.k, r.v or "") for r in got) == [(1, ""), (1, ""), (1, "x")]


def test_encodings_are_decided_per_file(spark, tmp_path):
    old = write(tmp_path / "old.csv", "ID,NAME\n1,Peña\n2,Ascii\n", "latin-1")
    new = write(tmp_path / "new.csv", "ID,NAME\n3,Peña\n4,漢字\n", "utf-8-sig")
    assert delimited.encodings(spark, [old, new]) == {old: delimited.LATIN1, new: delimited.UTF8}
    rows = delimited.read_mixed_encodings(spark, [old, new]).collect()
    assert {r.ID: r.NAME for r in rows} == {"1": "Peña", "2": "Ascii", "3": "Peña", "4": "漢字"}


def test_line_breaks_inside_values(spark, tmp_path):
    path = write(tmp_path / "m.csv", 'ID,NAME\n1,"two\nlines"\n2,x\n')
    rows = delimited.read_mixed_encodings(spark, [path], multiline=True).collect()
    assert sorted((r.ID, r.NAME) for r in rows) == [("1", "two\nlines"), ("2", "x")]


def test_files_read_together_must_share_a_header(spark, tmp_path):
    paths = [
        write(tmp_path / "a.csv", "\ufeffID ,NAME\n1,x\n"),
        write(tmp_path / "b.csv", "NAME,ID\ny,2\n"),
    ]
    with pytest.raises(Exception, match="CSV header does not conform"):
        delimited.read_text_columns(spark, paths).collect()
    assert delimited.read_text_columns(spark, paths[0]).select("ID").first().ID == "1"


def test_base_file_wins_over_revised():
    assert precedence.preferred_file(["ef2020d_rv.csv", "ef2020d.csv"]) == "ef2020d.csv"
    assert precedence.preferred_file(["B.csv", "a.csv"]) == "a.csv"
    assert precedence.preferred_file(["b_RV.csv", "a_rv.csv"]) == "a_rv.csv"


def test_base_rows_win_over_revised(spark):
    rows = [
        (1, "new", "x_rv.csv"),
        (1, "old", "x.csv"),
        (2, "only", "X_RV.csv"),
        (3, None, "x.csv"),
        (3, "late", "y.csv"),
    ]
    df = spark.createDataFrame(rows, "k int, v string, source string")
    got = precedence.preferred_rows(df, ["k"], "source").collect()
    assert sorted((r.k, r.v, r.source) for r in got if r.v) == [
        (1, "old", "x.csv"),
        (2, "only", "X_RV.csv"),
    ]
    assert [(r.v, r.source) for r in got if r.k == 3] == [(None, "x.csv")]


def test_releases_in_layers(spark):
    base = spark.createDataFrame([(1, "old"), (3, None), (None, "n")], "k int, v string")
    first = spark.createDataFrame([(1, "new"), (2, "only")], "k int, v string")
    second = spark.createDataFrame([(2, "late"), (4, "last"), (3, "late")], "k int, v string")
    got = precedence.layered([base, first, second], ["k"])
    assert sorted(map(tuple, got.collect()), key=str) == [(1, "old"), (2, "only"), (3, None), (4, "last"), (None, "n")]
    assert precedence.layered([base], ["k"]).count() == 3
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "LeftAnti" in plan


def test_latest_year_is_that_of_the_whole_relation(spark):
    df = spark.createDataFrame([(1, 2020, 1), (1, 2021, 0), (2, 2020, 1)], "k int, year int, ok int")
    latest = warehouse.latest_year_rows(df)
    assert [(r.k, r.year) for r in latest.collect()] == [(1, 2021)]
    assert latest.where("ok = 1").count() == 0


def test_window_reads(spark):
    rows = [(2020, "b", 1), (2019, "a", 2), (2021, "a", 3), (2020, "a", 4)]
    df = spark.createDataFrame(rows, "year int, institution_name string, m int")
    got = warehouse.mart_window(df, ["institution_name", "year"], 2020, 2021)
    assert [tuple(r) for r in got.collect()] == [("a", 2020), ("b", 2020), ("a", 2021)]
    everything = warehouse.mart_rows(df)
    assert [r.m for r in everything.collect()] == [2, 4, 1, 3]
    assert everything.columns == df.columns


def test_date_windows_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    dates = ["1999-12-31 23:59:59", "2000-01-01 00:00:00", "2001-12-31 23:59:59", "2002-01-01 00:00:00"]
    spark.createDataFrame([(d,) for d in dates], "d string").select(
        F.col("d").cast("timestamp_ntz").alias("ts")
    ).write.parquet(path)
    df = spark.read.parquet(path)
    kept = df.where(warehouse.in_years(F.col("ts"), 2000, 2001, "timestamp_ntz"))
    assert kept.count() == 2
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts," in plan and "LessThan(ts," in plan
    newest = df.where(warehouse.in_latest_year(df, "ts"))
    assert newest.count() == 1
    assert "GreaterThanOrEqual(ts,ScalarSubquery" in (
        newest._jdf.queryExecution().executedPlan().toString()
    )


def test_plain_numbers_skip_the_decimal_reading(spark):
    """Cells that print as whole numbers never take the way through decimals; all others still do."""
    from pyspark.sql import functions as F

    rows = spark.createDataFrame([(v,) for v in ("7", " -12 ", "2147483647", "0")], "A string")
    for type_name in ("int", "bigint", "decimal(10,0)"):
        value = delimited.typed_value(F.col("A"), type_name)
        assert "WHEN" in str(value).upper()
        assert [int(r[0]) for r in rows.select(value).collect()] == [7, -12, 2147483647, 0]
    odd = spark.createDataFrame([(v,) for v in ("327.0", "+5", "007", "1e3", "2147483648", "327.5", "x")], "A string")
    cells = delimited.typed_cells({"A": "int"}, strict=False)
    got = delimited.typed_columns(odd, {"A": "int", "B": "int"}, strict=False, cells=cells).collect()
    assert [(r.A, r.B) for r in got] == [(327, None), (5, None), (7, None), (1000, None), (None, None), (None, None), (None, None)]
    kept = odd.select(delimited.typed_value(F.col("A"), "decimal(10,0)", False).alias("A")).collect()
    assert [None if r.A is None else int(r.A) for r in kept] == [327, 5, 7, 1000, 2147483648, 328, None]
