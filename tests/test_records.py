"""Delimited files with line breaks in values, against the reading of a file by one task."""

import csv
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from cohortbench.sources.delimited import read_text_columns
from cohortbench.sources.records import UnbalancedQuotes, raw_records, read_records

TEXTS = ["plain", "", 'say "hi"', "two\nlines", "a,b", '"', '""\n""', "x" * 300, "\n\n", "tail\n", ' spaced ', "über\nähm", "r\rn", "c\r\nd"]


def put(path, rows, ending="\n", encoding="utf-8", header=("Id", " text ", "Third")):
    with open(path, "w", newline="", encoding=encoding) as f:
        writer = csv.writer(f, lineterminator=ending)
        writer.writerow(header)
        writer.writerows(rows)
    return str(path)


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700b")
    spark.conf.set("spark.sql.files.openCostInBytes", "1b")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def cells(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def made(n, seed=0):
    draw = random.Random(seed)
    return [[str(i), draw.choice(TEXTS), draw.choice(TEXTS)] for i in range(n)]


@pytest.mark.parametrize("ending, encoding", [("\n", "utf-8"), ("\r\n", "utf-8"), ("\n", "latin-1")])
def test_equal_to_the_whole_file_read(spark, small_splits, tmp_path, ending, encoding):
    path = put(tmp_path / "a.csv", made(400), ending, encoding)
    spark_name = "UTF-8" if encoding == "utf-8" else "ISO-8859-1"
    want = read_text_columns(spark, path, spark_name, multiline=True)
    got = read_records(spark, path)
    assert got.columns == want.columns == ["ID", "TEXT", "THIRD"]
    assert cells(got) == cells(want)
    records = raw_records(spark, path)[0]
    tasks = records.groupBy(F.spark_partition_id()).count().count()
    assert tasks > 10


def test_values_longer_than_splits(spark, small_splits, tmp_path):
    rows = [["1", "\n".join(["line"] * 2000), "x"], ["2", "short", "\n" * 5000], ["3", "y\n" * 400 + '"', ""], ["4", "", "z"]]
    path = put(tmp_path / "a.csv", rows)
    assert cells(read_records(spark, path)) == cells(read_text_columns(spark, path, multiline=True))
    long_header = put(tmp_path / "b.csv", rows, header=("id", "n\n" * 900, "c"))
    assert cells(read_records(spark, long_header)) == cells(read_records(spark, path))


def test_many_files_of_both_encodings(spark, small_splits, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    want = []
    for i, encoding in enumerate(["utf-8", "latin-1", "utf-8-sig"]):
        rows = [[f"{i}-{a}", b, c] for a, b, c in made(50, i)]
        path = put(folder / f"{i}.csv", rows, encoding=encoding)
        want += cells(read_text_columns(spark, path, "ISO-8859-1" if i == 1 else "UTF-8", multiline=True))
    assert cells(read_records(spark, str(folder))) == sorted(want, key=str)


def test_odd_files(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text('\n\na,b\n\n1,"x\n\ny"\n\n\n2,z\n3\n4,5,6\n')
    assert cells(read_records(spark, str(path))) == cells(read_text_columns(spark, str(path), multiline=True))
    path.write_text('a,b\n')
    assert read_records(spark, str(path)).collect() == []
    path.write_text('a,b\n1,"x\n2,y\n')
    with pytest.raises(UnbalancedQuotes, match="a.csv"):
        read_records(spark, str(path))
    folder = tmp_path / "two"
    folder.mkdir()
    put(folder / "1.csv", made(3))
    for header in (("Id", "other", "Third"), ("Id", "text", "Third", "Fourth"), ("Id", "text")):
        put(folder / "2.csv", made(3), header=header)
        with pytest.raises(PySparkException, match="different headers"):
            read_records(spark, str(folder)).collect()


def test_only_pieces_at_the_ends_of_splits_are_shuffled(spark, tmp_path):
    path = put(tmp_path / "a.csv", made(50))
    plan = read_records(spark, path)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Union") == 1 and plan.count("Aggregate [file") == 1
