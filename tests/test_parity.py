"""Rounding and means against DuckDB over many values, not just the known traps."""

import duckdb
import pyarrow as pa
from pyspark.sql import functions as F

from cohortbench.functions import rates
from cohortbench.functions.codes import equals_code


def both(df, names, sql):
    table = df.toArrow()
    con = duckdb.connect()
    con.register("t", table)
    want = con.sql(sql).to_arrow_table()
    return [pa.table({n: t[n] for n in names}).to_pylist() for t in (table, want)]


def test_rates_and_ratios(spark):
    ids = spark.range(120_000)
    df = ids.select(
        "id",
        (F.col("id") % 347).cast("decimal(10,0)").alias("n"),
        (F.col("id") % 991).cast("decimal(10,0)").alias("d"),
        ((F.col("id") * 7919) % 1001 / 10.0).alias("a"),
        ((F.col("id") * 104729) % 997 / 10).cast("decimal(10,2)").alias("b"),
    ).select(
        "*",
        rates.safe_pct(F.col("n"), F.col("d")).alias("pct"),
        rates.ratio(F.col("a"), F.col("b")).alias("idx"),
        rates.scaled_round(F.col("a") - F.col("b").cast("double"), 1).alias("delta"),
        rates.rate_gap(F.col("a"), F.col("b").cast("double")).cast("double").alias("gap"),
    )
    got, want = both(
        df,
        ["id", "pct", "idx", "delta", "gap"],
        """SELECT id, round(n * 100.0 / nullif(d, 0), 1) AS pct, round(a / nullif(b, 0), 2) AS idx,
           round(a - b, 1) AS delta, CAST(CAST(a - b AS DECIMAL(10,2)) AS DOUBLE) AS gap FROM t""",
    )
    assert got == want


def test_group_means(spark):
    df = spark.range(60_000).select(
        (F.col("id") % 700).alias("g"),
        ((F.col("id") * 7919) % 10007 / 100).cast("decimal(10,2)").alias("x"),
        ((F.col("id") * 31) % 5003).cast("decimal(10,0)").alias("y"),
    )
    df = df.withColumn("x", F.when(F.col("x") > 5, F.col("x")))
    means = df.groupBy("g").agg(
        rates.mean_of(F.col("x"), 2).alias("mx"),
        rates.mean_of(F.col("x"), 2, 1).alias("mx1"),
        rates.mean_of(F.col("y"), 0, 0).alias("my0"),
    )
    con = duckdb.connect()
    con.register("t", df.toArrow())
    want = con.sql(
        "SELECT g, avg(x) AS mx, round(avg(x), 1) AS mx1, round(avg(y), 0) AS my0 FROM t GROUP BY g"
    )
    got = sorted(tuple(r) for r in means.select("g", "mx", "mx1", "my0").collect())
    assert got == sorted(want.fetchall())


def test_text_codes(spark):
    df = spark.range(1_000).select(
        F.when(F.col("id") % 2 == 0, F.format_string("%.1f", F.col("id") * 1.0))
        .otherwise(F.col("id").cast("string"))
        .alias("code")
    )
    assert [r.code for r in df.where(equals_code(F.col("code"), 99)).collect()] == ["99"]
    assert [r.code for r in df.where(equals_code(F.col("code"), 98)).collect()] == ["98.0"]
