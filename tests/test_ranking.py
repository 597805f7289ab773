"""Places of rows in a sorted table."""

from pyspark.sql import functions as F

from cohortbench.operators.ranking import numbered, ordered_rank


def test_places_follow_the_order_over_many_partitions(spark):
    rows = spark.range(0, 5000, 1, 13).select(F.col("id"), F.pmod(F.hash("id"), F.lit(700)).alias("v"))
    got = ordered_rank(rows, [F.desc("v"), "id"]).orderBy("place").collect()
    assert [r.place for r in got] == list(range(1, 5001))
    assert [(r.v, r.id) for r in got] == sorted(((r.v, r.id) for r in got), key=lambda x: (-x[0], x[1]))


def test_a_sorted_table_is_numbered_in_its_order(spark):
    rows = spark.range(0, 999, 1, 7).select(((F.col("id") * 577) % 1009).alias("v"), F.lit(1).alias("place"))
    got = {r.v: r.place for r in numbered(rows.orderBy("v")).collect()}
    assert [got[v] for v in sorted(got)] == list(range(1, 1000))


def test_a_value_of_a_third_of_the_rows_is_dealt_to_many_tasks(spark):
    rows = spark.range(0, 30_000, 1, 8).select("id", F.when(F.col("id") % 3 > 0, F.col("id")).alias("v"))
    tied = rows.select("*", F.monotonically_increasing_id().alias("lies"))
    dealt = tied.repartitionByRange(8, F.col("v"), F.col("lies")).groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in dealt) < 6000
    got = ordered_rank(rows, [F.asc_nulls_first("v")]).agg(
        F.count_distinct("place"), F.max("place"), F.max(F.when(F.col("v").isNull(), F.col("place")))).first()
    assert tuple(got) == (30_000, 30_000, 10_000)


def test_empty_tables_nulls_and_clashing_names(spark):
    empty = spark.createDataFrame([], "at long, part long, `a.b` string")
    assert ordered_rank(empty, ["at"]).collect() == []
    odd = spark.createDataFrame([(None, 5, "x", 9), (1, None, None, 9)], "at long, part long, `a.b` string, row int")
    got = ordered_rank(odd, [F.asc_nulls_last("at")]).orderBy("place")
    assert got.columns == ["at", "part", "a.b", "row", "place"]
    assert [tuple(r) for r in got.collect()] == [(1, None, None, 9, 1), (None, 5, "x", 9, 2)]
