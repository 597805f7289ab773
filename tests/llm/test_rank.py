"""Ranks in hashed order, with one id in a third of the rows."""

import hashlib

import pytest
from pyspark.sql import functions as F

from cohortbench.llm import ann, chat, common, mixing, packing, sharding, topk  # noqa: F401


def places(ids, per_task):
    buckets = max(1, -(-len(ids) // per_task))

    def key(i):
        digest = hashlib.md5(("" if i is None else str(i)).encode()).hexdigest()
        return int(digest[:8], 16) % buckets, digest

    return sorted(ids, key=key)


@pytest.mark.parametrize("hot", [None, 17])
def test_a_heavy_id_is_split_and_keeps_the_order(spark, hot):
    ids = [hot if i % 3 == 0 else 10_000 + i // 2 for i in range(6000)]
    df = spark.createDataFrame([(i, "g") for i in ids], "id long, g string").repartition(6)
    got = common.global_rank(df, ["g"], ["id"], "rank", per_task=200).orderBy("rank").collect()
    assert [r["rank"] for r in got] == list(range(6000))
    assert [r["id"] for r in got] == places(ids, 200)


def test_pieces_of_a_heavy_bucket_are_small(spark):
    df = spark.range(0, 6000, 1, 6).select(F.when(F.col("id") % 3 > 0, F.col("id")).alias("id"))
    keyed = df.withColumn("__hash", F.md5(F.concat_ws("|", F.col("id").cast("string")).cast("binary"))).withColumn("__bucket", F.lit(0))
    heavy = keyed.groupBy("__bucket", "__hash").agg(F.count("*").alias("__n")).where("__n > 200")
    sizes = common._split(keyed, heavy, 200).groupBy("__bucket", "__piece", "__sub").count().collect()
    subs = [r["count"] for r in sizes if r["__piece"] == 1]
    assert len(subs) == 10 and sum(subs) == 2000 and max(subs) < 300
    assert {r["__piece"] for r in sizes} <= {0, 1, 2} and sum(r["count"] for r in sizes) == 6000


@pytest.fixture
def one_id(spark):
    """9,000 rows, a third of them under no id."""
    return spark.range(0, 9000, 1, 6).select(
        F.when(F.col("id") % 3 > 0, F.col("id")).alias("doc_id"), F.concat(F.lit("t "), F.col("id").cast("string")).alias("text"),
        F.lit("s").alias("source"))


def test_operators_with_a_third_of_the_rows_under_no_id(spark, one_id, monkeypatch):
    for module in (mixing, packing, sharding):
        monkeypatch.setattr(module, "global_rank", lambda *a, **k: common.global_rank(*a, **(k | {"per_task": 500})))
    mixed = mixing.mix(one_id)
    assert mixed.select("__row").distinct().count() == 9000 and mixed.select("position").distinct().count() == mixed.count()
    packed = packing.pack(one_id)
    assert packed.count() == 9000 == packed.select("bucket", "batch", "slot").distinct().count()
    sharded = sharding.shard_documents(one_id).groupBy("shard").agg(F.count("*").alias("n"), F.count_distinct("slot").alias("d"), F.max("slot").alias("m"))
    assert all(r.n == r.d == r.m + 1 for r in sharded.collect())


def test_searches_with_a_third_of_the_rows_repeated(spark):
    df = spark.range(0, 900, 1, 6).select(
        F.when(F.col("id") % 3 > 0, F.col("id")).otherwise(5).alias("vec_id"),
        F.when(F.col("id") % 3 > 0, F.array(F.col("id") / 900, F.lit(1.0))).otherwise(F.array(F.lit(2.0), F.lit(2.0))).alias("embedding"))
    for found in (ann.nearest(df, df.where("vec_id = 7")), topk.top_k(df, df.where("vec_id = 7"))):
        best = found.orderBy("rank").collect()
        assert best[0]["vec_id"] == 5 and len({r["vec_id"] for r in best}) == len(best)
