"""Bucket bounds against trying all of them; batches and cuts against their promises."""

import itertools
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from cohortbench.llm import packing
from cohortbench.llm.common import placed_rank, with_place


def padding(histogram, bounds):
    return sum(n * (min(b for b in bounds if b >= x) - x) for x, n in histogram.items())


@pytest.mark.parametrize("seed", range(12))
def test_bounds_are_optimal(seed):
    rng = random.Random(seed)
    histogram = {rng.randint(1, 40): rng.randint(1, 9) for _ in range(rng.randint(1, 9))}
    for buckets in (1, 2, 3, 4):
        bounds = packing.optimal_bounds(histogram, buckets)
        assert bounds == sorted(set(bounds)) and len(bounds) <= buckets and bounds[-1] == max(histogram)
        others = [x for x in histogram if x != max(histogram)]
        best = min(padding(histogram, [*c, max(histogram)])
                   for k in range(min(buckets, len(histogram))) for c in itertools.combinations(others, k))
        assert padding(histogram, bounds) == best
    assert packing.optimal_bounds({}, 3) == []


def test_cuts_are_the_whole_text(spark, odd_docs):
    rows = packing.sequences(odd_docs, 50, with_text=True).collect()
    by = defaultdict(list)
    for r in rows:
        assert 1 <= r["length"] <= 50
        by[r["doc_id"]].append(r)
    long_text = odd_docs.where("doc_id = 4").first()["text"]
    parts = sorted(by[4], key=lambda r: r["chunk"])
    assert "".join(r["text"] for r in parts) == long_text
    assert sum(r["length"] - 1 for r in parts) == len(long_text.split()) and len(parts) == -(-12001 // 49)
    assert [r["length"] for r in by[2]] == [1] and [r["length"] for r in by[3]] == [1]
    plain = packing.sequences(odd_docs, 50).collect()
    assert sorted((str(r["doc_id"]), r["chunk"], r["length"]) for r in rows) == sorted(
        (str(r["doc_id"]), r["chunk"], r["length"]) for r in plain)


def test_batches(spark, odd_docs, no_docs):
    rows = packing.pack(odd_docs, max_length=50, buckets=3, budget=200).collect()
    assert len(rows) == packing.sequences(odd_docs, 50).count()
    batches = defaultdict(list)
    for r in rows:
        assert r["padding"] == r["bound"] - r["length"] >= 0
        batches[r["bucket"], r["bound"], r["batch"]].append(r["slot"])
    last = defaultdict(int)
    for bucket, _, batch in batches:
        last[bucket] = max(last[bucket], batch)
    for (bucket, bound, batch), slots in batches.items():
        assert sorted(slots) == list(range(len(slots))) and len(slots) <= 200 // bound
        assert batch == last[bucket] or len(slots) == 200 // bound
    assert packing.pack(no_docs).count() == 0
    assert packing.pack(no_docs, with_text=True).count() == 0
    with pytest.raises(ValueError):
        packing.pack(odd_docs, max_length=50, budget=40)


def test_batches_in_the_order_of_the_rows(spark, tmp_path):
    rows = [(i * 37 % 500, "w " * (1 + i % 7), None) for i in range(3000)]
    spark.createDataFrame(rows, "doc_id long, text string, x string").repartition(13).write.parquet(f"{tmp_path}/d")
    docs = spark.read.parquet(f"{tmp_path}/d")
    lain = [r for f in sorted(docs.inputFiles()) for r in spark.read.parquet(f).collect()]
    for table in (docs, spark.createDataFrame(lain, docs.schema)):
        got = packing.pack(with_place(table), max_length=50, buckets=3, budget=200, placed=("__part", "__row_place"))
        bound = {r["length"]: r["bound"] for r in got.collect()}
        for b in set(bound.values()):
            mine = got.where(F.col("bound") == b).orderBy("batch", "slot").collect()
            assert [r["doc_id"] for r in mine] == [r["doc_id"] for r in lain if bound[len(r["text"].split()) + 1] == b]
            assert [r["batch"] * (200 // b) + r["slot"] for r in mine] == list(range(len(mine)))
    ranked = placed_rank(with_place(docs), ["x"], "__part", "__row_place", ["doc_id"], "rank", per_task=7)
    assert [r["doc_id"] for r in ranked.orderBy("rank").collect()] == [r["doc_id"] for r in lain]
