"""LPT sharding against one heap, and its promises on odd documents."""

import heapq
import random
import zlib
from collections import Counter, defaultdict

import pytest

from cohortbench.llm import sharding


def one_heap(groups, shards):
    heap, out = [(0, s) for s in range(shards)], {}
    for key, load, _ in sorted(groups, key=lambda g: (-g[1], g[2], g[0])):
        least, s = heapq.heappop(heap)
        out[key] = s
        heapq.heappush(heap, (least + load, s))
    return out


def groups_of(n, hot=0):
    return [(f"k{i}", (i * 7919) % 1000 + 1 + hot * (i == 3), i) for i in range(n)]


@pytest.mark.parametrize("seed", range(8))
def test_turns_are_those_of_a_heap(seed):
    draw = random.Random(seed)
    loads = [draw.choice([1, 2, 3, 7, 50, 50, 50, 1000, draw.randint(1, 60)]) for _ in range(draw.randint(0, 900))]
    loads += [5000] * (seed % 3)
    shards = draw.randint(1, 9)
    histogram = Counter(loads)
    want = one_heap([(f"{i:05}", load, i) for i, load in enumerate(sorted(loads, reverse=True))], shards)
    got = []
    for load, before, turns in sharding.turns_of(list(histogram.items()), shards):
        assert before == len(got)
        for j in range(histogram[load]):
            first, order = [t for t in turns if t[0] <= j][-1]
            got.append(order[(j - first) % len(order)])
        assert len(turns) <= shards
    assert got == [want[f"{i:05}"] for i in range(len(loads))]


@pytest.mark.parametrize("n, hot", [(500, 0), (60_000, 10_000_000)])
def test_any_number_of_groups_is_one_heap(spark, n, hot):
    groups = groups_of(n, hot)
    df = spark.createDataFrame(groups, "key string, load long, tie long").repartition(7)
    got = {r["key"]: r["shard"] for r in sharding.longest_first(df, 8).collect()}
    assert got == one_heap(groups, 8)


def test_a_third_of_the_groups_of_one_load(spark):
    groups = [(f"k{i}", 5 if i % 3 == 0 else i % 11 + 1, i // 2) for i in range(9000)]
    df = spark.createDataFrame(groups, "key string, load long, tie long").repartition(5)
    got = {r["key"]: r["shard"] for r in sharding.longest_first(df, 8).collect()}
    assert got == one_heap(groups, 8)


def test_odd_documents(spark, odd_docs, no_docs):
    rows = sharding.shard_documents(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    texts = defaultdict(set)
    for r in odd_docs.select("doc_id", "text").collect():
        texts[r["doc_id"]].add(r["text"] or "")
    for r in rows:
        assert any((len(t.encode()) + 1, zlib.crc32(t.encode())) == (r["size"], r["text_crc32"]) for t in texts[r["doc_id"]])
    shard_of = defaultdict(set)
    slots = defaultdict(list)
    for r in rows:
        shard_of[r["size"], r["text_crc32"]].add(r["shard"])
        slots[r["shard"]].append(r["slot"])
    assert all(len(s) == 1 for s in shard_of.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert sharding.shard_documents(no_docs).count() == 0
