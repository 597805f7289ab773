"""Pfair schedules: windows, deviation, and every row at its place."""

import random
import time
from collections import Counter, defaultdict

import pytest

from cohortbench.llm import mixing


@pytest.mark.parametrize("seed", range(6))
def test_schedule_keeps_within_one_block(seed):
    rng = random.Random(seed)
    weights = {f"s{i}": rng.random() ** 3 + 1e-4 for i in range(rng.randint(1, 30))}
    slots = mixing.period_slots(weights, 200)
    period = sum(slots.values())
    assert period == max(200, 10 * len(weights)) and min(slots.values()) >= 1
    table = mixing.schedule(slots)
    assert [t for *_, t in table] == list(range(period))
    had = Counter()
    for s, k, release, deadline, t in table:
        assert k == had[s] and release <= t < deadline
        had[s] += 1
        assert all(abs(had[x] - slots[x] * (t + 1) / period) < 1 for x in slots)


def test_slots_of_many_small_sources():
    """Against the plain rule: the source most above its share gives a slot back."""
    weights = {"big": 5000.0, "mid": 300.0, **{f"s{i}": 0.001 for i in range(120)}}
    got = mixing.period_slots(weights, 1300)
    period, total = 1300, sum(weights.values())
    exact = {s: period * w / total for s, w in weights.items()}
    slots = {s: max(1, int(x)) for s, x in exact.items()}
    while sum(slots.values()) > period:
        slots[max((s for s in slots if slots[s] > 1), key=lambda s: (slots[s] - exact[s], s))] -= 1
    assert got == slots and sum(got.values()) == period
    start = time.time()
    mixing.period_slots({"big": 1e9, **{f"s{i}": 1.0 for i in range(50_000)}})
    assert time.time() - start < 10


def test_mix(spark):
    rows = [(i, f"t{i}", "hot" if i % 3 else f"s{i % 7}") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(docs, block_rows=4, period=50).collect()
    seen = Counter(r["__row"]["doc_id"] for r in got)
    assert set(seen) == set(range(3000))
    positions = [r["position"] for r in got]
    assert len(set(positions)) == len(positions)
    blocks = defaultdict(set)
    for r in got:
        assert r["release"] <= r["slot"] < r["deadline"] and r["position"] // 4 == r["slot"]
        blocks[r["slot"]].add((r["source"], r["block"]))
    assert all(len(b) == 1 for b in blocks.values()) and sorted(blocks) == list(range(len(blocks)))
    # Each epoch of a source gives every row once before the next one starts.
    for r in got:
        assert r["epoch"] < seen[r["__row"]["doc_id"]]
    assert min(seen[i] for i, _, s in rows if s == "hot") == 1


def test_given_weights_and_odd_rows(spark, odd_docs, no_docs):
    got = mixing.mix(odd_docs, {"a": 1.0, "b": 3.0, "none": 2.0, "": 0.0}, block_rows=2, period=8).collect()
    assert {r["source"] for r in got} == {"a", "b"}
    every = mixing.mixed_documents(odd_docs)
    assert every.columns == odd_docs.columns
    key = lambda r: str(tuple(r))
    assert {key(r) for r in every.collect()} == {key(r) for r in odd_docs.collect()}
    assert mixing.mix(no_docs).count() == 0 and mixing.mixed_documents(no_docs).count() == 0


@pytest.mark.parametrize("counts", [
    {"big": 20_000_000, "one": 1}, {"big": 40_000, "one": 1}, {"big": 10**6, **{f"s{i}": 1 + i % 3 for i in range(300)}},
    {f"s{i}": 1000 + i for i in range(20)}])
def test_fair_period_raises_no_source(counts):
    weights = mixing.tempered(counts)
    slots = mixing.period_slots(weights, mixing.fair_period(weights))
    period, total = sum(slots.values()), sum(weights.values())
    for s, n in slots.items():
        assert abs(n - period * weights[s] / total) < 1
        assert n <= 1.1 * period * weights[s] / total


def test_small_source_keeps_its_weight_in_the_mixed_documents(spark):
    docs = spark.range(40_000).selectExpr("id AS doc_id", "'t' AS text", "if(id = 0, 'one', 'big') AS source")
    every = mixing.mixed_documents(docs)
    share = 1 / (39_999**mixing.TEMPER + 1)
    n, one = every.count(), every.where("source = 'one'").count()
    assert every.where("source = 'big'").distinct().count() == 39_999
    assert 0 < one < share * n + mixing.BLOCK_ROWS  # less than one block over the target
