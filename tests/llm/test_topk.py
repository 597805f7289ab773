"""Exact top-k search against every pair."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortbench.llm import topk
from cohortbench.llm.mtree import LONGEST, Tree


def brute(vectors, queries, k):
    """vectors: id -> whole vector (or several)."""
    out = {}
    for q, asked in queries:
        best = {}
        for i, v in vectors:
            if i != q and len(v) == len(asked):
                s = max(-LONGEST, min(LONGEST, sum(int(a) * int(b) for a, b in zip(v, asked, strict=True))))
                best[i] = max(best.get(i, s), s)
        out[q] = [(i, s) for i, s in sorted(best.items(), key=lambda x: (-x[1], x[0]))[:k]]
    return out


@pytest.mark.parametrize("kind", ["clusters", "noise", "norms", "line", "few values", "huge"])
def test_tree_finds_what_every_pair_gives(kind):
    rng = np.random.default_rng(3)
    n = 1500
    if kind == "clusters":
        x = rng.normal(size=(8, 12))[rng.integers(0, 8, n)] * 1000 + rng.normal(size=(n, 12)) * 20
    elif kind == "norms":
        x = rng.normal(size=(n, 6)) * (10.0 ** rng.uniform(0, 4, n))[:, None]
    elif kind == "line":
        x = np.stack([2.0 ** (np.arange(n) % 40), np.arange(n), np.zeros(n)], 1)
    elif kind == "few values":
        x = rng.integers(-2, 3, (n, 3))
    else:
        x = rng.normal(size=(n, 16)) * (1000 if kind == "noise" else 1e25)
    x = np.floor(np.asarray(x, float))
    ids = rng.permutation(n)
    tree = Tree(ids, x, page=16)
    for q in range(0, n, 37):
        want = brute(list(zip(ids.tolist(), x.tolist(), strict=True)), [(int(ids[q]), x[q])], 10)[int(ids[q])]
        found = [(i, s) for s, i in tree.search(x[q], 10, int(ids[q]))]
        assert found == want
        assert [(i, s) for s, i in tree.search(x[q], 10, int(ids[q]), floor=min(2.0**62, want[-1][1]))] == want
    if kind == "clusters":
        assert tree.computed < 0.1 * n * 2 * len(range(0, n, 37)) and tree.avoided > 1000


def test_pages_hold_what_their_bounds_say():
    rng = np.random.default_rng(4)
    x = np.floor(rng.normal(size=(900, 5)) * 100)
    tree = Tree(np.arange(900), x, page=20)

    def members(at):
        page = tree.pages[at]
        return page[1].tolist() if page[0] else [m for c in page[5].tolist() for m in members(c)]

    assert sorted(members(0)) == list(range(len(tree.points)))
    for page in tree.pages:
        assert len(page[1]) <= 20
        if not page[0]:
            for router, far, radius, norm, child in zip(page[1], page[2], page[3], page[4], page[5], strict=True):
                below = members(int(child))
                d = np.linalg.norm(tree.points[below] - tree.points[router], axis=1)
                assert d.max() <= radius and tree.norms[below].max() <= norm
                assert far >= 0


def rows_of(found):
    out = {}
    for r in found.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def test_many_cells_and_a_third_of_equal_vectors(spark):
    rng = np.random.default_rng(5)
    n = 1200
    x = rng.normal(size=(6, 8))[rng.integers(0, 6, n)] + rng.normal(size=(n, 8)) * 0.3
    x[: n // 3] = x[0]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>").repartition(4)
    found = rows_of(topk.top_k(df, df.where("vec_id % 20 = 0"), cell_rows=100, sample_rows=64))
    whole = [(i, np.floor(v * 1024).tolist()) for i, v in enumerate(x)]
    assert found == brute(whole, whole[::20], 10)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 2.0], 0), (1, [1.0, 2.0], 0), (1, [0.5, -9.0], 0), (2, [0.0, 0.0], 0), (3, None, 0), (4, [], 0),
        (5, [1.0, None], 0), (6, [nan, 1.0], 0), (7, [inf, 1.0], 0), (None, [1.0, 1.0], 0), (8, [1e200, -1e200], 0),
        (9, [3.0, 4.0], 0), (10, [3.0, 4.0], 1), (11, [1.0, 2.0, 3.0], 0), (12, [-0.0001, 0.0001], 0),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score int").withColumn("cell", F.lit(1))
    found = rows_of(topk.top_k(df, df))
    big = 2**200
    whole = [(1, [1024, 2048]), (1, [512, -9216]), (2, [0, 0]), (8, [big, -big]), (9, [3072, 4096]), (10, [3072, 4096]), (12, [-1, 0])]
    asks = [(1, [512, -9216]), *whole[2:]]
    assert found == brute(whole, asks, 10)
    assert topk.top_k(df.limit(0), df).collect() == []
    assert topk.top_k(df, df.limit(0)).collect() == []
