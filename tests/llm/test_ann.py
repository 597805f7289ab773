"""Graph search against all inner products."""

from collections import defaultdict

import numpy as np
import pytest

from cohortbench.llm import ann
from cohortbench.llm.graph import Graph

SHAPE = "vec_id long, embedding array<double>, rank string, score string"


def frame(spark, ids, vectors):
    rows = [(i, None if v is None else [None if x is None else float(x) for x in v], "r", "s")
            for i, v in zip(ids, vectors, strict=True)]
    return spark.createDataFrame(rows, SHAPE)


def exact(ids, vectors, queries, k):
    out = {}
    for i, v in zip(ids, vectors, strict=True):
        if i in queries:
            every = sorted((-float(np.dot(v, w)), j) for j, w in zip(ids, vectors, strict=True) if j != i)
            out[i] = every[:k]
    return out


def test_recall_over_shards(spark):
    rng = np.random.default_rng(0)
    vectors = rng.standard_normal((3000, 24)) * rng.uniform(0.5, 2, (3000, 1))
    ids = list(range(3000))
    df = frame(spark, ids, vectors)
    got = ann.nearest(df, df.where("vec_id % 100 = 0"), shard_rows=1000).collect()
    want = exact(ids, vectors, set(range(0, 3000, 100)), 20)
    hits = sum((r["vec_id"] in {j for _, j in want[r["query_id"]]}) for r in got)
    assert len(got) == 600 and hits >= 0.95 * 600
    for r in got:
        assert abs(r["score"] - float(np.dot(vectors[r["query_id"]], vectors[r["vec_id"]]))) < 1e-12
    for q in want:
        mine = sorted((r["rank"], -r["score"], r["vec_id"]) for r in got if r["query_id"] == q)
        assert [m[0] for m in mine] == list(range(1, 21)) and [m[1:] for m in mine] == sorted(m[1:] for m in mine)


def test_small_tables_copies_and_ties(spark):
    vectors = [[1.0, 0.0]] * 60 + [[0.5, 0.5], [2.0, 0.0], [-1.0, 0.0]]
    ids = list(range(63))
    df = frame(spark, ids, vectors)
    got = ann.nearest(df, df.where("vec_id in (0, 62)"), k=10).collect()
    for q, want in exact(ids, np.array(vectors), {0, 62}, 10).items():
        assert [(r["vec_id"]) for r in sorted((r for r in got if r["query_id"] == q), key=lambda r: r["rank"])] == [
            j for _, j in want]
    few = ann.nearest(frame(spark, [0, 1, 2], [[1.0, 2.0], [3.0, 4.0], [0.5, 0.0]]),
                      frame(spark, [0], [[1.0, 2.0]])).collect()
    assert [(r["rank"], r["vec_id"], r["score"]) for r in few] == [(1, 1, 11.0), (2, 2, 0.5)]


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [[1.0, 1.0], [1.0, 2.0], None, [0.0, 0.0], [None, 1.0], [nan, 1.0], [inf, 1.0], [1.0], [], [1e200, 1.0], [1.0, 1.0]]
    df = frame(spark, [0, 1, 2, 3, 4, 5, 6, 7, 8, 9, None], vectors).unionByName(
        frame(spark, [1, 1, 20], [[1.0, 2.0], [5.0, 5.0], [3.0, 0.0]]))
    got = ann.nearest(df, df.where("vec_id % 20 = 0")).orderBy("query_id", "rank").collect()
    assert [(r["query_id"], r["vec_id"], r["score"]) for r in got] == [
        (0, 9, 1e200), (0, 1, 10.0), (0, 20, 3.0), (20, 9, 3e200), (20, 1, 15.0), (20, 0, 3.0)]
    none = spark.createDataFrame([], SHAPE)
    assert ann.nearest(none, none).count() == 0 and ann.nearest(df, none).count() == 0 and ann.nearest(none, df).count() == 0


@pytest.mark.parametrize("norms", [[1e200, 3e201, 1e-200], [3e3, 1e6, 1e9, 1e12], [1e300, 1.7e308]])
def test_recall_beside_outlier_norms(norms):
    rng = np.random.default_rng(2)
    vectors = rng.standard_normal((2500, 24))
    vectors /= np.linalg.norm(vectors, axis=1)[:, None]
    queries = vectors[::50].copy()
    for i, norm in enumerate(norms):
        vectors[7 * i + 1] *= norm
    shard = ann.Shard(np.arange(2500), vectors)
    got = defaultdict(list)
    for q, i, score in shard.nearest(np.arange(-50, 0), queries, 20, ann.SEARCH_BEAM):
        got[q].append(i)
        assert np.isclose(score, vectors[i] @ queries[q], rtol=1e-12)
    scores = queries @ vectors.T
    want = np.argsort(-scores, axis=1, kind="stable")[:, :20]
    assert sum(len(set(want[q].tolist()) & set(got[q])) for q in got) >= 0.95 * want.size
    assert all(len(got[q]) == 20 for q in range(-50, 0))


@pytest.mark.parametrize("spread", [0.5, 3, 100])
def test_recall_over_wide_norms(spread):
    rng = np.random.default_rng(3)
    vectors = rng.standard_normal((3000, 24)) * 10 ** rng.uniform(-spread, spread, (3000, 1))
    queries = rng.standard_normal((40, 24))
    got = defaultdict(set)
    for q, i, _ in ann.Shard(np.arange(3000), vectors).nearest(np.arange(-40, 0), queries, 20, ann.SEARCH_BEAM):
        got[q].add(i)
    want = np.argsort(-(queries @ vectors.T), axis=1, kind="stable")[:, :20]
    assert sum(len(set(want[q].tolist()) & got[q]) for q in got) >= 0.95 * want.size


def test_every_point_is_reached_and_degrees_are_bounded():
    rng = np.random.default_rng(1)
    points = np.concatenate([rng.standard_normal((700, 8)) * 0.01 + c for c in rng.standard_normal((5, 8)) * 50]).astype(np.float32)
    graph = Graph(points, degree=8, beam=16)
    seen, front = set(), set(graph.entries.tolist())
    while front:
        seen |= front
        front = {int(e) for p in front for e in graph.edges[p] if e >= 0} - seen
    assert seen == set(range(len(points)))
    for p in range(0, len(points), 97):
        own = graph.edges[p][graph.edges[p] >= 0].tolist()
        assert len(set(own)) == len(own) <= 8 and p not in own
