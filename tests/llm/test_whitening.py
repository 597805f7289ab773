"""Whitening against whole-table arithmetic."""

from fractions import Fraction

import numpy as np

from cohortbench.llm import whitening

INF, NAN = float("inf"), float("nan")


def brute(vectors):
    """vec rows -> (n, deviations, eigenvalues, covariance, mean) by whole numbers and numpy."""
    x = [tuple(int(np.floor(64 * float(c))) + 1_000_000 for c in v) for v in vectors]
    distinct = sorted(set(x))
    n = len(distinct)
    sums = [sum(v[j] for v in distinct) for j in range(len(x[0]))]
    deviations = [sum((n * a - s) ** 2 for a, s in zip(v, sums, strict=True)) for v in x]
    centred = np.array([[float(Fraction(n * a - s, n)) for a, s in zip(v, sums, strict=True)] for v in distinct])
    covariance = centred.T @ centred / n
    rows = np.array([[float(Fraction(n * a - s, n)) for a, s in zip(v, sums, strict=True)] for v in x])
    return n, deviations, covariance, rows


def checked(df, vectors, components=16):
    got = whitening.whiten(df, components).collect()
    n, deviations, covariance, rows = brute(vectors)
    values, columns = np.linalg.eigh(covariance)
    values, columns = values[::-1], columns[:, ::-1]
    k = min(components, int((values > 1e-9 * values.sum()).sum()))
    assert len(got) == len(vectors) * k
    by = {}
    for r in got:
        by.setdefault(r.vec_id, {})[r.component] = r
    for i in range(len(vectors)):
        assert sorted(by[i]) == list(range(1, k + 1))
        assert {(r.n, r.deviation) for r in by[i].values()} == {(n, deviations[i])}
    for c in range(k):
        want = rows @ columns[:, c] / np.sqrt(values[c])
        found = np.array([by[i][c + 1].whitened for i in range(len(vectors))])
        sign = 1 if want @ found > 0 else -1
        assert np.abs(found - sign * want).max() < 1e-6
        assert abs(by[0][c + 1].explained - values[c] / values.sum()) < 1e-10
    assert max(r.identity_error for r in got) < 1e-9
    assert len({r.identity_error for r in got}) == 1
    return got


def test_against_the_whole_table(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(700, 24)) * np.linspace(3, 0.5, 24)
    x[:230] = x[0]
    df = spark.createDataFrame(list(enumerate(x.tolist())), "vec_id long, embedding array<double>").repartition(5)
    checked(df, x.tolist())


def test_fewer_dimensions_than_components(spark):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(60, 3)) * [1, 2, 9]
    df = spark.createDataFrame(list(enumerate(x.tolist())), "vec_id long, embedding array<double>")
    checked(df, x.tolist())
    flat = [[a, 2 * a, 0.0] for a in range(20)]
    df = spark.createDataFrame(list(enumerate(map(lambda v: [float(c) for c in v], flat))), "vec_id long, embedding array<double>")
    assert {r.component for r in checked(df, flat)} == {1}


def test_equal_covariances_of_two_components(spark):
    x = [[a, b] for a in (-1.0, 1.0) for b in (-1.0, 1.0)]
    df = spark.createDataFrame(list(enumerate(x)), "vec_id long, embedding array<double>")
    got = whitening.whiten(df).collect()
    assert len(got) == 8 and abs(got[0].explained - 0.5) < 1e-12 and got[0].identity_error < 1e-12


def test_odd_rows(spark):
    rows = [(1, [0.5, 1.0]), (1, [0.5, 1.0]), (None, [0.5, 3.0]), (2, None), (3, [NAN, 1.0]), (4, [INF, 1.0]), (5, [1.0, None]),
            (6, []), (7, [1.0, 2.0, 3.0]), (8, [-2.0, 0.0]), (9, [1.0, 1e300])]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, n int")
    got = whitening.whiten(df.where("vec_id is null or vec_id < 9")).collect()
    assert sorted({(r.vec_id, r.n) for r in got}, key=str) == [(1, 3), (8, 3), (None, 3)]
    assert len(got) == 8
    got = whitening.whiten(df).collect()
    assert {r.vec_id for r in got} == {1, None, 8, 9}
    assert {r.deviation for r in got if r.vec_id == 9} == {None}
    assert whitening.whiten(df.limit(0)).collect() == []
    assert whitening.whiten(df.where("vec_id = 1")).collect() == []
