"""Leading eigenpairs against numpy's."""

import numpy as np
import pytest

from cohortbench.llm.eigen import below, leading, leading_values, tridiagonal


def matrices():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(200, 40)) * np.linspace(1, 9, 40)
    yield "covariance", x.T @ x / 200
    q = np.linalg.qr(rng.normal(size=(30, 30)))[0]
    yield "clusters", q @ np.diag([5.0] * 6 + [5 - 1e-9] * 4 + [2.0] * 10 + list(np.linspace(0, 1, 10))) @ q.T
    yield "identity", np.eye(12)
    yield "diagonal", np.diag([3.0, 7, 7, 1, 0, -2])
    yield "zero", np.zeros((5, 5))
    yield "one", np.array([[4.0]])
    yield "two", np.array([[2.0, 1e-9], [1e-9, 2.0]])
    yield "large", (x.T @ x) * 1e30
    yield "small", (x.T @ x) * 1e-30
    y = rng.normal(size=(5, 40))
    yield "low rank", y.T @ y
    yield "wilkinson", np.diag(np.abs(np.arange(-10.0, 11))) + np.diag(np.ones(20), 1) + np.diag(np.ones(20), -1)


@pytest.mark.parametrize("name, a", list(matrices()), ids=lambda x: x if isinstance(x, str) else "")
def test_values_and_vectors(name, a):
    k = min(16, len(a))
    values, vectors = leading(a, k)
    want = np.linalg.eigvalsh(a)[::-1][:k]
    norm = np.abs(a).max() or 1.0
    assert np.allclose(values, want, rtol=0, atol=1e-13 * len(a) * norm)
    assert np.abs(vectors.T @ vectors - np.eye(k)).max() < 1e-12
    assert np.abs(a @ vectors - vectors * values).max() < 1e-12 * len(a) * norm


def test_tridiagonal_keeps_the_spectrum_and_sturm_counts_it():
    rng = np.random.default_rng(2)
    a = rng.normal(size=(25, 25))
    a = a + a.T
    d, e, _ = tridiagonal(a)
    t = np.diag(d) + np.diag(e, 1) + np.diag(e, -1)
    want = np.linalg.eigvalsh(a)
    assert np.allclose(np.linalg.eigvalsh(t), want)
    shifts = np.linspace(want[0] - 1, want[-1] + 1, 57)
    assert below(d, e, shifts).tolist() == [(want < s).sum() for s in shifts]
    assert np.allclose(leading_values(d, e, 25), want[::-1])


def test_no_matrix():
    assert leading(np.zeros((0, 0)), 5)[0].shape == (0,)
