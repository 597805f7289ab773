"""Leading eigenpairs of a symmetric matrix: Householder, Sturm counts, inverse iteration."""

from __future__ import annotations

import numpy as np

EPS = float(np.finfo(float).eps)

#: Eigenvalues closer than this share of the norm are a cluster, whose vectors are made orthogonal to each other.
CLUSTER = 1e-3

#: Solves of the inverse iteration; the second is enough for eigenvalues to full precision.
SOLVES = 4


def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, off-diagonal, and the reflections H1, H2, ... (as unit vectors) with T = ... H2 H1 A H1 H2 ..."""
    a = np.array(a, float)
    n = len(a)
    reflections = []
    for k in range(n - 2):
        x = a[k + 1 :, k].copy()
        size = np.abs(x).max()
        v = np.zeros(n - k - 1)
        if size > 0:
            x /= size
            x[0] += np.copysign(np.linalg.norm(x), x[0])
            length = np.linalg.norm(x)
            v = x / length if length > 0 else v
            sub = a[k + 1 :, k + 1 :]
            p = sub @ v
            w = p - (v @ p) * v
            sub -= 2 * np.outer(v, w) + 2 * np.outer(w, v)
            column = a[k + 1 :, k]
            column -= 2 * (v @ column) * v
            a[k, k + 1 :] = column
        reflections.append(v)
    return np.diag(a).copy(), np.diag(a, 1).copy(), reflections


def below(d: np.ndarray, e: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    """Sturm count: how many eigenvalues of the tridiagonal matrix lie below each shift."""
    tiny = EPS * EPS * max(1e-300, float(np.abs(d).max(initial=0)) + float(np.abs(e).max(initial=0))) + 1e-300
    counts = np.zeros(len(shifts), int)
    q = d[0] - shifts
    for i in range(len(d)):
        if i:
            q = d[i] - shifts - e[i - 1] * e[i - 1] / q
        q = np.where(np.abs(q) < tiny, -tiny, q)
        counts += q < 0
    return counts


def leading_values(d: np.ndarray, e: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` largest eigenvalues, falling, by bisection on Sturm counts, all at once."""
    n = len(d)
    k = min(k, n)
    around = np.zeros(n)
    around[:-1] += np.abs(e)
    around[1:] += np.abs(e)
    low, high = float((d - around).min()), float((d + around).max())
    room = EPS * max(abs(low), abs(high)) * n + 1e-300
    lows, highs = np.full(k, low - room), np.full(k, high + room)
    place = n - 1 - np.arange(k)
    for _ in range(2100):
        middle = lows + (highs - lows) / 2
        if not ((middle > lows) & (middle < highs)).any():
            break
        more = below(d, e, middle) > place
        highs, lows = np.where(more, middle, highs), np.where(more, lows, middle)
    return lows + (highs - lows) / 2


def _factors(d: np.ndarray, e: np.ndarray, shift: float, norm: float):
    """Rows of the triangular factor of T - shift, with row exchanges, and what was done to get there."""
    n = len(d)
    least = EPS * norm if norm else 1.0
    diagonal, above, second = (d - shift).tolist(), [*e.tolist(), 0.0], [0.0] * n
    steps = []
    for i in range(n - 1):
        under = float(e[i])
        if abs(diagonal[i]) >= abs(under):
            if abs(diagonal[i]) < least:
                diagonal[i] = least
            factor = under / diagonal[i]
            diagonal[i + 1] -= factor * above[i]
            steps.append((False, factor))
        else:
            factor = diagonal[i] / under
            next_diagonal, next_above = diagonal[i + 1], above[i + 1]
            diagonal[i], old = under, above[i]
            above[i], second[i] = next_diagonal, next_above
            diagonal[i + 1] = old - factor * next_diagonal
            above[i + 1] = -factor * next_above
            steps.append((True, factor))
    if abs(diagonal[-1]) < least:
        diagonal[-1] = least
    return diagonal, above, second, steps


def _solve(factors, right: np.ndarray) -> np.ndarray:
    diagonal, above, second, steps = factors
    x = right.tolist()
    for i, (exchanged, factor) in enumerate(steps):
        if exchanged:
            x[i], x[i + 1] = x[i + 1], x[i]
        x[i + 1] -= factor * x[i]
    n = len(x)
    for i in range(n - 1, -1, -1):
        rest = x[i]
        if i + 1 < n:
            rest -= above[i] * x[i + 1]
        if i + 2 < n:
            rest -= second[i] * x[i + 2]
        x[i] = rest / diagonal[i]
        if abs(x[i]) > 1e200:
            x = [v * 1e-200 for v in x]
    return np.array(x)


def leading(a: np.ndarray, k: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues, falling, and their unit eigenvectors as columns.

    The matrix is brought to tridiagonal form, eigenvalues are found by bisection, and each vector by
    inverse iteration there; vectors of a cluster are made orthogonal to the earlier ones of it after
    each solve. Equal eigenvalues give any orthonormal basis. An empty matrix has none.
    """
    a = np.asarray(a, float)
    n = len(a)
    k = min(k, n)
    if not k:
        return np.zeros(0), np.zeros((n, 0))
    scale = float(np.abs(a).max()) or 1.0
    d, e, reflections = tridiagonal(a / scale)
    values = leading_values(d, e, k)
    norm = float((np.abs(d) + np.append(np.abs(e), 0) + np.append(0, np.abs(e))).max())
    rng = np.random.default_rng(seed)
    vectors = np.zeros((n, k))
    start = 0
    shift = np.inf
    for j in range(k):
        if j and values[j - 1] - values[j] > CLUSTER * norm:
            start = j
        # Equal eigenvalues get shifts a little apart.
        shift = min(float(values[j]), shift - 2 * EPS * norm) if j > start else float(values[j])
        factors = _factors(d, e, shift, norm)
        earlier = vectors[:, start:j]
        x = rng.uniform(-1, 1, n)
        for _ in range(SOLVES):
            x = _solve(factors, x / np.linalg.norm(x))
            x /= np.abs(x).max()
            for _ in range(2):
                x -= earlier @ (earlier.T @ x)
            if np.linalg.norm(x) < 1e-8:
                x = rng.uniform(-1, 1, n)
                x -= earlier @ (earlier.T @ x)
        vectors[:, j] = x / np.linalg.norm(x)
    for i in range(len(reflections) - 1, -1, -1):
        v = reflections[i]
        vectors[i + 1 :] -= 2 * np.outer(v, v @ vectors[i + 1 :])
    vectors /= np.linalg.norm(vectors, axis=0)
    return values * scale, vectors
