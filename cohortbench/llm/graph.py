"""A robust-pruned directed graph over the vectors of one shard, and beam search on it, in numpy.

All steps work on batches: a batch of points is searched in the graph built so far, each point's
candidates are pruned together, and the reverse edges of the batch are pruned together.
"""

from __future__ import annotations

import numpy as np

DEGREE = 32
BUILD_BEAM = 64
SEARCH_BEAM = 160
RELAXED = 1.2
ENTRIES = 32
BATCH = 256

#: Beam places whose edges are followed in one step.
WIDTH = 4


class Graph:
    """points: float32 rows, compared by squared Euclidean distance. edges: -1 where there is none."""

    def __init__(self, points: np.ndarray, degree: int = DEGREE, beam: int = BUILD_BEAM, relaxed: float = RELAXED,
                 seed: int = 0):
        self.points, self.degree, self.beam, self.relaxed = points, degree, beam, relaxed
        self.squares = np.einsum("ij,ij->i", points, points)
        n = len(points)
        self.edges = np.full((n, degree), -1, np.int32)
        middle = int(np.argmin(((points - points.mean(0)) ** 2).sum(1)))
        order = np.random.default_rng(seed).permutation(n).astype(np.int32)
        order = np.concatenate([[middle], order[order != middle]]).astype(np.int32)
        self.entries = order[:ENTRIES]
        first = order[:BATCH]
        self._connect(first, np.broadcast_to(first, (len(first), len(first))).copy())
        at = len(first)
        while at < n:
            batch = order[at : at + BATCH]
            found, _ = self.search(points[batch], beam)
            self._connect(batch, found)
            at += len(batch)
        self._reach()

    def _reach(self) -> None:
        """Points that no path leads to become entries."""
        seen = np.zeros(len(self.points), bool)
        front = self.entries
        while len(front):
            seen[front] = True
            nearby = np.unique(self.edges[front])
            front = nearby[(nearby >= 0) & ~seen[nearby]]
        self.entries = np.concatenate([self.entries, np.flatnonzero(~seen).astype(np.int32)])

    def _distances(self, rows: np.ndarray, others: np.ndarray) -> np.ndarray:
        """[b, c] between points[rows[b]] and points[others[b, c]]; infinite for -1."""
        d = self.squares[rows][:, None] + self.squares[others] - 2 * np.einsum(
            "bd,bcd->bc", self.points[rows], self.points[others])
        return np.where(others < 0, np.inf, np.maximum(d, 0))

    def _prune(self, rows: np.ndarray, others: np.ndarray) -> np.ndarray:
        """Edges of ``rows``: the nearest candidate goes in and drops those much nearer to it than to the row."""
        d = self._distances(rows, others)
        d[others == rows[:, None]] = np.inf
        order = np.argsort(d, axis=1, kind="stable")
        others, d = np.take_along_axis(others, order, 1), np.take_along_axis(d, order, 1)
        alive = np.isfinite(d)
        alive[:, 1:] &= others[:, 1:] != others[:, :-1]
        points = self.points[others]
        squares = self.squares[others]
        between = squares[:, :, None] + squares[:, None, :] - 2 * (points @ points.transpose(0, 2, 1))
        between *= self.relaxed**2
        out = np.full((len(rows), self.degree), -1, np.int32)
        every = np.arange(len(rows))
        for k in range(self.degree):
            best = alive.argmax(1)
            some = alive[every, best]
            if not some.any():
                break
            out[some, k] = others[every, best][some]
            alive &= between[every, best] > d
            alive[every, best] = False
        return out

    def _connect(self, batch: np.ndarray, candidates: np.ndarray) -> None:
        edges = self._prune(batch, candidates)
        self.edges[batch] = edges
        source, target = np.repeat(batch, self.degree), edges.ravel()
        source, target = source[target >= 0], target[target >= 0]
        order = np.argsort(target, kind="stable")
        source, target = source[order], target[order]
        hubs, first, count = np.unique(target, return_index=True, return_counts=True)
        used = (self.edges[hubs] >= 0).sum(1)
        place = np.arange(len(target)) - np.repeat(first, count)
        # Room for the edges there are and those that come; who has too many is pruned again.
        easy = used + count <= self.degree
        own = np.repeat(easy, count)
        self.edges[target[own], (np.repeat(used, count) + place)[own]] = source[own]
        crowded = np.flatnonzero(~easy)
        for at in range(0, len(crowded), BATCH):
            some = crowded[at : at + BATCH]
            wide = np.full((len(some), self.degree + int(count[some].max())), -1, np.int32)
            wide[:, : self.degree] = self.edges[hubs[some]]
            for i, h in enumerate(some.tolist()):
                wide[i, self.degree : self.degree + count[h]] = source[first[h] : first[h] + count[h]]
            self.edges[hubs[some]] = self._prune(hubs[some].astype(np.int32), wide)

    def search(self, queries: np.ndarray, beam: int = SEARCH_BEAM) -> tuple[np.ndarray, np.ndarray]:
        """Points and distances (less the query's own square) of the beam of each query; -1 and inf beyond."""
        out = [self._search(queries[at : at + BATCH], beam) for at in range(0, len(queries), BATCH)]
        if not out:
            return np.zeros((0, beam), np.int32), np.zeros((0, beam), np.float32)
        return np.concatenate([x[0] for x in out]), np.concatenate([x[1] for x in out])

    def _search(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        n, size = len(self.points), len(queries)
        every = np.arange(size)[:, None]
        seen = np.zeros((size, n), bool)
        stamp = np.zeros((size, n + 1), np.int32)
        best = np.full((size, beam), -1, np.int32)
        near = np.full((size, beam), np.inf, np.float32)
        done = np.ones((size, beam), bool)

        def offer(ids: np.ndarray) -> None:
            nonlocal best, near, done
            # Of equal points in a row the last one counts; -1 has a column of its own.
            place = np.arange(ids.shape[1], dtype=np.int32)[None, :]
            stamp[every, ids] = place
            fresh = (ids >= 0) & (stamp[every, ids] == place) & ~seen[every, ids]
            row, col = np.nonzero(fresh)
            point = ids[row, col]
            seen[row, point] = True
            d = np.full(ids.shape, np.inf, np.float32)
            d[row, col] = self.squares[point] - 2 * np.einsum("ij,ij->i", queries[row], self.points[point])
            near = np.concatenate([near, d], 1)
            best = np.concatenate([best, np.where(fresh, ids, -1)], 1)
            done = np.concatenate([done, ~fresh], 1)
            if near.shape[1] > beam:
                keep = np.argpartition(near, beam - 1, axis=1)[:, :beam]
                near, best, done = (np.take_along_axis(x, keep, 1) for x in (near, best, done))

        for at in range(0, len(self.entries), beam):
            offer(np.broadcast_to(self.entries[at : at + beam], (size, len(self.entries[at : at + beam]))).copy())
        while True:
            open_ = np.where(done, np.inf, near)
            step = np.argpartition(open_, WIDTH - 1, axis=1)[:, :WIDTH] if beam > WIDTH else np.argsort(open_, 1)
            follow = np.isfinite(np.take_along_axis(open_, step, 1))
            if not follow.any():
                break
            points = np.where(follow, np.take_along_axis(best, step, 1), 0)
            np.put_along_axis(done, step, True, 1)
            ids = np.where(follow[:, :, None], self.edges[points], -1).reshape(size, -1)
            offer(ids)
        order = np.argsort(near, axis=1, kind="stable")
        best, near = np.take_along_axis(best, order, 1), np.take_along_axis(near, order, 1)
        return np.where(np.isfinite(near), best, -1), near
