"""An M-tree: pages of metric nodes with covering radii and distances to their parents, searched best-first.

Points are rows of whole numbers; the metric is Euclidean. An entry of an inner page is a router with the
largest distance to a point below it (its covering radius), the largest norm below it, and its distance to
the router of its page. A search asks for the largest inner products. For a query q and a point x within r
of a router p, q.x is at most q.p + |q| r, and at most (|q|^2 + |x|^2 - (d(q, p) - r)^2) / 2. Both hold too
with r plus the distance to the parent in place of r and the parent in place of p, so that an entry whose
bound by the parent is already too low is passed over without its own product being computed.
"""

from __future__ import annotations

import heapq

import numpy as np

#: Entries of a page.
PAGE = 128

#: Whole numbers below this are exact as doubles, sums of their products included.
EXACT = 2.0**53

LONGEST = 2**63 - 1


class Tree:
    """Distinct points with their ids; an id may stand at several points, a point may have several ids."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, page: int = PAGE, seed: int = 0):
        self.page = max(2, page)
        self.points, which = np.unique(vectors + 0.0, axis=0, return_inverse=True)
        which = which.ravel()
        order = np.lexsort((ids, which))
        self.ids = ids[order]
        self.first = np.searchsorted(which[order], np.arange(len(self.points) + 1))
        self.squares = np.einsum("ij,ij->i", self.points, self.points)
        self.norms = np.sqrt(self.squares)
        #: Pages: a leaf is (True, points, distances to its router), an inner page (False, routers, distances
        #: to its router, radii, largest norms, pages below).
        self.pages: list[tuple] = []
        self.computed = self.avoided = 0
        rng = np.random.default_rng(seed)
        n = len(self.points)
        self.root_router = int(np.argmin(self._distances(np.arange(n), self.points.mean(0)))) if n else 0
        if n:
            every = np.arange(n)
            self._build(every, self._distances(every, self.points[self.root_router]), rng)

    def _distances(self, rows: np.ndarray, other: np.ndarray) -> np.ndarray:
        d = self.squares[rows] + other @ other - 2 * (self.points[rows] @ other)
        return np.sqrt(np.maximum(d, 0))

    def _build(self, every: np.ndarray, far: np.ndarray, rng: np.random.Generator) -> None:
        """Splits the members of a page among routers drawn from them, until they fit a page."""
        todo: list[tuple[int, np.ndarray, np.ndarray, int]] = [(0, every, far, self.root_router)]
        self.pages.append(())
        while todo:
            at, rows, far, router = todo.pop()
            if len(rows) <= self.page:
                self.pages[at] = (True, rows, far)
                continue
            groups = self._split(rows, rng)
            routers = np.array([g[0] for g in groups])
            children = np.arange(len(self.pages), len(self.pages) + len(groups))
            self.pages.extend([()] * len(groups))
            # A hair is added, since distances are rounded.
            radii = np.array([g[2].max() for g in groups]) * (1 + 1e-12)
            norms = np.array([self.norms[g[1]].max() for g in groups]) * (1 + 1e-12)
            self.pages[at] = (False, routers, self._distances(routers, self.points[router]), radii, norms, children)
            todo += [(int(c), g[1], g[2], g[0]) for c, g in zip(children, groups, strict=True)]

    def _split(self, rows: np.ndarray, rng: np.random.Generator) -> list[tuple[int, np.ndarray, np.ndarray]]:
        """(router, its points, their distances): each point goes to the nearest of some routers among them."""
        fan = min(self.page, max(2, -(-2 * len(rows) // self.page)))
        routers = rng.choice(rows, fan, replace=False)
        d = np.stack([self._distances(rows, self.points[r]) for r in routers], 1)
        nearest = d.argmin(1)
        sizes = np.bincount(nearest, minlength=fan)
        if sizes.max() <= 0.9 * len(rows):
            return [(int(r), rows[own], d[own, i]) for i, r in enumerate(routers) if (own := np.flatnonzero(nearest == i)).size]
        # One router holds nearly all: shells around it keep the tree flat.
        hub = int(sizes.argmax())
        shells = np.array_split(np.argsort(d[:, hub], kind="stable"), fan)
        out = []
        for shell in shells:
            router = int(rows[shell[len(shell) // 2]])
            out.append((router, rows[shell], self._distances(rows[shell], self.points[router])))
        return out

    def _scores(self, query: np.ndarray, rows: np.ndarray, exact: bool) -> list[int]:
        if exact:
            return (self.points[rows] @ query).astype(np.int64).tolist()
        asked = [int(v) for v in query.tolist()]
        sums = (sum(int(a) * b for a, b in zip(p, asked, strict=True)) for p in self.points[rows].tolist())
        return [max(-LONGEST, min(LONGEST, s)) for s in sums]

    def search(self, query: np.ndarray, k: int, own: int | None = None, floor: float = -np.inf) -> list[tuple[int, int]]:
        """(score, id) of the ``k`` ids with the largest inner product, ``own`` left out, ties to smaller ids.

        An id counts with its best point. Scores below ``floor`` may be left out.
        """
        if not self.pages:
            return []
        square = float(query @ query)
        norm = np.sqrt(square)
        exact = norm * float(self.norms.max()) < EXACT / 4
        slack = 1e-11
        best: dict[int, int] = {}
        least = floor
        router = self.points[self.root_router]
        product = float(router @ query)
        far = np.sqrt(max(0.0, square + float(router @ router) - 2 * product))
        heap: list[tuple[float, int, float, float]] = [(-np.inf, 0, product, far)]
        while heap:
            bound, at, product, far = heapq.heappop(heap)
            if -bound < least:
                break
            page = self.pages[at]
            leaf, rows, parent = page[0], page[1], page[2]
            radii, norms = (0.0, self.norms[rows]) if leaf else (page[3], page[4])
            # First by the stored distance to the parent alone.
            gap = np.maximum(0, np.abs(far - parent) - radii)
            room = slack * (square + norms * norms + 1) + slack * abs(product)
            reach = np.minimum(product + norm * (parent + radii), (square + norms * norms - gap * gap) / 2) + room
            open_ = np.flatnonzero(reach >= least)
            self.avoided += len(rows) - len(open_)
            self.computed += len(open_)
            if not len(open_):
                continue
            rows = rows[open_]
            if leaf:
                scores = self._scores(query, rows, exact)
                changed = False
                for row, score in zip(rows.tolist(), scores, strict=True):
                    if score < least:
                        continue
                    a = self.first[row]
                    for i in self.ids[a : min(self.first[row + 1], a + k + 1)].tolist():
                        if i != own and best.get(i, -LONGEST - 1) < score:
                            best[i] = score
                            changed = True
                if changed and len(best) >= k:
                    kept = sorted(best.items(), key=lambda x: (-x[1], x[0]))[:k]
                    best = dict(kept)
                    least = max(floor, kept[-1][1])
                continue
            products = self.points[rows] @ query
            distances = np.sqrt(np.maximum(0, square + self.squares[rows] - 2 * products))
            r, m = radii[open_], norms[open_]
            gap = np.maximum(0, distances - r)
            reach = np.minimum(products + norm * r, (square + m * m - gap * gap) / 2) + room[open_] + slack * np.abs(products)
            for i in np.flatnonzero(reach >= least).tolist():
                heapq.heappush(heap, (-float(reach[i]), int(page[5][open_[i]]), float(products[i]), float(distances[i])))
        return sorted(((s, i) for i, s in best.items()), key=lambda x: (-x[0], x[1]))[:k]
