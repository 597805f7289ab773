"""A bidirectional gated recurrent network with attention pooling, in numpy.

It reads windows of words. A word's input is the embedding of the word beside the mean embedding of its
character n-grams; rare words and n-grams have none. The forward and the backward state of each word are
pooled by attention, and a linear unit gives the window's logit.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

from cohortbench.llm.common import mixed, word_bounds, word_hashes

WINDOW = 32
STRIDE = 16
GRAMS = (3, 4, 5)
WIDTH = 12  # of each embedding
HIDDEN = 16
SLOTS = 1 << 20

#: Code points of the longest run that is one word, and of the pieces of longer ones.
LONGEST_WORD = 32
PIECE = 8

#: Windows that are computed at once.
BLOCK = 2048

_IS_WORD = np.zeros(256, bool)
_IS_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


@dataclass
class Words:
    """The words of some rows: each row's place in the distinct words, and those words' n-gram slots."""

    place: np.ndarray  # of each word among the distinct ones
    row: np.ndarray
    slot: np.ndarray  # of each distinct word
    gram_word: np.ndarray  # ascending
    gram_slot: np.ndarray


def _pieces(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and word of every piece: long words are cut before code points, others are one piece."""
    leads = (data & 0xC0) != 0x80
    before = np.concatenate([[0], np.cumsum(leads)])
    size = before[ends] - before[starts]
    n = np.where(size > LONGEST_WORD, -(-size // PIECE), 1)
    word = np.repeat(np.arange(len(starts)), n)
    k = np.arange(len(word)) - np.repeat(np.cumsum(n) - n, n)
    first, later = starts[word], k > 0
    first[later] = np.flatnonzero(leads)[before[first[later]] + k[later] * PIECE]
    last = ends[word]
    last[:-1][later[1:]] = first[1:][later[1:]]
    return first, last, word


def read_words(data: np.ndarray, rows: np.ndarray) -> Words:
    """Letters, digits and all bytes beyond ASCII make words; A to Z count as lower case.

    Runs over LONGEST_WORD code points, as in scripts without spaces, count as words of PIECE code points.
    """
    data = _LOWER[data]
    starts, ends, row = word_bounds(data, rows, _IS_WORD[data])
    starts, ends, word = _pieces(data, starts, ends)
    row = row[word]
    hashes = word_hashes(data, starts, ends)
    distinct, first, place = np.unique(hashes, return_index=True, return_inverse=True)
    sizes = ends[first] - starts[first]
    begin = np.cumsum(sizes + 2) - (sizes + 2)
    total = int((sizes + 2).sum())
    chars = np.zeros(total, np.uint64)
    inner = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    chars[np.repeat(begin + 1, sizes) + inner] = data[np.repeat(starts[first], sizes) + inner]
    chars[begin], chars[begin + sizes + 1] = 1, 2
    owner = np.repeat(np.arange(len(distinct)), sizes + 2)
    words, slots = [], []
    for n in GRAMS:
        if total < n:
            continue
        key = np.zeros(total - n + 1, np.uint64)
        for k in range(n):
            key = key * np.uint64(257) + chars[k : total - n + 1 + k]
        whole = owner[: total - n + 1] == owner[n - 1 :]
        words.append(owner[: total - n + 1][whole])
        slots.append((mixed(key[whole] + np.uint64(n << 56)) % np.uint64(SLOTS)).astype(np.int64))
    if words:
        word, slot = np.concatenate(words), np.concatenate(slots)
        order = np.argsort(word, kind="stable")
        word, slot = word[order], slot[order]
    else:
        word, slot = np.zeros(0, np.int64), np.zeros(0, np.int64)
    return Words(place.ravel(), row, (distinct % np.uint64(SLOTS)).astype(np.int64), word, slot)


def windows(words: Words, n_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Overlapping windows (places of distinct words, the number of them where there is none) and their rows.

    Every word lies in a window, and most in two; a row without words has one empty window.
    """
    count = np.bincount(words.row, minlength=n_rows)
    first = np.cumsum(count) - count
    n = 1 + np.maximum(0, -(-(count - WINDOW) // STRIDE))
    row = np.repeat(np.arange(n_rows), n)
    k = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
    at = (k * STRIDE)[:, None] + np.arange(WINDOW)
    there = at < count[row][:, None]
    place = np.append(words.place, 0)[np.where(there, first[row][:, None] + at, len(words.place))]
    return np.where(there, place, len(words.slot)), row


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return np.float32(0.5) * np.tanh(np.float32(0.5) * x) + np.float32(0.5)


@dataclass
class Network:
    word_rows: np.ndarray  # slot to row of the word embeddings; 0: none
    gram_rows: np.ndarray
    p: dict[str, np.ndarray] = field(default_factory=dict)

    @staticmethod
    def fresh(word_rows: np.ndarray, gram_rows: np.ndarray, seed: int = 7) -> Network:
        rng = np.random.default_rng(seed)

        def some(*shape: int, scale: float) -> np.ndarray:
            return (rng.standard_normal(shape) * scale).astype(np.float32)

        p = {"words": some(int(word_rows.max(initial=0)) + 1, WIDTH, scale=0.1),
             "grams": some(int(gram_rows.max(initial=0)) + 1, WIDTH, scale=0.1)}
        p["words"][0] = p["grams"][0] = 0
        for side in "fb":
            p["W" + side] = some(2 * WIDTH, 3 * HIDDEN, scale=0.3)
            p["U" + side] = some(HIDDEN, 3 * HIDDEN, scale=0.25)
            p["b" + side] = np.zeros(3 * HIDDEN, np.float32)
        p |= {"attend": some(2 * HIDDEN, scale=0.3), "out": some(2 * HIDDEN, scale=0.3), "bias": np.zeros(1, np.float32)}
        return Network(word_rows, gram_rows, p)

    def grams_of(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """(distinct word, embedding row) of the n-grams that have an embedding."""
        row = self.gram_rows[words.gram_slot]
        return words.gram_word[row > 0], row[row > 0]

    def inputs(self, words: Words) -> np.ndarray:
        """Input of each distinct word."""
        x = np.zeros((len(words.slot), 2 * WIDTH), np.float32)
        x[:, :WIDTH] = self.p["words"][self.word_rows[words.slot]]
        word, row = self.grams_of(words)
        if len(word):
            own, first, count = np.unique(word, return_index=True, return_counts=True)
            x[own, WIDTH:] = np.add.reduceat(self.p["grams"][row], first) / np.sqrt(count)[:, None]
        return x

    def _project(self, x: np.ndarray, side: str) -> np.ndarray:
        """Gate inputs of each distinct word, then of no word: its update gate keeps the state."""
        none = np.zeros((1, 3 * HIDDEN), np.float32)
        none[0, :HIDDEN] = 40
        return np.concatenate([x @ self.p["W" + side] + self.p["b" + side], none])

    def _run(self, gates: np.ndarray, places: np.ndarray, side: str, keep: list | None = None) -> np.ndarray:
        """States [time, window, HIDDEN] in reading order."""
        n, u = len(places), self.p["U" + side]
        h = np.zeros((n, HIDDEN), np.float32)
        out = np.empty((WINDOW, n, HIDDEN), np.float32)
        for t in range(WINDOW) if side == "f" else range(WINDOW - 1, -1, -1):
            x, hu = gates[places[:, t]], h @ u
            zr = _sigmoid(x[:, : 2 * HIDDEN] + hu[:, : 2 * HIDDEN])
            z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
            c = np.tanh(x[:, 2 * HIDDEN :] + r * hu[:, 2 * HIDDEN :])
            if keep is not None:
                keep.append((t, h, z, r, c, hu[:, 2 * HIDDEN :]))
            h = c + z * (h - c)
            out[t] = h
        return out

    def _pool(self, states: np.ndarray, there: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Attention [time, window] over the words that are there, and the pooled state."""
        e = np.where(there, states @ self.p["attend"], np.float32(-1e9))
        e = np.exp(e - e.max(0))
        a = e * there
        a = a / np.maximum(a.sum(0), np.float32(1e-9))
        return a, np.einsum("tn,tnh->nh", a, states)

    def logits(self, words: Words, places: np.ndarray) -> np.ndarray:
        x = self.inputs(words)
        gates = {side: self._project(x, side) for side in "fb"}
        out = np.empty(len(places), np.float32)
        for at in range(0, len(places), BLOCK):
            some = places[at : at + BLOCK]
            states = np.concatenate([self._run(gates[s], some, s) for s in "fb"], 2)
            _, pooled = self._pool(states, (some < len(x)).T)
            out[at : at + BLOCK] = pooled @ self.p["out"] + self.p["bias"]
        return out

    def gradients(self, words: Words, places: np.ndarray, truth: np.ndarray, weight: np.ndarray,
                  mute: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients of the weighted log loss. ``places`` count the distinct words of ``words``;
        ``mute`` marks those whose word embedding is left out this time."""
        p, n = self.p, len(places)
        x = self.inputs(words)
        x[mute, :WIDTH] = 0
        kept: dict[str, list] = {"f": [], "b": []}
        states = np.concatenate([self._run(self._project(x, s), places, s, kept[s]) for s in "fb"], 2)
        there = (places < len(x)).T
        a, pooled = self._pool(states, there)
        d = (_sigmoid(pooled @ p["out"] + p["bias"][0]) - truth) * weight / n
        g = {"out": pooled.T @ d, "bias": np.array([d.sum()], np.float32)}
        dpool = d[:, None] * p["out"]
        da = np.einsum("nh,tnh->tn", dpool, states)
        de = a * (da - (a * da).sum(0))
        g["attend"] = np.einsum("tn,tnh->h", de, states)
        dstates = a[:, :, None] * dpool + de[:, :, None] * p["attend"]
        dx = np.zeros((len(x) + 1, 2 * WIDTH), np.float32)
        for i, s in enumerate("fb"):
            u, du, dw, db = p["U" + s], np.zeros_like(p["U" + s]), np.zeros_like(p["W" + s]), np.zeros_like(p["b" + s])
            dh = np.zeros((n, HIDDEN), np.float32)
            padded = np.concatenate([x, np.zeros((1, 2 * WIDTH), np.float32)])
            for t, h, z, r, c, hun in reversed(kept[s]):
                dh = dh + dstates[t, :, i * HIDDEN : (i + 1) * HIDDEN]
                dc = dh * (1 - z) * (1 - c * c)
                dz = dh * (h - c) * z * (1 - z)
                dr = dc * hun * r * (1 - r)
                pre = np.concatenate([dz, dr, dc], 1)
                rec = np.concatenate([dz, dr, dc * r], 1)
                live = there[t][:, None]
                pre = pre * live
                du += h.T @ rec
                dw += padded[places[:, t]].T @ pre
                db += pre.sum(0)
                np.add.at(dx, places[:, t], pre @ p["W" + s].T)
                dh = dh * z + rec @ u.T
            g |= {"U" + s: du, "W" + s: dw, "b" + s: db}
        dx = dx[:-1]
        dx[mute, :WIDTH] = 0
        g["words"] = (self.word_rows[words.slot], dx[:, :WIDTH])
        word, row = self.grams_of(words)
        count = np.bincount(word, minlength=len(x))[word] if len(word) else np.zeros(0)
        g["grams"] = (row, dx[word, WIDTH:] / np.sqrt(count)[:, None])
        return g


def part_of(words: Words, places: np.ndarray) -> tuple[Words, np.ndarray]:
    """Only the distinct words that ``places`` hold, with the places counted among them."""
    own, new = np.unique(places, return_inverse=True)
    new = new.reshape(places.shape)
    if len(own) and own[-1] == len(words.slot):
        own = own[:-1]
    lo, hi = np.searchsorted(words.gram_word, own, "left"), np.searchsorted(words.gram_word, own, "right")
    count = hi - lo
    inner = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
    return Words(words.place[:0], words.row[:0], words.slot[own], np.repeat(np.arange(len(own)), count),
                 words.gram_slot[np.repeat(lo, count) + inner]), new


class Optimiser:
    """Adam for the dense parameters, Adagrad for the rows of the embeddings that a step touches."""

    def __init__(self, net: Network, rate: float = 0.01, row_rate: float = 0.08):
        self.net, self.rate, self.row_rate, self.steps = net, rate, row_rate, 0
        self.m = {k: np.zeros_like(v) for k, v in net.p.items()}
        self.v = {k: np.zeros_like(v) for k, v in net.p.items()}

    def step(self, grads: dict) -> None:
        self.steps += 1
        for k, g in grads.items():
            if isinstance(g, tuple):
                rows, values = g
                own, which = np.unique(rows, return_inverse=True)
                total = np.zeros((len(own), WIDTH), np.float32)
                np.add.at(total, which.ravel(), values)
                total[own == 0] = 0
                self.v[k][own] += total**2
                self.net.p[k][own] -= self.row_rate * total / (np.sqrt(self.v[k][own]) + 1e-6)
            else:
                g = np.clip(g, -1, 1)
                self.m[k] = 0.9 * self.m[k] + 0.1 * g
                self.v[k] = 0.999 * self.v[k] + 0.001 * g * g
                m, v = self.m[k] / (1 - 0.9**self.steps), self.v[k] / (1 - 0.999**self.steps)
                self.net.p[k] = (self.net.p[k] - self.rate * m / (np.sqrt(v) + 1e-7)).astype(np.float32)
