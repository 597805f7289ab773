"""The network's gradients, its windows, and held-out accuracy."""

import random
import zlib

import numpy as np
import pytest

from cohortbench.llm import gru, toxicity
from cohortbench.llm.common import word_bounds


def read(texts):
    raw = [t.encode() for t in texts]
    rows = np.concatenate([[0], np.cumsum([len(t) for t in raw], dtype=np.int64)])
    return gru.read_words(np.frombuffer(b"".join(raw), np.uint8), rows)


@pytest.mark.parametrize("sizes", [[0], [1], [32], [33], [48], [49], [0, 100, 5, 0, 64]])
def test_windows_hold_every_word(sizes):
    words = read([" ".join(f"w{i}x{k}" for k in range(n)) for i, n in enumerate(sizes)])
    places, row = gru.windows(words, len(sizes))
    first = np.cumsum(sizes) - sizes
    for i, n in enumerate(sizes):
        mine = places[row == i]
        held = [list(p[p < len(words.slot)]) for p in mine]
        assert len(mine) == 1 + max(0, -(-(n - gru.WINDOW) // gru.STRIDE))
        want = words.place[first[i] : first[i] + n].tolist()
        assert all(h == want[k * gru.STRIDE : k * gru.STRIDE + gru.WINDOW] for k, h in enumerate(held))
        assert {x for h in held for x in h} == set(want)


def test_gradients_against_differences():
    words = read(["the cat sat on a mat", "dogs bark", "a mat"])
    places, _ = gru.windows(words, 3)
    rows = np.arange(1, gru.SLOTS + 1, dtype=np.int32) % 200
    net = gru.Network.fresh(rows, rows)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    truth, weight, mute = np.array([1.0, 0.0, 1.0]), np.array([1.0, 2.0, 0.5]), np.zeros(len(words.slot), bool)

    def loss():
        z = net.logits(words, places).astype(np.float64)
        return float(np.mean(weight * (np.logaddexp(0, z) - truth * z)))

    grads = net.gradients(words, places, truth, weight, mute)
    rng = np.random.default_rng(0)
    for name in ("Wf", "Ub", "bf", "bb", "attend", "out", "bias"):
        flat = net.p[name].reshape(-1)
        for i in rng.choice(len(flat), min(4, len(flat)), replace=False):
            old = flat[i]
            flat[i] = old + 3e-3
            up = loss()
            flat[i] = old - 3e-3
            down = loss()
            flat[i] = old
            assert abs((up - down) / 6e-3 - grads[name].reshape(-1)[i]) < 2e-3 + 0.05 * abs(grads[name].reshape(-1)[i]), name


def corpus(n, seed):
    rng = random.Random(seed)
    clean = ["".join(rng.choice("aeiourstln") for _ in range(5)) for _ in range(150)]
    bad = ["zork", "blegh", "vexu" + "ta", "vexuly", "vexumo"]
    docs, labels = [], []
    for i in range(n):
        words = [rng.choice(clean) for _ in range(rng.randint(5, 90))]
        toxic = rng.random() < 0.25
        if toxic:
            for _ in range(rng.randint(1, 3)):
                words.insert(rng.randint(0, len(words)), rng.choice(bad))
        docs.append((i, " ".join(words), 0.5))
        labels.append((i, 0, int(toxic)))
    return docs, labels


def test_held_out_accuracy(spark):
    docs, labels = corpus(700, 4)
    got = toxicity.toxicity(
        spark.createDataFrame([*docs, (None, None, 0.0), (10_000, "", 0.0), (0, docs[0][1], 0.0)], "doc_id long, text string, score double"),
        spark.createDataFrame([*labels, (None, 0, 1), (5, 0, None)], "doc_id long, quality int, toxic int")).collect()
    truth = {i: t for i, _, t in labels}
    assert len(got) == 703 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got)
    for r in got:
        if r["doc_id"] is not None:
            assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
    held = [(r["predicted"], truth[r["doc_id"]]) for r in got if r["held_out"] and r["doc_id"] in truth]
    assert len(held) > 100 and sum(p == t for p, t in held) > 0.93 * len(held)
    twice = [r["score"] for r in got if r["doc_id"] == 0]
    assert len(twice) == 2 and abs(twice[0] - twice[1]) < 1e-5


def test_without_labels(spark, odd_docs, no_docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = toxicity.toxicity(odd_docs, none).collect()
    assert len(got) == odd_docs.count() and {r["score"] for r in got} == {0.0}
    assert toxicity.toxicity(no_docs, none).count() == 0


def test_texts_of_any_batch_score_alike():
    docs, labels = corpus(120, 6)
    texts = [t.encode() for _, t, _ in docs]
    scorer = toxicity.fit(texts, np.array([t for *_, t in labels], np.float32), 0.25, toxicity.Training(rounds=1))
    rows = np.concatenate([[0], np.cumsum([len(t) for t in texts], dtype=np.int64)])
    whole = scorer.scores(np.frombuffer(b"".join(texts), np.uint8), rows)
    alone = [scorer.scores(np.frombuffer(t, np.uint8), np.array([0, len(t)]))[0] for t in texts]
    assert np.allclose(whole, alone, atol=1e-5)


def test_runs_without_breaks_are_cut_into_words():
    texts = ["汉字漢語" * 500, "x" * 33, "y" * 32, "short words stay", "", "é" * 40 + " end", "\U0001F600" * 100]
    raw = [t.encode() for t in texts]
    rows = np.cumsum([0, *map(len, raw)])
    data = np.frombuffer(b"".join(raw), np.uint8)
    words = gru.read_words(data, rows)
    assert np.bincount(words.row, minlength=len(texts)).tolist() == [250, 5, 1, 3, 0, 6, 13]
    starts, ends, _ = word_bounds(data, rows, gru._IS_WORD[data])
    first, last, word = gru._pieces(data, starts, ends)
    for w, (a, b) in enumerate(zip(starts, ends, strict=True)):
        own = [data[x:y].tobytes().decode() for x, y in zip(first[word == w], last[word == w], strict=True)]
        assert "".join(own) == data[a:b].tobytes().decode()
        assert len(own) == 1 or max(map(len, own)) == gru.PIECE
    _, row = gru.windows(words, len(texts))
    assert np.bincount(row).tolist() == [1 + -(-(250 - gru.WINDOW) // gru.STRIDE), 1, 1, 1, 1, 1, 1]
