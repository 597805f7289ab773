"""Toxicity of whole texts: a recurrent network scores overlapping windows, the worst window decides.

The network is trained on a bounded sample of labelled texts. Only whole texts are labelled, so training
goes in rounds: the network picks the windows of each text that it holds for the worst, and learns the
text's label on them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from cohortbench.llm.common import BATCH_BYTES, as_row, byte_slices
from cohortbench.llm.gru import SLOTS, Network, Optimiser, Words, part_of, read_words, windows


@dataclass(frozen=True)
class Sample:
    """Bounds of the labelled texts that the network learns from: rows by label, and characters of a text."""

    toxic: int = 800
    clean: int = 1600
    chars: int = 20_000


@dataclass(frozen=True)
class Training:
    rounds: int = 4
    batch: int = 256
    seed: int = 11
    #: Windows of a text in the first round, when nothing tells them apart yet.
    first_windows: int = 12
    #: Words and n-grams in fewer texts have no embedding.
    least_texts: int = 4


@dataclass
class Scorer:
    """A network and the logit that is scored one half; without a network every text gets ``constant``."""

    net: Network | None
    middle: float = 0.0
    constant: float = 0.0

    def scores(self, data: np.ndarray, rows: np.ndarray) -> np.ndarray:
        n = len(rows) - 1
        if self.net is None:
            return np.full(n, self.constant)
        words = read_words(data, rows)
        places, row = windows(words, n)
        z = np.full(n, -np.inf)
        np.maximum.at(z, row, self.net.logits(words, places).astype(float))
        return 1 / (1 + np.exp(-np.clip(z - self.middle, -30, 30)))


def is_held_out(doc_id: Column) -> Column:
    """A fifth of the ids; their labels are not learnt. An absent id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def labelled_texts(docs: DataFrame, labels: DataFrame, sample: Sample = Sample()) -> tuple[list[bytes], np.ndarray, float]:
    """Texts and labels of the sample, and the share of toxic ones among all that may be learnt.

    The sample is the ids with the least hash, by label; texts over the bound in characters stay out of
    it. An id labelled twice is toxic if any label says so.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~is_held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    share = known.agg(F.avg("toxic")).collect()[0][0] or 0.0
    order = F.xxhash64("doc_id")
    picked = known.where("toxic = 1").orderBy(order, "doc_id").limit(sample.toxic).unionByName(
        known.where("toxic = 0").orderBy(order, "doc_id").limit(sample.clean))
    text = F.col("text").cast("string")
    short = docs.where(F.length(text) <= sample.chars).select("doc_id", text.alias("text"))
    # At most sample.toxic + sample.clean ids of a few bytes.
    rows = short.join(F.broadcast(picked), "doc_id").select("doc_id", "toxic", "text").orderBy(
        order, "doc_id", "text").limit(sample.toxic + sample.clean).collect()
    return [r["text"].encode() for r in rows], np.array([r["toxic"] for r in rows], np.float32), share


@dataclass
class Part:
    """Some consecutive texts of the sample, read."""

    words: Words
    places: np.ndarray
    row: np.ndarray  # of each window, counted over the whole sample


def _texts_by_slot(doc: np.ndarray, slot: np.ndarray) -> np.ndarray:
    """In how many texts each slot occurs."""
    pairs = np.unique(doc.astype(np.int64) * SLOTS + slot)
    return np.bincount(pairs % SLOTS, minlength=SLOTS)


def _rows(texts: np.ndarray, least: int) -> np.ndarray:
    """Slot to row, from 1, of the slots that at least ``least`` texts hold; 0 for the others."""
    rows = np.zeros(SLOTS, np.int32)
    often = np.flatnonzero(texts >= least)
    rows[often] = np.arange(1, len(often) + 1)
    return rows


def _read(texts: list[bytes], least: int) -> tuple[list[Part], Network]:
    """The sample in parts of about BATCH_BYTES, and a fresh network over its frequent words and n-grams.

    Only one part's n-grams are held in full at a time.
    """
    in_texts, gram_texts, parts = np.zeros(SLOTS, np.int64), np.zeros(SLOTS, np.int64), []
    ends = np.cumsum([len(t) for t in texts])
    first = 0
    while first < len(texts):
        end = max(first + 1, int(np.searchsorted(ends, (ends[first - 1] if first else 0) + BATCH_BYTES, "right")))
        some = texts[first:end]
        rows = np.concatenate([[0], np.cumsum([len(t) for t in some], dtype=np.int64)])
        words = read_words(np.frombuffer(b"".join(some), np.uint8), rows)
        places, row = windows(words, len(some))
        pairs = np.unique(words.row.astype(np.int64) * (len(words.slot) + 1) + words.place)
        doc, place = np.divmod(pairs, len(words.slot) + 1)
        begin = np.searchsorted(words.gram_word, place, "left")
        count = np.searchsorted(words.gram_word, place, "right") - begin
        inner = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
        in_texts += _texts_by_slot(doc, words.slot[place])
        gram_texts += _texts_by_slot(np.repeat(doc, count), words.gram_slot[np.repeat(begin, count) + inner])
        words = replace(words, gram_word=words.gram_word.astype(np.int32), gram_slot=words.gram_slot.astype(np.int32))
        parts.append(Part(words, places.astype(np.int32), row + first))
        first = end
    net = Network.fresh(_rows(in_texts, least), _rows(gram_texts, least))
    for part in parts:
        known = net.gram_rows[part.words.gram_slot] > 0
        part.words = replace(part.words, gram_word=part.words.gram_word[known], gram_slot=part.words.gram_slot[known])
    return parts, net


def _worst(net: Network, parts: list[Part], n: int) -> np.ndarray:
    """The largest logit of each text's windows."""
    z = np.full(n, -np.inf)
    for part in parts:
        np.maximum.at(z, part.row, net.logits(part.words, part.places).astype(float))
    return z


def fit(texts: list[bytes], toxic: np.ndarray, share: float, training: Training = Training()) -> Scorer:
    """A scorer; the same texts in the same order give the same one. One label only: no network."""
    if len(texts) < 10 or toxic.min() == toxic.max():
        return Scorer(None, constant=float(share))
    rng = np.random.default_rng(training.seed)
    tune = rng.permutation(len(texts)) % 5 == 0
    parts, net = _read(texts, training.least_texts)
    learner = Optimiser(net)
    balance = np.where(toxic > 0, 1.0, toxic.mean() / (1 - toxic.mean())).astype(np.float32) * 2

    def pick(part: Part, turn: int) -> tuple[np.ndarray, np.ndarray]:
        """Windows to learn, and their weights: at first some of each text, which share its weight;
        then the worst ones of each text, and for clean ones as many others."""
        row = part.row
        learn = ~tune[row]
        key = rng.random(len(row)) if turn == 0 else -net.logits(part.words, part.places)
        order = np.lexsort((key, row))
        rank = np.arange(len(row)) - np.searchsorted(row, row)
        if turn == 0:
            most = training.first_windows
            weight = balance / np.sqrt(np.clip(np.bincount(row, minlength=len(texts)), 1, most))
            return order[(rank < most) & learn[order]], weight[row].astype(np.float32)
        chosen = order[(rank < np.where(toxic[row] > 0, 1, 3)) & learn[order]]
        others = np.flatnonzero(learn & (toxic[row] == 0))
        more = rng.choice(others, min(len(others), len(chosen) // 2), replace=False)
        return np.concatenate([chosen, more]), balance[row]

    for turn in range(training.rounds):
        picked = [pick(part, turn) for part in parts]
        for _ in range(1 if turn == 0 else 2):
            for i in rng.permutation(len(parts)).tolist():
                part, (chosen, weight) = parts[i], picked[i]
                chosen = rng.permutation(chosen)
                for at in range(0, len(chosen), training.batch):
                    some = chosen[at : at + training.batch]
                    words, own = part_of(part.words, part.places[some])
                    mute = rng.random(len(words.slot)) < 0.3
                    learner.step(net.gradients(words, own, toxic[part.row[some]], weight[some], mute))
    return Scorer(net, _middle(_worst(net, parts, len(texts))[tune], toxic[tune], share))


def _middle(z: np.ndarray, toxic: np.ndarray, share: float) -> float:
    """The logit that parts the texts best by F1, with clean ones weighted as they occur."""
    if not toxic.any() or toxic.all() or not 0 < share < 1:
        return 0.0
    weight = np.where(toxic > 0, share / toxic.mean(), (1 - share) / (1 - toxic.mean()))
    order = np.argsort(-z)
    hit = np.cumsum((weight * toxic)[order])
    f1 = 2 * hit / (np.cumsum(weight[order]) + (weight * toxic).sum())
    best = np.flatnonzero(f1 >= f1.max() - 1e-9)
    low = z[order[best[-1]]]
    below = z[order[best[-1] + 1]] if best[-1] + 1 < len(z) else low - 2
    return float((low + below) / 2)


def score(docs: DataFrame, scorer: Scorer) -> DataFrame:
    """All columns of ``docs`` in __row, and score: 0 to 1, higher the likelier toxic.

    An absent or empty text is one empty window and gets the network's score of that.
    """
    packed = docs.select(as_row(docs), F.col("text").cast("string").alias("__text"))
    shape = StructType([packed.schema["__row"], StructField("score", DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [scorer.scores(data, rows) for _, _, data, rows in byte_slices(batch.column("__text"))]
            scores = np.concatenate(found) if found else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column("__row"), pa.array(scores, pa.float64())],
                                             names=["__row", "score"])

    return packed.mapInArrow(run, shape)


def toxicity(docs: DataFrame, labels: DataFrame, sample: Sample = Sample(), training: Training = Training()) -> DataFrame:
    """doc_id, held_out, score, predicted (1 from one half) of every row of ``docs``.

    Learnt from the texts alone; repeated rows score alike, up to the rounding of
    single precision. Without labels of both kinds every text gets
    the share of toxic labels. Absent and empty texts are scored as texts without words; long texts by all
    their windows. Rows without an id are scored, and not held out. Equal scores are left equal, there is no
    rank to be tied. An empty table gives an empty result.
    """
    scorer = fit(*labelled_texts(docs, labels, sample), training)
    scored = score(docs.select("doc_id", "text"), scorer)
    return scored.select(F.col("__row.doc_id").alias("doc_id"), is_held_out(F.col("__row.doc_id")).alias("held_out"),
                         "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
