"""Target-distribution importance resampling: n-grams hashed to buckets, weights from bucket counts, a noisy top share.

Words are runs of digits, letters and bytes beyond ASCII of the text with A-Z lower-cased. Everything else is
collapsed to single spaces, and an overlapped regular expression with boundary lookarounds gives the spans of
all runs of n words. Each span's bytes go to a bucket by CRC-32. Texts are scanned once; buckets with counts of
each document are written to the checkpoint folder, summed over the corpus, and met by the gain of each bucket.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import islice
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortbench.llm.common import as_row, byte_slices, columns_of, settled, text_of
from cohortbench.operators.ranking import ordered_rank


@dataclass(frozen=True)
class Resampling:
    """Runs of up to ``longest`` words; ``percent`` of the documents with at least ``min_words`` words are drawn."""

    buckets: int = 10_000
    longest: int = 1
    min_words: int = 20
    percent: int = 10
    seed: int = 2024


#: A-Z to a-z, and whatever is no word to a space.
_CLEAN = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_SPACES = re.compile(rb"  +")

#: Spans that are counted at once, so that a very long text needs no list of all its spans.
SPANS = 1 << 18


def normalised(text: bytes) -> bytes:
    """Lower-cased words with single spaces between them."""
    return _SPACES.sub(b" ", text.translate(_CLEAN)).strip(b" ")


def gram_pattern(n: int) -> regex.Pattern:
    """Runs of ``n`` words of a normalised text. Scanned overlapped, it gives one from every word's start."""
    return regex.compile(rb"(?<![^ ])[^ ]++" + rb"(?: [^ ]++)" * (n - 1) + rb"(?![^ ])")


def spans(text: bytes, pattern: regex.Pattern) -> Iterator[bytes]:
    return (m[0] for m in pattern.finditer(text, overlapped=True))


def bucket_counts(grams: Iterable[bytes], buckets: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Buckets met, how often, and the number of grams."""
    grams = iter(grams)
    total, seen = 0, None
    while part := [crc32(g) % buckets for g in islice(grams, SPANS)]:
        total += len(part)
        found = np.unique(np.array(part, np.int64), return_counts=True)
        if seen is None:
            seen = found
        else:
            where, each = np.unique(np.concatenate([seen[0], found[0]]), return_inverse=True)
            seen = where, np.bincount(each, np.concatenate([seen[1], found[1]])).astype(np.int64)
    where, count = seen if seen is not None else (np.zeros(0, np.int64), np.zeros(0, np.int64))
    return where, count, total


_COUNTED = "n_words long, n_features long, buckets array<int>, counts array<long>"


def _counter(how: Resampling):
    patterns = [gram_pattern(n) for n in range(1, how.longest + 1)]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("__text")
            for first, end, data, starts in byte_slices(column):
                words, features, where, counts, sizes = [], [], [], [], [0]
                raw = data.tobytes()
                for a, b in zip(starts.tolist(), starts.tolist()[1:], strict=False):
                    text = normalised(raw[a:b])
                    n = text.count(b" ") + 1 if text else 0
                    found = bucket_counts((g for p in patterns for g in spans(text, p)), how.buckets)
                    words.append(n)
                    features.append(found[2])
                    where.append(found[0])
                    counts.append(found[1])
                    sizes.append(sizes[-1] + len(found[0]))
                offsets = pa.array(sizes, pa.int32())
                yield pa.RecordBatch.from_arrays([
                    batch.column("__row").slice(first, end - first), pa.array(words, pa.int64()), pa.array(features, pa.int64()),
                    pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(where), pa.int32())),
                    pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(counts), pa.int64()))],
                    names=["__row", "n_words", "n_features", "buckets", "counts"])

    return count


def feature_counts(df: DataFrame, keep: Column, how: Resampling) -> DataFrame:
    """``keep`` (a struct) with n_words, n_features, and the buckets of the text's features with their counts."""
    rows = df.select(keep.alias("__row"), text_of().alias("__text"))
    return rows.mapInArrow(_counter(how), f"__row {rows.schema['__row'].dataType.simpleString()}, {_COUNTED}")


def _totaller(buckets: int):
    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(buckets, np.int64)
        for batch in batches:
            np.add.at(sums, batch.column("buckets").flatten().to_numpy(), batch.column("counts").flatten().to_numpy())
        some = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(sums[some], pa.int64())], names=["bucket", "n"])

    return total


def bucket_totals(counted: DataFrame, buckets: int) -> np.ndarray:
    """Features in each bucket: a task sends at most one row per bucket, and the driver gets as many."""
    sums = counted.select("buckets", "counts").mapInArrow(_totaller(buckets), "bucket int, n long")
    out = np.zeros(buckets, np.int64)
    for r in sums.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r.bucket] = r.n
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln of the target's share over the corpus's), both smoothed by one feature a bucket."""
    b = len(corpus)
    s, t = float(int(corpus.sum()) + b), float(int(target.sum()) + b)
    return np.array([math.floor(1000 * math.log((float(y + 1) * s) / (float(x + 1) * t)))
                     for x, y in zip(corpus.tolist(), target.tolist(), strict=True)], np.int64)


def _weigher(gain: np.ndarray):
    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            where = batch.column("buckets").flatten().to_numpy()
            n = batch.column("n_features").to_numpy()
            sums = np.concatenate([[0], np.cumsum(gain[where] * batch.column("counts").flatten().to_numpy())])
            ends = np.cumsum(pc.list_value_length(batch.column("buckets")).to_numpy())
            total = np.diff(np.concatenate([[0], sums[ends]]))
            weight = np.where(n > 0, total // np.maximum(n, 1), 0)
            yield pa.RecordBatch.from_arrays([batch.column("__row"), batch.column("n_words"), batch.column("n_features"),
                                              pa.array(weight, pa.int64())], names=["__row", "n_words", "n_features", "weight"])

    return weigh


def noise(doc_id: Column, seed: int) -> Column:
    """floor(-1000 ln(-ln u)) with u from the document's hash: a row's draw does not hang on other rows."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.ln(-F.ln((h + 0.5) / 4294967296.0))).cast("long")


def resample(docs: DataFrame, target: DataFrame, how: Resampling = Resampling(), keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep``, n_features, weight, score and rank of every row of ``docs`` (doc_id, text); ``target`` holds text.

    Of the N rows with at least ``how.min_words`` words, the floor(N * percent / 100) with the highest scores are
    drawn and ranked 1, 2, 3 ... by falling score, ties to the smaller doc_id; all others have no rank. Absent
    and empty texts have no features and weight 0; long texts are scanned whole. Rows without doc_id take part
    as with an empty one and lose ties. Repeated rows are rows of their own; equal ones get adjacent ranks in
    any order. An empty ``docs`` gives no rows; with an empty ``target`` every bucket is met by the smoothing alone.
    """
    kept = F.struct(F.col("doc_id").alias("__id"), as_row(docs.select(*keep)))
    counted = settled(feature_counts(docs, kept, how))
    totals = bucket_totals(counted, how.buckets)
    wanted = bucket_totals(feature_counts(target, F.struct(F.lit(0).alias("i")), how), how.buckets)
    kind = counted.schema["__row"].dataType.simpleString()
    weighed = counted.mapInArrow(_weigher(gains(totals, wanted)), f"__row {kind}, n_words long, n_features long, weight long")
    scored = settled(weighed.select(
        F.col("__row.__row").alias("__row"), F.col("__row.__id").alias("__id"), "n_words", "n_features", "weight",
        (F.col("weight") + noise(F.col("__row.__id"), how.seed)).alias("score")))
    eligible = F.col("n_words") >= how.min_words
    # Scores are whole numbers within some tens of thousands: a row for each, however many documents there are.
    per = scored.where(eligible).groupBy("score").agg(F.count("*").alias("n"))
    reached = F.sum("n").over(Window.orderBy(F.col("score").desc()))
    draws = scored.where(eligible).count() * how.percent // 100
    cut = per.select("score", reached.alias("reached")).where(F.col("reached") >= draws).agg(F.max("score")).first()[0]
    maybe = eligible & (F.col("score") >= (cut if draws and cut is not None else 2**63 - 1))
    ranked = ordered_rank(scored.where(maybe), [F.col("score").desc(), F.asc_nulls_last("__id")], "rank")
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= draws, F.col("rank")))
    rest = scored.where(~maybe).withColumn("rank", F.lit(None).cast("long"))
    both = ranked.unionByName(rest)
    return both.select(*columns_of(both), "n_features", "weight", "score", "rank")
