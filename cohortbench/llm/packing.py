"""Packing into optimal length buckets.

Sequences are padded to their bucket's bound. The bounds come from a dynamic programme over the global
histogram of lengths and make the total padding as small as that many buckets allow. Inside a bucket,
batches are filled up to a token budget.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortbench.llm.common import byte_slices, global_rank, placed_rank, settled

MAX_LENGTH = 2048
BUCKETS = 8
BUDGET = 65_536

_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def _cutter(max_length: int, with_text: bool, keep: Sequence[str]):
    room = max_length - 1

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [batch.column(c) for c in keep]
            for first, end, data, rows in byte_slices(batch.column("text")):
                raw, out = data.tobytes(), []
                for i in range(first, end):
                    text = raw[rows[i - first] : rows[i - first + 1]]
                    n = len(text.split())
                    if n <= room or not with_text:
                        out += [(i, k, min(room, n - k * room) + 1, text) for k in range(max(1, -(-n // room)))]
                    else:
                        cuts = [m.start() for j, m in enumerate(_WORD.finditer(text)) if j and not j % room]
                        for k, (a, b) in enumerate(zip([0, *cuts], [*cuts, len(text)], strict=True)):
                            out.append((i, k, min(room, n - k * room) + 1, text[a:b]))
                take, chunk, length, texts = zip(*out, strict=True)
                columns = [c.take(pa.array(take)) for c in kept]
                columns += [pa.array(chunk, pa.int64()), pa.array(length, pa.int64())]
                if with_text:
                    columns.append(pa.array(texts, pa.binary()).cast(pa.string()))
                names = [*keep, "chunk", "length", "text"][: len(columns)]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return cut


def sequences(docs: DataFrame, max_length: int = MAX_LENGTH, with_text: bool = False,
              keep: Sequence[str] = ()) -> DataFrame:
    """doc_id[, keep], chunk, length[, text]: texts cut into sequences of at most ``max_length`` tokens.

    A token is a word or the end mark that closes each sequence, so an empty or absent text is one
    sequence of length 1. Cuts lie before a word; the texts of the chunks joined are the whole text.
    """
    keep = ["doc_id", *keep]
    kinds = ", ".join(f"{c} {docs.schema[c].dataType.simpleString()}" for c in keep)
    shape = f"{kinds}, chunk long, length long" + ", text string" * with_text
    return docs.select(*keep, F.col("text").cast("string").alias("text")).mapInArrow(
        _cutter(max_length, with_text, keep), shape)


def optimal_bounds(histogram: dict[int, int], buckets: int) -> list[int]:
    """Bucket bounds, ascending, the last the largest length, that minimise the total padding.

    Exact: for each number of buckets and each bound, the best last bucket. No lengths: no bounds.
    Of equally good choices the one with smaller bounds.
    """
    lengths = np.array(sorted(histogram), np.int64)
    n = len(lengths)
    if not n:
        return []
    counts = np.concatenate([[0], np.cumsum([histogram[x] for x in lengths.tolist()], dtype=np.int64)])
    # Padding is bound times rows minus tokens, and the tokens are the same for any bounds.
    cost, back = lengths * counts[1:], []
    for _ in range(min(buckets, n) - 1):
        new, cut = cost.copy(), np.full(n, -1)
        for j in range(1, n):
            over = cost[:j] + lengths[j] * (counts[j + 1] - counts[1 : j + 1])
            i = int(np.argmin(over))
            if over[i] < new[j]:
                new[j], cut[j] = over[i], i
        cost = new
        back.append(cut)
    bounds, j = [int(lengths[-1])], n - 1
    for cut in reversed(back):
        if cut[j] >= 0:
            j = int(cut[j])
            bounds.append(int(lengths[j]))
    return bounds[::-1]


def pack(docs: DataFrame, max_length: int = MAX_LENGTH, buckets: int = BUCKETS, budget: int = BUDGET,
         with_text: bool = False, placed: tuple[str, str] | None = None) -> DataFrame:
    """doc_id, chunk, length, bucket, bound, padding, batch, slot[, text] of every sequence.

    bucket counts from 0 by bound; a batch of a bucket holds budget // bound sequences, and only the
    last one fewer. The histogram that reaches the driver has at most max_length rows. Rows repeated
    in ``docs`` are sequences of their own; an empty table gives an empty result. Batches of a bucket are
    filled in a hashed order, or in the order of ``placed``: the two long columns of ``docs`` that say
    where a row lies (``common.with_place``), the chunks of a text one after the other.
    """
    if not 1 < max_length <= budget:
        raise ValueError("max_length must be over 1 and within the budget")
    rows = settled(sequences(docs, max_length, keep=placed or ()))
    histogram = {r["length"]: r["n"] for r in rows.groupBy("length").agg(F.count("*").alias("n")).collect()}
    bounds = optimal_bounds(histogram, buckets)
    if with_text:
        rows = sequences(docs, max_length, True, placed or ())
    known = F.array(*[F.lit(b) for b in bounds]).cast("array<long>")
    rows = rows.withColumn("bucket", F.size(F.filter(known, lambda b: b < F.col("length"))))
    rows = rows.withColumn("bound", F.get(known, F.col("bucket")))
    order = ["doc_id", "chunk"]
    if placed:
        ranked = placed_rank(rows, ["bucket"], *placed, [*order[1:], order[0]], "rank")
    else:
        ranked = global_rank(rows, ["bucket"], order, "rank", rows=sum(histogram.values()))
    per_batch = F.lit(budget).cast("long") / F.col("bound")
    per_batch = F.floor(per_batch).cast("long")
    return ranked.select(
        "doc_id", "chunk", "length", "bucket", "bound", (F.col("bound") - F.col("length")).alias("padding"),
        F.floor(F.col("rank") / per_batch).cast("long").alias("batch"), (F.col("rank") % per_batch).alias("slot"),
        *["text"] * with_text)
