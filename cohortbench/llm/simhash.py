"""SimHash near-duplicates through a Gray-order hierarchical index.

Sorted by Gray rank, neighbouring fingerprints share most bits. An index over the sorted list keeps,
per group, the bits that all its fingerprints share (a mask and their pattern), and per parent the
bits that its groups share. A search adds up the differing bits node by node and drops a whole group
as soon as the sum is over the limit.

The top of the index is the leading bits: fingerprints with the same leading bits have consecutive
Gray ranks and form a leaf table, which one task indexes. A fingerprint visits the leaf tables whose
leading bits differ from its own within the limit, and so takes along what it has already spent.
Where many fingerprints begin alike, a leaf table is split in the same way by the bits in which its
fingerprints differ most evenly.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from cohortbench.llm.common import as_row, byte_slices, columns_of, settled
from cohortbench.llm.components import components

SEED = 42
SHINGLE = 3
MAX_BITS = 2

#: Fingerprints of a leaf table on average, and children of an index node.
TABLE_ROWS = 4096
FANOUT = 16

#: A table with more than so many times TABLE_ROWS is split, by at most SPLIT_BITS bits at once.
FULL = 4
SPLIT_BITS = 8

#: Full tables of which a list (place and up to SPLIT_BITS numbers each) is broadcast; more are joined by shuffle.
BROADCAST_TABLES = 100_000

#: Pairs of a query and a node that are compared at once.
BLOCK_PAIRS = 1 << 20


def fingerprint(text: bytes) -> int:
    """Bits set in over half of the hashes of the text's word shingles; no words: zero."""
    words = text.lower().split()
    n = len(words)
    if not n:
        return 0
    line = b" ".join(words)
    if n <= SHINGLE:
        return xxhash.xxh64_intdigest(line, SEED)
    sizes = np.fromiter(map(len, words), np.int64, n)
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    digest, seed = xxhash.xxh64_intdigest, SEED
    spans = zip(starts[: n - SHINGLE + 1].tolist(), ends[SHINGLE - 1 :].tolist(), strict=True)
    h = np.array([digest(line[a:b], seed) for a, b in spans], np.uint64)
    ones = np.zeros(64, np.int64)
    for first in range(0, len(h), 1 << 14):
        part = h[first : first + (1 << 14)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of ``docs`` in __row, and fp: the fingerprint as a signed long.

    An absent text is empty, and its fingerprint zero.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in keep]).alias("__row")
    packed = docs.select(row, F.col("text").cast("string").alias("__text"))
    shape = StructType([packed.schema["__row"], StructField("fp", LongType())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for first, end, data, rows in byte_slices(batch.column("__text")):
                raw = data.tobytes()
                found += [fingerprint(raw[rows[i] : rows[i + 1]]) for i in range(end - first)]
            fp = pa.array(np.array(found, np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("__row"), fp], names=["__row", "fp"])

    return packed.mapInArrow(read, shape)


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Place of each code in the reflected Gray order."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class GrayIndex:
    """Hierarchical index over distinct 64-bit codes: levels of (mask, pattern), the root level first."""

    def __init__(self, codes: np.ndarray, fanout: int = FANOUT):
        self.order = np.argsort(gray_rank(codes), kind="stable")
        self.codes = codes[self.order]
        self.fanout = fanout
        every, some = self.codes, self.codes
        levels = []
        while len(every) > 1:
            cut = np.arange(0, len(every), fanout)
            every, some = np.bitwise_and.reduceat(every, cut), np.bitwise_or.reduceat(some, cut)
            # Bits in which all members agree: all ones or all zeros.
            levels.append((~(every ^ some), every, cut))
        self.levels = levels[::-1]

    def within(self, queries: np.ndarray, limit: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query, code) places at most ``limit`` bits apart, in blocks."""
        step = max(1, BLOCK_PAIRS // max(1, len(self.codes)))
        for first in range(0, len(queries), step):
            q = np.arange(first, min(len(queries), first + step))
            node = np.zeros(len(q), np.int64)
            spent, known = np.zeros(len(q), np.int64), np.zeros(len(q), np.uint64)
            for depth, (mask, pattern, _) in enumerate(self.levels):
                if depth:  # to the children of the nodes that are left
                    q, node, spent, known = self._children(q, node, spent, known, len(mask))
                fresh = mask[node] & ~known
                spent = spent + np.bitwise_count((queries[q] ^ pattern[node]) & fresh)
                left = spent <= limit
                q, node, spent, known = q[left], node[left], spent[left], known[left] | fresh[left]
            if self.levels:
                q, node, spent, known = self._children(q, node, spent, known, len(self.codes))
            left = spent + np.bitwise_count((queries[q] ^ self.codes[node]) & ~known) <= limit
            yield q[left], self.order[node[left]]

    def _children(self, q, node, spent, known, size):
        first = node * self.fanout
        count = np.minimum(first + self.fanout, size) - first
        again = np.repeat(np.arange(len(q)), count)
        inner = np.arange(len(again)) - np.repeat(np.cumsum(count) - count, count)
        return q[again], first[again] + inner, spent[again], known[again]


class Forest:
    """Union-find over places; joins whole arrays of pairs and keeps the smallest place as root."""

    def __init__(self, size: int):
        self.root = np.arange(size)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            ra, rb = self.root[a], self.root[b]
            apart = ra != rb
            if not apart.any():
                return
            a, b = a[apart], b[apart]
            high, low = np.maximum(ra, rb)[apart], np.minimum(ra, rb)[apart]
            np.minimum.at(self.root, high, low)
            while (self.root[self.root] != self.root).any():
                self.root = self.root[self.root]


def _links(limit: int):
    """Reads the rows of leaf tables, each table's own fingerprints before its visitors.

    A task holds one table's own fingerprints and one batch of visitors.
    """

    def linked(index: GrayIndex, home: np.ndarray, others: np.ndarray) -> pa.RecordBatch:
        """One link for each fingerprint that is not the root of those it is linked with."""
        codes = np.concatenate([home, others])
        forest = Forest(len(codes))
        for q, c in index.within(codes[len(home) :] if len(others) else home, limit):
            forest.join(q + len(home) if len(others) else q, c)
        moved = np.flatnonzero(forest.root != np.arange(len(codes)))
        return pa.RecordBatch.from_arrays(
            [pa.array(codes[moved].view(np.int64)), pa.array(codes[forest.root[moved]].view(np.int64))],
            names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, parts, home, index = None, [], None, None
        nobody = np.zeros(0, np.uint64)
        for batch in batches:
            place = batch.column("place").to_numpy()
            fp = batch.column("fp").to_numpy().view(np.uint64)
            visits = batch.column("visits").to_numpy(zero_copy_only=False).astype(bool)
            cuts = np.flatnonzero((place[1:] != place[:-1]) | (visits[1:] != visits[:-1])) + 1
            cuts = [0, *cuts.tolist(), len(place)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                if a == b:
                    continue
                if place[a] != table:
                    if parts:
                        home = np.concatenate(parts)
                        yield linked(GrayIndex(home), home, nobody)
                    table, parts, index = place[a], [], None
                if not visits[a]:
                    parts.append(fp[a:b])
                    continue
                if parts:
                    home = np.concatenate(parts)
                    index, parts = GrayIndex(home), []
                    yield linked(index, home, nobody)
                if index is not None:
                    yield linked(index, home, fp[a:b])
        if parts:
            home = np.concatenate(parts)
            yield linked(GrayIndex(home), home, nobody)

    return run


def leading_bits(fp: Column, bits: int) -> Column:
    return F.shiftrightunsigned(fp, 64 - bits) if bits else F.lit(0).cast("long")


def _visits(codes: DataFrame, bits: int, limit: int) -> DataFrame:
    """place, visits, spent, fp: each fingerprint in the table of its leading bits, and as a visitor in others.

    Of two tables only the one with the smaller leading bits sends visitors; spent counts the bits in
    which a visitor differs from all of the table.
    """
    own = leading_bits(F.col("fp"), bits)
    flips = F.array(*[F.struct(F.lit(m).cast("long").alias("mask"), F.lit(m.bit_count()).alias("size"))
                      for m in _masks(bits, limit)])
    sent = codes.select("fp", own.alias("own"), F.explode(flips).alias("flip"))
    place = F.col("own").bitwiseXOR(F.col("flip.mask"))
    return sent.where(place >= F.col("own")).select(
        place.alias("place"), (F.col("flip.size") > 0).alias("visits"), F.col("flip.size").alias("spent"), "fp")


def _masks(bits: int, limit: int) -> list[int]:
    """All masks of at most ``limit`` of the lowest ``bits`` bits, zero first."""
    return [sum(1 << i for i in chosen) for n in range(limit + 1) for chosen in combinations(range(bits), n)]


def _full_tables(homes: DataFrame, table_rows: int) -> DataFrame:
    """place, cuts: the tables of ``homes`` (place, fp) that are too full, and the bits to split each by.

    Those are its most even bits. Bits that the whole table shares can't split it, so that the leading
    bits, and those of earlier splits, don't come again. All are counted in one aggregate, in which a
    table is one row a task before it is shuffled, however full.
    """
    ones = [F.sum(F.shiftrightunsigned("fp", i).bitwiseAND(1)) for i in range(64)]
    counted = homes.groupBy("place").agg(F.count("*").alias("n"), F.array(*ones).alias("ones"))
    skews = F.transform("ones", lambda c, i: F.struct(F.abs(2 * c - F.col("n")).alias("skew"), i.alias("bit")))
    wanted = F.least(F.ceil(F.log2(F.col("n") / table_rows)), F.lit(SPLIT_BITS)).cast("int")
    even = F.slice(F.array_sort(F.filter(skews, lambda b: b["skew"] < F.col("n"))), F.lit(1), wanted)
    full = counted.where(F.col("n") > FULL * table_rows).select(
        "place", F.transform(even, lambda b: b["bit"]).alias("cuts"))
    return full.where(F.size("cuts") > 0)


def _split(rows: DataFrame, full: DataFrame, small: bool, limit: int) -> DataFrame:
    """``rows`` (place, visits, spent, fp) with each full table dealt to smaller ones by its cuts.

    As with leading bits, a table's own fingerprints visit the later ones of its parts, and its visitors
    all those within the bits they have left. A part is named by a hash: if two had the same
    name they would be one table, whose links are the same, since all are compared in whole fingerprints.
    """
    met = rows.join(F.broadcast(full) if small else full, "place", "left")
    sub = F.expr("aggregate(cuts, 0L, (acc, b) -> acc * 2 + (shiftrightunsigned(fp, b) & 1))")
    met = met.withColumn("sub", sub)
    flips = F.array(*[F.struct(F.lit(m).cast("long").alias("mask"), F.lit(m.bit_count()).alias("size"))
                      for m in _masks(SPLIT_BITS, limit)])
    fits = F.filter(flips, lambda m: (m["mask"] < F.expr("shiftleft(1L, size(cuts))"))
                    & (m["size"] + F.col("spent") <= limit)
                    & (F.col("visits") | (F.col("sub").bitwiseXOR(m["mask"]) >= F.col("sub"))))
    stay = F.slice(flips, 1, 1)
    met = met.withColumn("flip", F.explode(F.when(F.col("cuts").isNull(), stay).otherwise(fits)))
    part = F.xxhash64("place", F.col("sub").bitwiseXOR(F.col("flip.mask")))
    return met.select(
        F.when(F.col("cuts").isNull(), F.col("place")).otherwise(part).alias("place"),
        (F.col("visits") | (F.col("flip.size") > 0)).alias("visits"),
        (F.col("spent") + F.col("flip.size")).alias("spent"), "fp")


def leaf_tables(codes: DataFrame, limit: int = MAX_BITS, table_rows: int = TABLE_ROWS) -> tuple[DataFrame, int]:
    """(place, visits, spent, fp) of all leaf tables of the distinct fingerprints ``codes`` (fp), and how many
    tables there are at least.

    The number of leading bits follows the number of fingerprints. Tables that are too full all the
    same, since many fingerprints begin alike, are split until none is. Limits over two bits are an error.
    """
    if limit > 2:
        raise ValueError("visitors are sent for at most two differing leading bits")
    n = codes.count()
    bits = min(40, max(0, math.ceil(math.log2(max(1, n) / table_rows))))
    rows, tables = _visits(codes, bits, limit), 1 << bits
    homes = _visits(codes, bits, 0)
    while True:
        full = settled(_full_tables(homes, table_rows))
        found = full.count()
        if not found:
            return rows, tables
        tables = max(tables, n // table_rows)
        small = found <= BROADCAST_TABLES
        # Without visitors, own fingerprints go to their own part alone.
        homes = _split(homes, full, small, 0)
        rows = _split(rows, full, small, limit)


def linked_pairs(codes: DataFrame, limit: int = MAX_BITS, table_rows: int = TABLE_ROWS) -> DataFrame:
    """a, b: links between the distinct fingerprints ``codes`` (fp) that join all those linked.

    Every pair within ``limit`` bits is found in some leaf table; each table emits no more than one
    link a fingerprint, which joins the same ones.
    """
    every, tables = leaf_tables(codes, limit, table_rows)
    parts = max(1, min(tables, int(codes.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    every = every.select("place", "visits", "fp")
    dealt = every.repartitionById(parts, F.pmod("place", F.lit(parts)).cast("int")) if tables > 1 else every.coalesce(1)
    return dealt.sortWithinPartitions("place", "visits").mapInArrow(_links(limit), "a long, b long")


def near_duplicates(prints: DataFrame, limit: int = MAX_BITS) -> DataFrame:
    """fp, root for every distinct fingerprint of ``prints`` (fp): a name of its component."""
    codes = settled(prints.select("fp").distinct())
    found = components(linked_pairs(codes, limit))
    return codes.join(found.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"))


def document_components(docs: DataFrame, limit: int = MAX_BITS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id of every row of ``docs``.

    component_id is the smallest doc_id of the component, null if it has none. Repeated rows and ids
    each keep their row. An empty table gives an empty result.
    """
    prints = fingerprints(docs, ["doc_id"])
    prints = settled(prints.select(F.col("__row.doc_id").alias("doc_id"), "fp"))
    least = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = near_duplicates(prints, limit)
    named = roots.join(least, "fp")
    names = named.groupBy("root").agg(F.min("least").alias("component_id"))
    by_print = named.join(names, "root").select("fp", "component_id")
    return prints.join(by_print, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def first_of_each(docs: DataFrame, limit: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs``, one of each component: the smallest doc_id, null last.

    Of rows with the same id and text one stays; of texts under the same id, that of the least hash.
    Only ids, hashes and fingerprints are written and searched; the rows themselves are moved once.
    """
    text = F.col("text").cast("string")
    hashes = [F.xxhash64("doc_id", text).alias("__h1"), F.xxhash64(text, F.lit(1), "doc_id").alias("__h2")]
    keyed = fingerprints(docs.select("doc_id", "text", *hashes), ["doc_id", "__h1", "__h2"])
    rows = settled(keyed.groupBy("fp").agg(F.min(F.struct(
        F.col("__row.doc_id").isNull().alias("absent"), F.col("__row.doc_id").alias("doc_id"),
        F.col("__row.__h1").alias("__h1"), F.col("__row.__h2").alias("__h2"))).alias("first")))
    first = near_duplicates(rows, limit).join(rows, "fp").groupBy("root").agg(F.min("first").alias("first"))
    kept = docs.select(as_row(docs), *hashes).join(first.select("first.__h1", "first.__h2"), ["__h1", "__h2"], "left_semi")
    same = Window.partitionBy("__h1", "__h2").orderBy("__h1")
    kept = kept.withColumn("__n", F.row_number().over(same)).where("__n = 1")
    return kept.select(*columns_of(kept))
