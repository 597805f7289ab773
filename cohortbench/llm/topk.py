"""Exact top-k search by integer inner product: M-trees over the cells of a metric partition.

A bounded sample gives pivots. Every vector goes to its nearest pivot, and a pivot with more vectors than
a task should hold is dealt to several cells by a hash of the id: a cell is a page of the upper level and
one M-tree. Each query brings the least score that can still matter (its k-th best in the sample) and
visits the cells whose pivot's covering radius lets them reach it. Cells are held by tasks one at a time,
and queries stream past.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortbench.llm.common import settled
from cohortbench.llm.mtree import Tree
from cohortbench.llm.vectors import common_length, finite, floored, matrix

#: Vectors of a cell on average, and pivots and rows of the sample at most.
CELL_ROWS = 8_192
PIVOTS = 256
SAMPLE = 1_024
SCALE = 1_024
NEAREST = 10

#: Components beyond this (scores past the range of longs) count as this.
LARGEST = 2.0**200


def _assigner(pivots: np.ndarray):
    shape = pa.schema([("vec_id", pa.int64()), ("vector", pa.list_(pa.float64())), ("pivot", pa.int32()),
                       ("far", pa.float64()), ("norm", pa.float64())])
    squares = np.einsum("ij,ij->i", pivots, pivots)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = matrix(batch.column("vector"))
            if not len(rows):
                continue
            own = np.einsum("ij,ij->i", rows, rows)
            d = own[:, None] + squares[None, :] - 2 * (rows @ pivots.T)
            pivot = d.argmin(1)
            far = np.sqrt(((rows - pivots[pivot]) ** 2).sum(1))
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("vector").cast(pa.list_(pa.float64())), pa.array(pivot, pa.int32()),
                 pa.array(far), pa.array(np.sqrt(own))], schema=shape)

    return assign, "vec_id long, vector array<double>, pivot int, far double, norm double"


def _router(pivots: np.ndarray, radii: np.ndarray, norms: np.ndarray, sample_ids: np.ndarray, sample: np.ndarray, k: int):
    """For each query the least score that matters, and the pivots whose vectors may reach it."""
    shape = pa.schema([("vec_id", pa.int64()), ("vector", pa.list_(pa.float64())), ("least", pa.float64()),
                       ("pivots", pa.list_(pa.int32()))])

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, asked = batch.column("vec_id").to_numpy(), matrix(batch.column("vector"))
            if not len(asked):
                continue
            square = np.einsum("ij,ij->i", asked, asked)
            norm = np.sqrt(square)
            room = 1e-11 * (square[:, None] + (norms * norms)[None, :] + 1)
            products = asked @ pivots.T
            d = np.sqrt(np.maximum(0, square[:, None] + np.einsum("ij,ij->i", pivots, pivots)[None, :] - 2 * products))
            gap = np.maximum(0, d - radii[None, :])
            reach = np.minimum(products + norm[:, None] * radii[None, :],
                               (square[:, None] + (norms * norms)[None, :] - gap * gap) / 2) + room
            scores = asked @ sample.T
            scores[ids[:, None] == sample_ids[None, :]] = -np.inf
            least = np.full(len(ids), -np.inf)
            if len(sample) >= k:
                # A sampled id has one vector; k of them other than the query's own bound the k-th best from below.
                least = np.partition(scores, len(sample) - k, axis=1)[:, len(sample) - k]
                least = least - 1e-11 * (np.abs(least) + square + 1)
                least[~np.isfinite(least)] = -np.inf
            # Scores are cut at the range of longs.
            least = np.minimum(least, 2.0**62)
            chosen = [np.flatnonzero(row).astype(np.int32) for row in reach >= least[:, None]]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("vector").cast(pa.list_(pa.float64())), pa.array(least),
                 pa.array(chosen, pa.list_(pa.int32()))], schema=shape)

    return route, "vec_id long, vector array<double>, least double, pivots array<int>"


def _searcher(k: int):
    shape = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Cell after cell: its vectors come first and make a tree, then its queries."""
        cell, ids, vectors, tree = None, [], [], None
        for batch in batches:
            cells = batch.column("cell").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(cells)) + 1).tolist(), len(cells)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                if a == b:
                    continue
                if cells[a] != cell:
                    cell, ids, vectors, tree = cells[a], [], [], None
                part = batch.slice(a, b - a)
                asks = part.column("is_query").to_numpy(zero_copy_only=False).astype(bool)
                own, rows = part.column("vec_id").to_numpy(), matrix(part.column("vector"))
                if not asks.all():
                    ids.append(own[~asks])
                    vectors.append(rows[~asks])
                if not asks.any() or tree is None and not ids:
                    continue
                if tree is None:
                    tree = Tree(np.concatenate(ids), np.concatenate(vectors))
                    ids, vectors = [], []
                least = part.column("least").to_numpy(zero_copy_only=False)
                found = [(q, i, s) for q, asked, floor in zip(own[asks].tolist(), rows[asks], least[asks].tolist(), strict=True)
                         for s, i in tree.search(asked, k, q, floor)]
                q, i, s = zip(*found, strict=True) if found else ((), (), ())
                yield pa.RecordBatch.from_arrays([pa.array(q, pa.int64()), pa.array(i, pa.int64()), pa.array(s, pa.int64())],
                                                 schema=shape)

    return search, "query_id long, vec_id long, score long"


def whole_vectors(df: DataFrame, scale: float = SCALE) -> DataFrame:
    """vec_id, vector: floor(scale * x) of the rows that take part."""
    rows = df.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("vector"))
    return rows.where(F.col("vec_id").isNotNull() & finite(F.col("vector"))).select(
        "vec_id", floored(F.col("vector"), scale, LARGEST).alias("vector"))


def top_k(base: DataFrame, queries: DataFrame, k: int = NEAREST, scale: float = SCALE, cell_rows: int = CELL_ROWS,
          sample_rows: int = SAMPLE) -> DataFrame:
    """query_id, rank, vec_id, score: of each query the ``k`` rows of ``base`` with the largest inner product of whole vectors.

    Both tables hold vec_id and embedding; a vector's components are floor(scale * x) in doubles. Exact: scores
    are sums of whole numbers, and a page is left out only if no vector in it can reach the k-th best score.
    Vectors that are absent, empty or hold absent or non-finite components take no part, nor do rows without
    vec_id, nor vectors of another length than the one most vectors have (of equally frequent lengths the
    largest). Zero vectors take part. A query's own vec_id is not an answer. Ties go to the smaller vec_id. Rows
    repeated in id and vector count once; an id with several vectors answers with its best one and asks with
    its least one. Scores beyond the range of longs count as its end. Empty tables give no answers; with fewer
    candidates than ``k`` all are given.
    """
    rows = whole_vectors(base, scale)
    length, n = common_length(rows)
    # Repeats of one row would all go to one cell.
    rows = settled(rows.where(F.size("vector") == length).distinct())
    asked = whole_vectors(queries, scale).where(F.size("vector") == length)
    asked = asked.groupBy("vec_id").agg(F.min("vector").alias("vector"))
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id", "vector").limit(sample_rows).toArrow().combine_chunks()
    sample_ids, vectors = sample["vec_id"].to_numpy(), np.zeros((0, length))
    if len(sample_ids):
        vectors = matrix(sample["vector"].combine_chunks())
    sample_ids, first = np.unique(sample_ids, return_index=True)
    # In the order of the hash, so that the first ones are drawn from all ids.
    distinct = np.unique(vectors, axis=0, return_index=True)[1]
    pivots = vectors[np.sort(distinct)[: max(1, min(PIVOTS, math.ceil(n / cell_rows)))]]
    if not len(pivots):
        pivots = np.zeros((1, length))
    assign, shape = _assigner(pivots)
    dealt = rows.mapInArrow(assign, shape)
    stats = {r.pivot: r for r in dealt.groupBy("pivot").agg(
        F.count("*").alias("n"), F.max("far").alias("far"), F.max("norm").alias("norm")).collect()}
    used = sorted(stats)
    cells, first_cell = [], 0
    for p in used:
        salts = math.ceil(stats[p].n / cell_rows)
        cells.append((p, first_cell, salts))
        first_cell += salts
    # At most PIVOTS rows.
    layout = F.broadcast(base.sparkSession.createDataFrame(cells, "pivot int, first int, salts int"))
    hair = 1 + 1e-12
    route, shape = _router(pivots[used], np.array([stats[p].far * hair for p in used]),
                           np.array([stats[p].norm * hair for p in used]), sample_ids, vectors[first], k)
    seen = asked.mapInArrow(route, shape).select("vec_id", "vector", "least", F.explode("pivots").alias("i"))
    numbered = F.broadcast(base.sparkSession.createDataFrame(
        [(i, *c) for i, c in enumerate(cells)], "i int, pivot int, first int, salts int"))
    visits = seen.join(numbered, "i").select(
        F.explode(F.sequence(F.col("first"), F.col("first") + F.col("salts") - 1)).alias("cell"),
        F.lit(True).alias("is_query"), "vec_id", "vector", "least")
    held = dealt.join(layout, "pivot").select(
        (F.col("first") + F.pmod(F.xxhash64("vec_id"), F.col("salts"))).cast("int").alias("cell"),
        F.lit(False).alias("is_query"), "vec_id", "vector", F.lit(None).cast("double").alias("least"))
    ordered = held.unionByName(visits).repartitionById(max(1, first_cell), F.col("cell")).sortWithinPartitions(
        "cell", "is_query", "vec_id")
    search, shape = _searcher(k)
    found = ordered.mapInArrow(search, shape).groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
