"""Approximate nearest neighbours by inner product: a pruned graph per shard, searched by beam.

Vectors are dealt to shards of a bounded number of rows. A task builds its shard's graph once and then
streams the queries past it, so it holds one shard and one batch of queries; every query visits every
shard, and the shards' answers are ranked together.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortbench.llm.graph import SEARCH_BEAM, Graph

#: Vectors of a shard on average. More make the search of all shards cheaper, a task longer.
SHARD_ROWS = 10_000
NEAREST = 20


def usable(vector: Column) -> Column:
    """Whether a vector is there, without absent or non-finite components, and not zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _columns(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    vectors = batch.column("vector")
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    return (batch.column("is_query").to_numpy(zero_copy_only=False).astype(bool), batch.column("vec_id").to_numpy(),
            flat.reshape(len(vectors), -1))


#: Largest norm of a band over its smallest: wide bands cost recall, and very wide ones the digits of float32 distances.
BAND = 2


def bands(vectors: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(rows, these vectors with the largest norm scaled to 1) by bands of norm, the largest norms first."""
    top = np.abs(vectors).max(1)
    unit = vectors / top[:, None]
    norm = np.sqrt(np.einsum("ij,ij->i", unit, unit))
    size = np.log2(top) + np.log2(norm)
    order = np.argsort(-size, kind="stable")
    size, out, at = size[order], [], 0
    while at < len(order):
        end = int(np.searchsorted(-size, math.log2(BAND) - size[at], "right"))
        rows = np.sort(order[at:end])
        largest = order[at]
        out.append((rows, unit[rows] * (top[rows] / top[largest])[:, None] / norm[largest]))
        at = end
    return out


class Shard:
    """Vectors with their ids; equal vectors are one point, whose ids are kept sorted.

    Points are split by bands of norm, each with a graph of its own, as one large vector would leave no
    digits to the distances of the others. Bands that fit a beam need no graph: all their points are tried.
    """

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.vectors, which = np.unique(vectors + 0.0, axis=0, return_inverse=True)
        order = np.lexsort((ids, which.ravel()))
        self.ids, which = ids[order], which.ravel()[order]
        self.first = np.searchsorted(which, np.arange(len(self.vectors) + 1))
        # Largest inner product becomes least distance once all points are lifted to the same norm.
        self.graphs, few = [], [np.zeros(0, np.int64)]
        for rows, points in bands(self.vectors):
            if len(rows) <= SEARCH_BEAM:
                few.append(rows)
                continue
            lift = np.sqrt(np.maximum(0, 1 - np.einsum("ij,ij->i", points, points)))
            self.graphs.append((rows, Graph(np.concatenate([points, lift[:, None]], 1).astype(np.float32))))
        self.few = np.concatenate(few)

    def nearest(self, ids: np.ndarray, queries: np.ndarray, k: int, beam: int) -> Iterator[tuple[int, int, float]]:
        """(query id, id, inner product) of the best k of each query, its own id left out."""
        asked = queries / np.abs(queries).max(1, keepdims=True)
        asked = np.concatenate([asked / np.linalg.norm(asked, axis=1)[:, None], np.zeros((len(queries), 1))], 1)
        asked = asked.astype(np.float32)
        found = [(rows, graph.search(asked, max(beam, 2 * k))[0]) for rows, graph in self.graphs]
        for i, (q, query) in enumerate(zip(ids.tolist(), queries, strict=True)):
            points = np.concatenate([self.few, *(rows[near[i][near[i] >= 0]] for rows, near in found)])
            scores = np.einsum("ij,j->i", self.vectors[points], query)
            least = self.ids[self.first[points]]
            best: dict[int, float] = {}
            for i in np.lexsort((least, -scores))[: k + 1].tolist():
                a = self.first[points[i]]
                b = min(self.first[points[i] + 1], a + k + 1)
                for own in self.ids[a:b].tolist():
                    if own != q and own not in best:
                        best[own] = float(scores[i])
            ranked = sorted(best.items(), key=lambda x: (-x[1], x[0]))[:k]
            yield from ((q, own, score) for own, score in ranked)


def _searcher(k: int, beam: int):
    shape = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One shard: its vectors come first, then the queries."""
        ids, vectors, shard = [], [], None
        for batch in batches:
            is_query, own, rows = _columns(batch)
            if not is_query.all():
                ids.append(own[~is_query])
                vectors.append(rows[~is_query])
            if is_query.any() and ids:
                if shard is None:
                    shard = Shard(np.concatenate(ids), np.concatenate(vectors))
                found = list(shard.nearest(own[is_query], rows[is_query], k, beam))
                q, v, s = zip(*found, strict=True) if found else ((), (), ())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(q, pa.int64()), pa.array(v, pa.int64()), pa.array(s, pa.float64())], schema=shape)

    return search


def nearest(base: DataFrame, queries: DataFrame, k: int = NEAREST, shard_rows: int = SHARD_ROWS,
            beam: int = SEARCH_BEAM) -> DataFrame:
    """query_id, rank, vec_id, score: of each query the ``k`` rows of ``base`` with the largest inner product.

    Both tables hold vec_id and embedding. Vectors that are absent, zero, or hold absent or non-finite
    components take no part, nor do rows without vec_id, nor vectors of another length than the one
    most vectors have (of equally frequent lengths the largest). A query's own vec_id is not an answer.
    Ties go to the smaller vec_id. Rows repeated in id and vector count once, an id with several
    vectors answers with its best one and asks with its least one. Empty tables give no answers.
    """
    vector = F.col("embedding").cast("array<double>").alias("vector")
    rows = base.select(F.col("vec_id").cast("long").alias("vec_id"), vector).where(
        F.col("vec_id").isNotNull() & usable(F.col("vector")))
    lengths = rows.groupBy(F.size("vector").alias("length")).agg(F.count("*").alias("n"))
    most = lengths.orderBy(F.col("n").desc(), F.col("length").desc()).limit(1).collect()
    length, n = (most[0]["length"], most[0]["n"]) if most else (0, 0)
    shards = max(1, math.ceil(n / shard_rows))
    # Repeats of one row would all go to one shard.
    rows = rows.where(F.size("vector") == length).distinct()
    asked = queries.select(F.col("vec_id").cast("long").alias("vec_id"), vector).where(
        F.col("vec_id").isNotNull() & usable(F.col("vector")) & (F.size("vector") == length))
    asked = asked.groupBy("vec_id").agg(F.min("vector").alias("vector"))
    own = F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))
    dealt = rows.select(own.alias("shard"), F.lit(False).alias("is_query"), "vec_id", "vector").unionByName(
        asked.select(every.alias("shard"), F.lit(True).alias("is_query"), "vec_id", "vector"))
    ordered = dealt.repartitionById(shards, F.col("shard")).sortWithinPartitions("is_query", "vec_id")
    found = ordered.mapInArrow(_searcher(k, beam), "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
