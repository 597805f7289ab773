"""Embedding whitening: centred covariance summed over tasks, leading eigenpairs, projection by broadcast.

Components become whole numbers, so that sums are exact and equal vectors are equal. The fit list holds
each distinct vector once and is written to the checkpoint folder; three passes over it sum the vectors,
the products of centred vectors, and the products of whitened ones. Each task sums its own rows, and only
rows of a matrix as wide as a vector are shuffled. The driver sees that matrix alone.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortbench.llm.common import settled
from cohortbench.llm.eigen import leading
from cohortbench.llm.vectors import common_length, finite, floored, matrix

SCALE = 64
OFFSET = 1_000_000
COMPONENTS = 16

LONGEST = 2**63 - 1


def whole_vectors(df: DataFrame, keep: tuple[str, ...] = (), scale: float = SCALE, offset: int = OFFSET) -> DataFrame:
    """``keep`` and x: floor(scale * c) + offset of the rows that take part."""
    rows = df.where(finite(F.col("embedding")))
    whole = F.transform(floored(F.col("embedding"), scale), lambda c: c.cast("long") + offset)
    return rows.select(*keep, whole.alias("x"))


def _sum_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of a task's vectors the number (place -1) and the exact sum of each component."""
    n, high, low = 0, None, None
    for batch in batches:
        x = matrix(batch.column("x"))
        if not len(x):
            continue
        n += len(x)
        # In two parts, so that no sum leaves the range of longs.
        parts = [(x >> 26).sum(0).astype(object), (x & (2**26 - 1)).sum(0).astype(object)]
        high, low = (parts[0], parts[1]) if high is None else (high + parts[0], low + parts[1])
    if n:
        totals = [n, *[(int(a) << 26) + int(b) for a, b in zip(high, low, strict=True)]]
        yield pa.RecordBatch.from_arrays([pa.array(range(-1, len(totals) - 1), pa.int32()),
                                          pa.array([Decimal(t) for t in totals], pa.decimal128(38, 0))], names=["place", "total"])


@dataclass(frozen=True)
class Centre:
    """The mean S / n as a whole number and the rest, so that centring loses no digits."""

    n: int
    sums: tuple[int, ...]

    @property
    def whole(self) -> np.ndarray:
        return np.array([round(Fraction(s, self.n)) for s in self.sums], np.int64)

    @property
    def rest(self) -> np.ndarray:
        return np.array([float(Fraction(s, self.n) - round(Fraction(s, self.n))) for s in self.sums])


def _products(rows: Callable[[np.ndarray], np.ndarray]):
    """Of each task the rows of the sum of products of ``rows(x)`` with themselves."""

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            x = matrix(batch.column("x"))
            if len(x):
                z = rows(x)
                total = z.T @ z if total is None else total + z.T @ z
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()),
                                              pa.array(list(total), pa.list_(pa.float64()))], names=["place", "row"])

    return multiply


def _add_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds up the rows of equal place, which follow each other."""
    place, total = None, None
    for batch in batches:
        rows = matrix(batch.column("row"))
        for p, row in zip(batch.column("place").to_pylist(), rows, strict=True):
            if p == place:
                total = total + row
                continue
            if total is not None:
                yield pa.RecordBatch.from_arrays([pa.array([place], pa.int32()), pa.array([total], pa.list_(pa.float64()))],
                                                 names=["place", "row"])
            place, total = p, row
    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array([place], pa.int32()), pa.array([total], pa.list_(pa.float64()))],
                                         names=["place", "row"])


def sum_of_products(fit: DataFrame, rows: Callable[[np.ndarray], np.ndarray], width: int) -> np.ndarray:
    """The sum over ``fit`` of the products of rows(x) with themselves: a task's sums, then the tasks' in their order."""
    shape = "place int, row array<double>"
    parts = fit.select("x").mapInArrow(_products(rows), shape).withColumn("task", F.spark_partition_id())
    added = parts.repartition("place").sortWithinPartitions("place", "task").select("place", "row").mapInArrow(_add_rows, shape)
    out = np.zeros((width, width))
    for r in added.collect():
        out[r.place] = r.row
    return out


@dataclass(frozen=True)
class Whitening:
    """A fitted whitening. Columns of ``vectors`` belong to ``values``, falling; ``explained`` are shares of the trace."""

    centre: Centre
    values: np.ndarray
    vectors: np.ndarray
    explained: np.ndarray
    identity_error: float

    def map(self) -> np.ndarray:
        return self.vectors / np.sqrt(self.values)[None, :]


def centred(centre: Centre) -> Callable[[np.ndarray], np.ndarray]:
    whole, rest = centre.whole, centre.rest
    return lambda x: (x - whole) - rest


def fit(df: DataFrame, components: int = COMPONENTS, scale: float = SCALE, offset: int = OFFSET) -> Whitening | None:
    """The whitening of the distinct whole vectors of ``df`` (embedding); None without any variance.

    Components whose eigenvalue is no more than the rounding of the trace are left out, as there is nothing
    to whiten; so there may be fewer than ``components``, and never more than the length of a vector.
    """
    rows = whole_vectors(df, (), scale, offset)
    length, _ = common_length(rows, "x")
    if not length:
        return None
    distinct = settled(rows.where(F.size("x") == length).distinct())
    found = distinct.mapInArrow(_sum_rows, "place int, total decimal(38,0)").groupBy("place").agg(F.sum("total").alias("total"))
    totals = {r.place: int(r.total) for r in found.collect()}
    centre = Centre(totals[-1], tuple(totals[i] for i in range(length)))
    covariance = sum_of_products(distinct, centred(centre), length) / centre.n
    covariance = (covariance + covariance.T) / 2
    trace = float(np.trace(covariance))
    values, vectors = leading(covariance, components)
    real = values > 1e-13 * length * trace
    values, vectors = values[real], vectors[:, real]
    if not len(values):
        return None
    return Whitening(centre, values, vectors, values / trace, _identity_error(distinct, centre, vectors / np.sqrt(values)[None, :]))


def _identity_error(distinct: DataFrame, centre: Centre, onto: np.ndarray) -> float:
    """The largest absolute entry of the whitened vectors' covariance minus the identity."""
    middle = centred(centre)

    def rows(x: np.ndarray) -> np.ndarray:
        return np.concatenate([middle(x) @ onto, np.ones((len(x), 1))], 1)

    k = onto.shape[1]
    sums = sum_of_products(distinct, rows, k + 1)
    mean = sums[:k, k] / centre.n
    return float(np.abs(sums[:k, :k] / centre.n - np.outer(mean, mean) - np.eye(k)).max())


def _deviations(x: np.ndarray, centre: Centre) -> list[int | None]:
    """sum((n * x - S)^2) of each row; None beyond the range of longs."""
    whole = centre.whole
    rest = [s - centre.n * int(w) for s, w in zip(centre.sums, whole, strict=True)]
    z = x - whole
    largest = centre.n * (float(np.abs(z).max(initial=0)) + 1)
    if largest * largest * x.shape[1] < 2.0**62:
        y = z * np.int64(centre.n) - np.array(rest, np.int64)
        return np.einsum("ij,ij->i", y, y).tolist()
    sums = (sum((centre.n * a - r) ** 2 for a, r in zip(row, rest, strict=True)) for row in z.tolist())
    return [s if s <= LONGEST else None for s in sums]


def _projector(model: Whitening):
    onto, middle = model.map(), centred(model.centre)
    k = len(model.values)
    shape = pa.schema([("vec_id", pa.int64()), ("component", pa.int32()), ("n", pa.int64()), ("deviation", pa.int64()),
                       ("whitened", pa.float64()), ("explained", pa.float64()), ("identity_error", pa.float64())])

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column("x"))
            if not len(x):
                continue
            m = len(x)
            each = np.repeat(np.arange(m), k)
            yield pa.RecordBatch.from_arrays([
                batch.column("vec_id").take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1), m), pa.int32()),
                pa.array(np.full(m * k, model.centre.n), pa.int64()),
                pa.array(_deviations(x, model.centre), pa.int64()).take(pa.array(each)), pa.array((middle(x) @ onto).ravel()),
                pa.array(np.tile(model.explained, m)), pa.array(np.full(m * k, model.identity_error))], schema=shape)

    return project


def whiten(df: DataFrame, components: int = COMPONENTS, scale: float = SCALE, offset: int = OFFSET) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: every vector on every leading component.

    df holds vec_id and embedding. A vector becomes x = floor(scale * c) + offset, component by component in
    doubles; components of 2**52 and more count as 2**52. Vectors that are absent, empty or hold absent or
    non-finite components take no part, nor do vectors of another length than the one most vectors have (of
    equally frequent ones the largest). Rows without vec_id and repeated rows are kept as they are; repeats
    count once in the fit. A deviation beyond the range of longs is null. Tables that are empty or hold one
    distinct vector have no components and give no rows.
    """
    shape = ("vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double")
    model = fit(df, components, scale, offset)
    if model is None:
        return df.sparkSession.createDataFrame([], shape)
    rows = whole_vectors(df, (F.col("vec_id").cast("long").alias("vec_id"),), scale, offset)
    return rows.where(F.size("x") == len(model.centre.sums)).mapInArrow(_projector(model), shape)
