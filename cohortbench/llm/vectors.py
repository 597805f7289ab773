"""Vectors of whole numbers: which rows hold one, and batches of them as matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Doubles from here on are whole numbers.
WHOLE = 2.0**52


def finite(vector: Column) -> Column:
    """Whether a vector is there, without absent or non-finite components, and not empty."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(fine & (F.size(vector) > 0), F.lit(False))


def floored(vector: Column, scale: float, most: float = WHOLE) -> Column:
    """floor(scale * x) of each component, as doubles, kept within ``most`` either way."""

    def whole(x: Column) -> Column:
        value = F.greatest(F.least(F.lit(float(scale)) * x.cast("double"), F.lit(most)), F.lit(-most))
        return F.when(F.abs(value) < WHOLE, F.floor(value).cast("double")).otherwise(value)

    return F.transform(vector, whole)


def common_length(rows: DataFrame, vector: str = "vector") -> tuple[int, int]:
    """The length that most vectors have (of equally frequent ones the largest) and their number; 0, 0 if there are none."""
    lengths = rows.groupBy(F.size(vector).alias("length")).agg(F.count("*").alias("n"))
    most = lengths.orderBy(F.col("n").desc(), F.col("length").desc()).limit(1).collect()
    return (most[0]["length"], most[0]["n"]) if most else (0, 0)


def matrix(column: pa.Array) -> np.ndarray:
    """One row per vector; all have the same length."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)
