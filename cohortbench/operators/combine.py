"""Putting metric models with a common key side by side."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortbench.sinks.exports import write_bucketed


def key_spine(frames: list[DataFrame], keys: list[str]) -> DataFrame:
    """Every key that occurs in any frame, once."""
    return reduce(DataFrame.union, [f.select(*keys) for f in frames]).distinct()


def join_on_spine(frames: list[DataFrame], keys: list[str]) -> DataFrame:
    """Spine left-joined with each frame; for models already written as tables."""
    out = key_spine(frames, keys)
    for frame in frames:
        out = out.join(frame, keys, "left")
    return out


def merge_on_key(frames: list[DataFrame], keys: list[str], grouped: bool = False) -> DataFrame:
    """The result of join_on_spine, for models still being computed.

    Each frame must be unique on the keys and have its own value columns. The
    frames come out of aggregations hashed on the keys; their union keeps that
    partitioning, so merging adds no shuffle and computes each model once,
    where a spine with joins would compute each twice. The same aggregate counts
    the rows of each frame per key: two of one frame stop the job. Frames that a
    groupBy on the keys has just made are unique, and go unchecked as grouped.
    """
    values = [c for f in frames for c in f.columns if c not in keys]
    largest = [F.max(c).alias(c) for c in values]
    if grouped:
        stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
        return stacked.groupBy(*keys).agg(*largest)
    marked = [f.withColumn(f"_rows_{i}", F.lit(1)) for i, f in enumerate(frames)]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), marked)
    counts = [F.sum(f"_rows_{i}").alias(f"_rows_{i}") for i in range(len(frames))]
    merged = stacked.groupBy(*keys).agg(*largest, *counts)
    twice = reduce(Column.__or__, [F.col(f"_rows_{i}") > 1 for i in range(len(frames))])
    key = F.concat_ws(", ", *[F.col(k).cast("string") for k in keys])
    stop = F.raise_error(F.concat(F.lit("two rows of one model share a key: "), key)).cast("boolean")
    return merged.where(F.when(twice, stop).otherwise(F.lit(True))).select(*keys, *values)


def join_colocated(frames: list[DataFrame], keys: list[str], folder: str, buckets: int) -> DataFrame:
    """The result of join_on_spine from tables bucketed on the keys, spine included, below ``folder``.

    Each model is shuffled once, on its way to its table; the joins after that, and all later ones on the
    keys, take bucket by bucket without another exchange. The tables stay registered in the session.
    """
    spark = frames[0].sparkSession
    written = [write_bucketed(f, f"{folder}/model_{i}", keys, buckets) for i, f in enumerate(frames)]
    # The spine reads the files, not the tables: a union of bucketed scans passes for hashed on the keys, and
    # its distinct goes without an exchange, even where the scans are then split without regard to buckets.
    plain = [spark.read.schema(f.schema).parquet(f"{folder}/model_{i}") for i, f in enumerate(frames)]
    out = write_bucketed(key_spine(plain, keys), f"{folder}/spine", keys, buckets)
    for frame in written:
        out = out.join(frame, keys, "left")
    return out
