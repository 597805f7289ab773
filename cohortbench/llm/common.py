"""Helpers of the operators: settled tables, ranks without a hot task, bytes of text columns."""

from __future__ import annotations

import math
import tempfile
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_own_dir: tempfile.TemporaryDirectory | None = None

#: Rows that one task ranks; more rows mean more tasks.
RANK_ROWS = 10_000


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session; a local session without one gets its own."""
    global _own_dir
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        _own_dir = _own_dir or tempfile.TemporaryDirectory(prefix="cohortbench-llm-")
        root = _own_dir.name
    if not context.getCheckpointDir():
        context.setCheckpointDir(root)
    return root


def settled(df: DataFrame) -> DataFrame:
    """The same rows, written once to the shared checkpoint folder: lost executors cost no rework."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint()


def global_rank(df: DataFrame, group: Sequence[str], order: Sequence[str], out: str,
                per_task: int = RANK_ROWS, rows: int | None = None) -> DataFrame:
    """Adds ``out``: a gapless rank from 0 within each group, in an order hashed from ``order``.

    A group's rows are dealt to buckets by that hash, ranked in their bucket, and shifted by the
    rows of the earlier buckets, so a group with a third of all rows is ranked by many tasks.
    The number of buckets follows the number of rows; the rank is by bucket, hash, then ``order``. Null groups are a group of their own.
    Rows equal in all order columns get adjacent ranks in any order.
    """
    rows = df.count() if rows is None else rows
    buckets = max(1, math.ceil(rows / per_task))
    keyed = df.withColumn("__hash", F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in order]).cast("binary")))
    leading = F.conv(F.substring("__hash", 1, 8), 16, 10).cast("long")
    keyed = keyed.withColumn("__bucket", (leading % buckets).cast("int"))
    # Rows of one order, as with absent or repeated ids, share a hash however many they are.
    heavy = settled(keyed.groupBy("__bucket", "__hash").agg(F.count("*").alias("__n")).where(F.col("__n") > per_task))
    if heavy.isEmpty():
        return _ranked(df, keyed, group, ["__bucket"], ["__hash", *order], out)
    return _ranked(df, _split(keyed, heavy, per_task), group, ["__bucket", "__piece", "__sub"], ["__hash", *order], out)


def _split(keyed: DataFrame, heavy: DataFrame, per_task: int) -> DataFrame:
    """Cuts the buckets that hold heavy hashes: before, between and after them, and each of them by where its rows lie.

    A bucket has few heavy hashes, since each fills a task. The result is settled: its counts and its
    places are taken separately, and must see the same pieces.
    """
    one = F.struct("__hash", F.ceil(F.col("__n") / per_task).alias("n"))
    lists = heavy.groupBy("__bucket").agg(F.array_sort(F.collect_list(one)).alias("__heavy"))
    placed = keyed.withColumn("__lies", F.monotonically_increasing_id()).join(lists, "__bucket", "left")
    before = F.size(F.filter("__heavy", lambda h: h["__hash"] < F.col("__hash")))
    own = F.filter("__heavy", lambda h: h["__hash"] == F.col("__hash"))
    parts = F.when(F.size(own) > 0, F.element_at(own, 1)["n"])
    some = F.col("__heavy").isNotNull()
    piece = F.when(some, 2 * before + F.when(parts.isNotNull(), 1).otherwise(0)).otherwise(0)
    sub = F.when(some & parts.isNotNull(), F.pmod(F.xxhash64("__lies"), parts)).otherwise(0)
    return settled(placed.select("*", piece.alias("__piece"), sub.alias("__sub")).drop("__heavy", "__lies"))


def placed_rank(df: DataFrame, group: Sequence[str], part: str, place: str, order: Sequence[str], out: str,
                per_task: int = RANK_ROWS) -> DataFrame:
    """Adds ``out``: a gapless rank from 0 within each group, in the order of ``part``, ``place``, then ``order``.

    part and place are longs that say where a row lies; a task ranks the rows of one run of
    ``per_task`` places of a part, and they are shifted by the rows of the earlier runs.
    """
    keyed = df.withColumn("__bucket", F.floor(F.col(place) / per_task).cast("long"))
    return _ranked(df, keyed, group, [part, "__bucket"], [place, *order], out)


def _ranked(df: DataFrame, keyed: DataFrame, group: Sequence[str], blocks: Sequence[str], inner: Sequence[str],
            out: str) -> DataFrame:
    """Ranks by ``blocks``, then ``inner``: each block of a group by itself, shifted by the rows of the earlier ones."""
    inside = Window.partitionBy(*group, *blocks).orderBy(*inner)
    placed = keyed.withColumn("__place", F.row_number().over(inside).cast("long"))
    counts = keyed.groupBy(*group, *blocks).agg(F.count("*").alias("__rows"))
    before = Window.partitionBy(*group).orderBy(*blocks).rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(
        *[F.col(c).alias(f"__g{i}") for i, c in enumerate(group)],
        *[F.col(c).alias(f"__b{i}") for i, c in enumerate(blocks)],
        F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__before"),
    )
    same = F.lit(True)
    for i, c in enumerate(blocks):
        same = same & (F.col(c) == F.col(f"__b{i}"))
    for i, c in enumerate(group):
        same = same & F.col(c).eqNullSafe(F.col(f"__g{i}"))
    kept = [c for c in df.columns if c != out]
    return placed.join(counts, same).select(
        *kept, (F.col("__place") - 1 + F.col("__before")).alias(out))


def with_place(df: DataFrame, part: str = "__part", place: str = "__row_place") -> DataFrame:
    """Adds where each row lies: its file by number and its row there, or its partition and its row there.

    ``df`` is a Parquet table just read, whose files Spark wrote partition after partition, or else a
    table that no file stands behind.
    """
    try:
        name, row = F.col("_metadata.file_name"), F.col("_metadata.row_index")
        number = [F.coalesce(F.regexp_extract(name, p, 1).try_cast("long"), F.lit(0)) for p in (r"^part-(\d+)-", r"-c(\d+)\.")]
        return df.select("*", (number[0] * 1_000_000 + number[1]).alias(part), row.alias(place))
    except AnalysisException:
        at = F.monotonically_increasing_id()
        return df.select("*", at.alias(place)).select(
            *df.columns, F.shiftright(place, 33).alias(part), F.col(place).bitwiseAND((1 << 33) - 1).alias(place))


def as_row(df: DataFrame, name: str = "__row") -> Column:
    """All columns as one struct, so that work columns can't clash with the caller's."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(name)


def columns_of(df: DataFrame, name: str = "__row") -> list[Column]:
    fields = df.schema[name].dataType.fieldNames()
    return [F.col(name).getField(f).alias(f) for f in fields]


def text_of(column: str = "text") -> Column:
    """The text; an absent one is empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


# Bytes of text, in Python workers.

#: 1 for the bytes that separate words: space and 0x09 to 0x0D.
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[32, *range(9, 14)]] = True

#: Bytes of text that are worked on at once; a longer text is a batch of its own.
BATCH_BYTES = 1 << 20


def byte_slices(column: pa.Array, most: int = BATCH_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Yields (first row, end row, bytes, row starts with the end) of consecutive rows."""
    if pa.types.is_large_string(column.type):
        kind = np.int64
    else:
        column, kind = column.cast(pa.string()), np.int32
    column = column.fill_null("") if column.null_count else column
    n = len(column)
    if not n:
        return
    offsets = np.frombuffer(column.buffers()[1], kind)[column.offset : column.offset + n + 1].astype(np.int64)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        end = int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1
        end = min(n, max(end, first + 1))
        yield first, end, data[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first]
        first = end


def word_bounds(data: np.ndarray, rows: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every run of ``inside`` bytes; runs don't cross rows."""
    n = len(data)
    cut = np.zeros(n + 1, bool)
    cut[rows] = True
    before = np.empty(n, bool)
    before[:1] = True
    before[1:] = ~inside[:-1]
    after = np.empty(n, bool)
    after[-1:] = True
    after[:-1] = ~inside[1:]
    starts = np.flatnonzero(inside & (before | cut[:n]))
    ends = np.flatnonzero(inside & (after | cut[1:])) + 1
    return starts, ends, np.searchsorted(rows, starts, "right") - 1


_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def mixed(h: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit hashes."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each word."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    sizes = ends - starts
    first = np.cumsum(sizes) - sizes
    place = np.arange(int(sizes.sum())) - np.repeat(first, sizes)
    power = np.multiply.accumulate(np.full(int(sizes.max()), _FACTOR))
    values = (data[place + np.repeat(starts, sizes)].astype(np.uint64) + np.uint64(1)) * power[place]
    return mixed(np.add.reduceat(values, first) + sizes.astype(np.uint64))
