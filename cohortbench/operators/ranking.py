"""Order as data: the place of every row in a sorted result, without a window over all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortbench.session import settled

#: monotonically_increasing_id() holds the partition above this bit and the row in it below.
_ROW_BITS = 33


def numbered(df: DataFrame, out: str = "place") -> DataFrame:
    """Adds ``out``: 1 for the first row of ``df`` in the order it is in, and so on without gaps.

    Rows are counted where they lie, one row per partition is summed up, and every partition is
    shifted by the rows of the earlier ones. A sorted table is dealt to its partitions by range, so
    this numbers it in its order; it is settled first, since the counts and the rows must be of one
    run. An empty table stays empty; a column named ``out`` is replaced.
    """
    names = [c for c in df.columns if c != out]
    kept = [F.col(f"`{c}`") for c in names]
    # The rows travel as one struct: no column of theirs can clash with those of the count.
    at = F.monotonically_increasing_id().alias("at")
    rows = settled(df.select(F.struct(*kept).alias("row"), at))
    part = F.shiftright("at", _ROW_BITS)
    counts = rows.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))
    # A row per partition: bounded by the number of tasks, not by the data.
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = F.broadcast(counts.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")))
    inside = F.col("at").bitwiseAND((1 << _ROW_BITS) - 1)
    placed = rows.join(before, part == F.col("part"))
    return placed.select(*[F.col("row").getField(c).alias(c) for c in names], (F.col("before") + inside + 1).alias(out))


def ordered_rank(df: DataFrame, order: Sequence[Column | str], out: str = "place") -> DataFrame:
    """Adds ``out``: 1, 2, 3 and so on over all rows by ``order``; rows equal in it come in any order.

    Rows are dealt to tasks by ranges of the order and, last, of where they lie in the input, so that
    a value shared by a third of all rows is sorted by many tasks.
    """
    tied = df.select("*", F.monotonically_increasing_id().alias("__lies"))
    dealt = tied.repartitionByRange(*order, F.col("__lies")).sortWithinPartitions(*order, F.col("__lies"))
    return numbered(dealt.drop("__lies"), out)
