"""Mixing sources to target weights by Pfair scheduling.

Block k of a source with weight w may run from slot floor(k / w) and must run before slot
ceil((k + 1) / w). Earliest deadline first, over the released blocks, meets every deadline, so that
after any number t of slots each source has had less than one block more or less than w * t.
Weights are whole slots of a period, so the schedule repeats: one period is scheduled on the driver,
and block k finds its slot by division.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortbench.llm.common import as_row, columns_of, global_rank

#: Rows of a block, slots of a period at least, and the power of a source's rows that is its weight.
BLOCK_ROWS = 32
PERIOD = 1000
TEMPER = 0.7

#: A fair period gives the smallest source this many slots, or as many as fit the longest period.
FAIR_SLOTS = 10
LONGEST_PERIOD = 250_000

#: Components of a mixture; each takes a row on the driver and at least one slot of the period.
MAX_SOURCES = 100_000


def tempered(counts: dict[str, int], power: float = TEMPER) -> dict[str, float]:
    """Weights by a power of the rows: small sources get more than their share."""
    return {s: n**power for s, n in counts.items() if n > 0}


def fair_period(weights: dict[str, float]) -> int:
    """The period in which no source is raised to its least slot: the smallest has whole slots, ten if they fit.

    A source of less than 1 / LONGEST_PERIOD of the mix is still raised to that: the period lies on the driver.
    """
    share = min(weights.values()) / sum(weights.values())
    slots = max(1, min(FAIR_SLOTS, int(LONGEST_PERIOD * share)))
    return max(PERIOD, round(min(LONGEST_PERIOD, slots / share)))


def period_slots(weights: dict[str, float], period: int = PERIOD) -> dict[str, int]:
    """Slots of each source in a period, by largest remainder, at least one each."""
    period = max(period, 10 * len(weights))
    total = sum(weights.values())
    exact = {s: period * w / total for s, w in weights.items()}
    slots = {s: max(1, int(x)) for s, x in exact.items()}
    left = period - sum(slots.values())
    for s in sorted(exact, key=lambda s: (slots[s] - exact[s], s))[: max(left, 0)]:
        slots[s] += 1
    # Sources raised to one slot have taken too many: who is most above its share gives one back, again and again.
    last_first = sorted(slots, reverse=True)
    over = [(exact[s] - slots[s], i) for i, s in enumerate(last_first) if slots[s] > 1]
    heapq.heapify(over)
    for _ in range(-left):
        _, i = heapq.heappop(over)
        s = last_first[i]
        slots[s] -= 1
        if slots[s] > 1:
            heapq.heappush(over, (exact[s] - slots[s], i))
    return slots


def schedule(slots: dict[str, int]) -> list[tuple[str, int, int, int, int]]:
    """(source, block, release, deadline, slot) of one period: earliest deadline first."""
    period = sum(slots.values())
    waiting = sorted((k * period // n, -(-(k + 1) * period // n), s, k) for s, n in slots.items() for k in range(n))
    ready, out, i = [], [], 0
    for t in range(period):
        while i < len(waiting) and waiting[i][0] <= t:
            release, deadline, s, k = waiting[i]
            heapq.heappush(ready, (deadline, s, k, release))
            i += 1
        deadline, s, k, release = heapq.heappop(ready)
        if t >= deadline:
            raise AssertionError("a deadline was missed")
        out.append((s, k, release, deadline, t))
    return out


def mix(docs: DataFrame, weights: dict[str, float] | None = None, block_rows: int = BLOCK_ROWS,
        period: int | None = None) -> DataFrame:
    """Every row of ``docs`` in __row, with source, epoch, block, release, deadline, slot, position, through.

    Rows of a source come in a hashed order; a source that has given all its rows starts over (epoch),
    until every source has given all its rows at least once: no row is dropped, and the result keeps
    the target weights to its end. position is slot * block_rows plus the place in the block, unique
    and the order of the mix; through is the share of the slots before this one. Weights may be given by source (others get none and stay out) and are
    else tempered row counts. An absent source is the source "". Repeated rows count as rows.
    An empty table gives an empty result. Without a period it is the fair one of the weights; a given one
    raises sources of less than one slot to a whole one.
    """
    source = F.coalesce(F.col("source").cast("string"), F.lit(""))
    rows = docs.select(as_row(docs), source.alias("source"), F.col("doc_id").alias("__key"))
    counted = rows.groupBy("source").agg(F.count("*").alias("n")).limit(MAX_SOURCES + 1).collect()
    if len(counted) > MAX_SOURCES:
        raise ValueError(f"a mixture has at most {MAX_SOURCES} sources")
    counts = {r["source"]: r["n"] for r in sorted(counted)}
    weights = tempered(counts) if weights is None else {s: w for s, w in weights.items() if counts.get(s) and w > 0}
    slots = period_slots(weights, period or fair_period(weights)) if weights else {}
    table = schedule(slots) if slots else []
    length = len(table)
    at = {(s, k): t for s, k, _, _, t in table}
    ends = [((n := -(-counts[s] // block_rows) - 1) // slots[s]) * length + at[s, n % slots[s]] for s in slots]
    end = max(ends, default=-1) + 1
    spark = docs.sparkSession
    periods = spark.createDataFrame(
        [(s, k, r, d, t, slots[s], counts[s]) for s, k, r, d, t in table],
        "source string, k long, release long, deadline long, t long, per long, n long")
    sources = spark.createDataFrame([(s, slots[s], counts[s]) for s in slots], "source string, per long, n long")
    ranked = global_rank(rows, ["source"], ["__key"], "rank", rows=sum(counts.values())).drop("__key")
    # Places in the periods begun before the end; the slots of the last one are cut below.
    ranked = ranked.join(sources, "source")
    reach = F.ceil(F.lit(end) / F.lit(max(1, length))) * F.col("per") * block_rows
    epochs = F.sequence(F.lit(0).cast("long"), F.floor((reach - 1 - F.col("rank")) / F.col("n")).cast("long"))
    turns = ranked.select("__row", "source", "per", "n", "rank", F.explode(epochs).alias("epoch"))
    turns = turns.withColumn("place", F.col("rank") + F.col("epoch") * F.col("n"))
    turns = turns.withColumn("block", F.floor(F.col("place") / block_rows).cast("long"))
    turns = turns.withColumn("k", F.col("block") % F.col("per")).withColumn(
        "base", F.floor(F.col("block") / F.col("per")).cast("long") * length)
    placed = turns.join(periods.select("source", "k", "release", "deadline", "t"), ["source", "k"])
    placed = placed.withColumn("slot", F.col("base") + F.col("t")).where(F.col("slot") < end)
    return placed.select(
        "__row", "source", "epoch", "block", (F.col("base") + F.col("release")).alias("release"),
        (F.col("base") + F.col("deadline")).alias("deadline"), "slot",
        (F.col("slot") * block_rows + F.col("place") % block_rows).alias("position"),
        (F.col("slot") / F.lit(max(1, end))).alias("through"))


def mixed_documents(docs: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """The rows of ``docs`` in mixed order: partition after partition, sorted in each; the period is the fair one."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = mix(docs, weights).select("__row", "position", F.floor(F.col("through") * parts).cast("int").alias("part"))
    ordered = placed.repartitionById(parts, F.col("part")).sortWithinPartitions("position")
    return ordered.select(*columns_of(ordered))
