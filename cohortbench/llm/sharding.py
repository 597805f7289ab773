"""Longest-processing-time sharding: equal texts stay together, shards get near equal bytes.

Groups are sorted by size, and each goes to the least-loaded shard through a heap. Groups of one load are
alike to the heap, so it is run over the histogram of loads: for each load, largest first, it gives out rounds
of shards, and a group finds its shard by its rank among the groups of its load. That is the result of one heap
over all groups, at any number of them.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortbench.llm.common import global_rank, settled, text_of
from cohortbench.operators.ranking import ordered_rank

SHARDS = 8

Turns = list[tuple[int, list[int]]]


def give_out(heap: list[tuple[int, int]], load: int, groups: int) -> Turns:
    """What a heap of (load, shard) does with so many groups of one load: (first group, the shards that take turns from it).

    Shards that lie within one load of the least loaded one take turns in the order of the heap, until a
    further shard lies within it too. The heap is changed to what it is after the last group.
    """
    out, given = [], 0
    while given < groups:
        least, first = heap[0]
        order, waiting = [], []
        for x in sorted(heap):
            (order if x < (least + load, first) or x == heap[0] else waiting).append(x)
        last = order[-1]
        left = groups - given
        if waiting and load:
            # Rounds until the last in turn would come after the first that waits.
            x = min(waiting)
            rounds = (x[0] - last[0]) // load + 1 if last[1] < x[1] else -(-(x[0] - last[0]) // load)
            left = min(left, rounds * len(order))
        out.append((given, [s for _, s in order]))
        whole, more = divmod(left, len(order))
        heap[:] = waiting + [(at + load * (whole + (i < more)), s) for i, (at, s) in enumerate(order)]
        heapq.heapify(heap)
        given += left
    return out


def turns_of(histogram: list[tuple[int, int]], shards: int) -> list[tuple[int, int, Turns]]:
    """(load, groups of larger loads, turns) of every (load, groups) of the histogram."""
    heap, before, out = [(0, s) for s in range(shards)], 0, []
    for load, groups in sorted(histogram, reverse=True):
        out.append((load, before, give_out(heap, load, groups)))
        before += groups
    return out


def longest_first(groups: DataFrame, shards: int = SHARDS) -> DataFrame:
    """key, shard of ``groups`` (unique key string, load long, tie long): longest first to the least-loaded shard.

    Larger loads first, ties by ``tie`` (absent ones last), then key; among equally loaded shards the smallest
    number. The driver holds a row per distinct load: texts of up to a million bytes have at most about as many.
    """
    found = groups.groupBy("load").agg(F.count("*").alias("n")).collect()
    table = turns_of([(r.load, r.n) for r in found], shards)
    shape = "load long, before long, turns array<struct<first: long, shards: array<int>>>"
    loads = groups.sparkSession.createDataFrame(table, shape)
    order = [F.col("load").desc(), F.asc_nulls_last("tie"), F.col("key")]
    placed = ordered_rank(groups.select("key", "load", "tie"), order, "place").join(loads, "load")
    within = F.col("place") - 1 - F.col("before")
    turn = F.element_at(F.filter("turns", lambda t: t["first"] <= within), -1)
    shard = F.element_at(turn["shards"], (F.pmod(within - turn["first"], F.size(turn["shards"])) + 1).cast("int"))
    return placed.select("key", shard.alias("shard"))


def shard_documents(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot of every row of ``docs``.

    Size is the UTF-8 bytes of the text plus 1; equal texts share a shard, and absent texts are empty.
    slot counts the rows of a shard from 0. Repeated rows and ids, and rows without an id, each keep
    their row. An empty table gives an empty result. A group with more bytes than an even share makes
    its shard that much larger, as it must stay together.
    """
    raw = text_of().cast("binary")
    rows = settled(docs.select(
        "doc_id", (F.octet_length(raw) + 1).cast("long").alias("size"),
        F.crc32(raw).alias("text_crc32"), F.sha2(raw, 256).alias("key")))
    groups = settled(rows.groupBy("key").agg(F.sum("size").alias("load"), F.min("doc_id").alias("tie")))
    shard = longest_first(groups, shards)
    placed = rows.join(shard, "key")
    return global_rank(placed, ["shard"], ["doc_id", "key"], "slot", rows=rows.count()).select(
        "doc_id", "size", "text_crc32", "shard", "slot")
