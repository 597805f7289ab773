"""Cumulative-snapshot collapse of logged conversations, and their rendering.

A chat service logs the whole conversation again after every turn, so most logged conversations are
prefixes of longer ones. Every turn gets a rolling hash of its prefix; a conversation whose last hash
occurs inside a longer one is a snapshot and goes. What is left is rendered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortbench.llm.common import settled

#: Turn numbers that one task walks through; a longer conversation is walked by several tasks.
TURNS_PER_TASK = 256

#: Turns of one rendered part; a longer conversation gives several parts, none is cut off.
TURNS_PER_PART = 512


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, place (from 1), role, text of every turn, and the run of turns that a task walks.

    Turns are ordered by turn (null first), role and text; a turn logged twice in all four columns
    counts once: a task drops the repeats it holds before any are shuffled. Absent roles and texts are
    empty. Rows without conv_id belong to no conversation.
    """
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        "conv_id", F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        F.coalesce(F.floor(F.col("turn") / TURNS_PER_TASK), F.lit(-(1 << 62))).cast("long").alias("run"),
    ).distinct()
    walk = Window.partitionBy("conv_id", "run").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    # Settled, as the shifts, the hashes and the rendering all read them.
    turns = settled(turns.withColumn("place", F.row_number().over(walk).cast("long")))
    earlier = Window.partitionBy("conv_id").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    shifts = turns.groupBy("conv_id", "run").agg(F.max("place").alias("turns")).select(
        "conv_id", "run", F.coalesce(F.sum("turns").over(earlier), F.lit(0)).alias("shift"))
    return turns.join(shifts, ["conv_id", "run"]).select(
        "conv_id", "run", (F.col("place") + F.col("shift")).alias("place"), "role", "text")


def prefix_hashes(turns: DataFrame) -> DataFrame:
    """conv_id, place, and 128 bits (a, b) of hash over the turns up to that place.

    The hash of a prefix is the exclusive or of its turns' hashes, each taken with its place, so runs
    of one conversation are hashed apart and joined.
    """
    hashed = turns.select("conv_id", "run", "place",
                          F.xxhash64(F.lit(1), "place", "role", "text").alias("a"),
                          F.xxhash64(F.lit(2), "place", "text", "role").alias("b"))
    walk = Window.partitionBy("conv_id", "run").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy("conv_id").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    runs = hashed.groupBy("conv_id", "run").agg(F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b")).select(
        "conv_id", "run",
        F.coalesce(F.bit_xor("a").over(earlier), F.lit(0)).alias("a0"),
        F.coalesce(F.bit_xor("b").over(earlier), F.lit(0)).alias("b0"))
    return hashed.join(runs, ["conv_id", "run"]).select(
        "conv_id", "place",
        F.bit_xor("a").over(walk).bitwiseXOR(F.col("a0")).alias("a"),
        F.bit_xor("b").over(walk).bitwiseXOR(F.col("b0")).alias("b"))


def maximal_conversations(prefixes: DataFrame) -> DataFrame:
    """conv_id, n_turns, copies: the conversations that no longer one begins with.

    Equal conversations leave the one of the smallest conv_id; copies counts them.
    """
    whole = prefixes.groupBy("conv_id").agg(F.max(F.struct("place", "a", "b")).alias("last"))
    whole = whole.select("conv_id", F.col("last.place").alias("n_turns"), F.col("last.a").alias("a"),
                         F.col("last.b").alias("b"))
    first = whole.groupBy("n_turns", "a", "b").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("copies"))
    inner = prefixes.join(first.select("conv_id", "n_turns"), "conv_id").where("place < n_turns")
    inner = inner.groupBy(F.col("place").alias("n_turns"), "a", "b").agg(F.lit(1).alias("seen"))
    return first.join(inner, ["n_turns", "a", "b"], "left_anti").select("conv_id", "n_turns", "copies")


def collapse(conversations: DataFrame, turns_per_part: int = TURNS_PER_PART) -> DataFrame:
    """conv_id, part, n_turns, copies, text: maximal conversations, rendered.

    A turn is rendered as ``<|role|>``, a line break, the text, ``<|end|>`` and a line break; a ``<|``
    in a role or text becomes ``< |``, so that nobody can forge a turn. n_turns counts the whole
    conversation. An empty table gives an empty result.
    """
    turns = numbered_turns(conversations)
    kept = maximal_conversations(settled(prefix_hashes(turns)))
    plain = {c: F.replace(F.col(c), F.lit("<|"), F.lit("< |")) for c in ("role", "text")}
    lines = turns.join(kept, "conv_id").select(
        "conv_id", "n_turns", "copies", "place",
        F.floor((F.col("place") - 1) / turns_per_part).cast("long").alias("part"),
        F.concat(F.lit("<|"), plain["role"], F.lit("|>\n"), plain["text"], F.lit("<|end|>\n")).alias("line"))
    parts = lines.groupBy("conv_id", "part", "n_turns", "copies").agg(
        F.sort_array(F.collect_list(F.struct("place", "line"))).alias("lines"))
    return parts.select("conv_id", "part", "n_turns", "copies",
                        F.array_join(F.col("lines.line"), "").alias("text"))
