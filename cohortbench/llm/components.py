"""Connected components of a graph too large for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortbench.llm.common import settled


def components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """node, root for every node of ``edges`` (a, b: long): the smallest node that it is linked with.

    Alternates large-star (larger neighbours move to the smallest) and small-star (smaller ones do)
    until every node hangs on its root. A hub's edges are only ever aggregated to their least end and
    joined, so no task has to hold them. Each round is written to the checkpoint folder.
    """
    links = settled(edges.where("a <> b").select(
        F.greatest("a", "b").alias("node"), F.least("a", "b").alias("root")).distinct())
    for _ in range(max_rounds):
        both = links.unionByName(links.select(F.col("root").alias("node"), F.col("node").alias("root")))
        least = both.groupBy("node").agg(F.least(F.min("root"), F.col("node")).alias("least"))
        large = both.join(least, "node").where("root > node").select(F.col("root").alias("node"), F.col("least").alias("root"))
        large = large.where("node <> root").distinct()
        least = large.groupBy("node").agg(F.min("root").alias("least"))
        small = large.join(least, "node").where("root <> least").select(F.col("root").alias("node"), F.col("least").alias("root"))
        moved = settled(small.unionByName(least.select("node", F.col("least").alias("root"))).distinct())
        # Done when every node has one root, and no root is a node.
        roots = moved.select(F.col("root").alias("node")).distinct()
        again = moved.groupBy("node").count().where("count > 1").select("node").limit(1)
        if again.unionByName(moved.join(roots, "node", "left_semi").select("node").limit(1)).isEmpty():
            tips = moved.select(F.col("root").alias("node")).distinct()
            return moved.unionByName(tips.select("node", F.col("node").alias("root")))
        links = moved
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
