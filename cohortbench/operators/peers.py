"""Peer groups: attributes, averages and standing against them."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortbench.functions.rates import mean_of, scaled_round
from cohortbench.functions.tiers import Tier, peer_standing


def with_tiers(df: DataFrame, tiers: list[Tier]) -> DataFrame:
    return df.select("*", *[t.column() for t in tiers])


def entity_years(dim: DataFrame, fact: DataFrame, key: str) -> DataFrame:
    """Every entity with each of its fact years; entities without any keep one row."""
    own = [c for c in fact.columns if c == key or c not in dim.columns]
    return dim.join(fact.select(*own), key, "left")


def peer_averages(
    rows: DataFrame, keys: list[str], metrics: Mapping[str, tuple[str, int, int]], entity: str
) -> DataFrame:
    """Mean of each metric per peer group.

    `metrics` maps the output name to (column, digits held, digits shown). The
    input has one row per entity-year, so entity-level metrics and the group
    count weigh an entity by its number of years; peer_entity_count beside it
    counts entities.
    """
    return rows.groupBy(*keys).agg(
        *[
            mean_of(F.col(column), scale, digits).alias(name)
            for name, (column, scale, digits) in metrics.items()
        ],
        F.count(F.lit(1)).alias("peer_group_count"),
        F.countDistinct(entity).alias("peer_entity_count"),
    )


def attach_averages(
    rows: DataFrame, averages: DataFrame, keys: list[str], tiers: list[Tier]
) -> DataFrame:
    """Left join on equal keys; a null key finds no group.

    The keys are the tiers, so the label sets bound the number of groups, with one
    more for each null, and the averages are always broadcast.
    """
    if sorted(keys) != sorted(t.name for t in tiers):
        raise ValueError("peer groups are keyed by exactly the given tiers")
    return rows.join(F.broadcast(averages), keys, "left")


def peer_deltas(
    df: DataFrame, deltas: Mapping[str, tuple[str, str]], standing: tuple[str, str, str]
) -> DataFrame:
    """Own metric minus peer mean for each delta, and the label for one metric."""
    label, own, mean = standing
    return df.select(
        "*",
        *[scaled_round(F.col(a) - F.col(b), 1).alias(name) for name, (a, b) in deltas.items()],
        peer_standing(F.col(own), F.col(mean)).alias(label),
    )
