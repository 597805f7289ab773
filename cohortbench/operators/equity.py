"""Equity report: gaps with severity, and parity of shares."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortbench.functions.rates import ratio
from cohortbench.functions.tiers import gap_severity


def pair_years(
    dim: DataFrame,
    fact: DataFrame,
    completions: DataFrame,
    key: str,
    year: str = "year",
    keyed: bool = True,
) -> DataFrame:
    """Entity, its outcome years and its completion counts.

    Keyed: completions of the same year, one row per entity-year. Not keyed: the
    published report's grain, every outcome year beside every completion year of
    the entity. Both inputs are unique on (key, year), so an entity yields at
    most years x years rows however many raw rows it has.
    """
    if keyed:
        return dim.join(fact, key, "left").join(completions, [key, year], "left")
    return dim.join(fact.drop(year), key, "left").join(completions.drop(year), key, "left")


def pair_all_years(
    dim: DataFrame,
    yearly: DataFrame,
    key: str,
    outcome: list[str],
    completion: list[str],
    completed: Column,
) -> DataFrame:
    """pair_years(keyed=False) when both sides are columns of one entity-year frame.

    The frame is computed once: each entity's years, a handful since the frame is
    unique on (key, year), are gathered as two lists and expanded against each
    other beside the entity.
    """
    lists = yearly.groupBy(key).agg(
        F.collect_list(F.struct(*outcome)).alias("_outcomes"),
        F.collect_list(F.when(completed, F.struct(*completion))).alias("_completions"),
    )
    own = dim.columns
    paired = (
        dim.join(lists, key, "left")
        .select(*own, "_completions", F.explode_outer("_outcomes").alias("_outcome"))
        .select(*own, "_outcome", F.explode_outer("_completions").alias("_completion"))
    )
    return paired.select(*own, "_outcome.*", "_completion.*")


def with_severity(df: DataFrame, gaps: Mapping[str, str]) -> DataFrame:
    return df.select("*", *[gap_severity(F.col(gap)).alias(name) for name, gap in gaps.items()])


def with_parity(df: DataFrame, pairs: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Share among completers over share among enrolled; above 1 is over-represented."""
    return df.select(
        "*", *[ratio(F.col(a), F.col(b), 2).alias(name) for name, (a, b) in pairs.items()]
    )
