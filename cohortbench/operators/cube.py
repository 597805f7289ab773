"""A stored cube of star measures: any subset of its dimensions is answered from mergeable partial aggregates.

A cell keeps exact sums and counts, and the entities it holds as bitmaps of their numbers, in pages of 32,768
numbers. Sums add up and bitmaps are united, so that distinct entities stay exact over any roll-up, which
counts of distinct entities alone would not allow. Entities are numbered densely, since pages of sparse keys
would be nearly empty.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortbench.operators.ranking import ordered_rank


@dataclass(frozen=True)
class Mean:
    """Mean of a column held to ``scale`` digits."""

    column: str
    scale: int


@dataclass(frozen=True)
class Total:
    column: str


@dataclass(frozen=True)
class Entities:
    """Distinct entities."""


Measure = Mean | Total | Entities


def _unscaled(c: Column, scale: int) -> Column:
    return (c.cast(f"decimal(28,{scale})") * F.lit(10**scale)).cast("bigint")


def cells(
    dim: DataFrame, fact: DataFrame, key: str, by: list[str], measures: Mapping[str, Measure]
) -> DataFrame:
    """The cube's cells: a row per combination of ``by`` (columns of dim or fact) and page of entity numbers.

    Facts without an entity in dim are left out, as in the direct aggregate. dim must be unique on the key.
    """
    own = [c for c in dim.columns if c == key or c not in fact.columns]
    numbered = ordered_rank(dim.select(*own).where(F.col(key).isNotNull()), [key], "_number")
    rows = fact.join(numbered, key, "inner")
    parts = [
        F.bitmap_construct_agg(F.bitmap_bit_position("_number")).alias("_entities")
    ]
    for name, measure in measures.items():
        match measure:
            case Mean(column, scale):
                parts.append(F.sum(_unscaled(F.col(column), scale)).alias(f"{name}_sum"))
                parts.append(F.count(column).alias(f"{name}_n"))
            case Total(column):
                parts.append(F.sum(column).alias(f"{name}_sum"))
    page = F.bitmap_bucket_number("_number").alias("_page")
    return rows.groupBy(*by, page).agg(*parts)


def answer(
    stored: DataFrame, by: Iterable[str], measures: Mapping[str, Measure], where: Column | None = None
) -> DataFrame:
    """The measures by any of the cube's dimensions, rolled up from its cells; none gives one row in all.

    ``where`` may restrict the dimensions. Cells of one page are united first, then pages are added up, as
    an entity is in one page only.
    """
    by = list(by)
    chosen = stored if where is None else stored.where(where)
    sums, finals = [], []
    for name, measure in measures.items():
        match measure:
            case Mean(_, scale):
                sums += [F.sum(f"{name}_sum").alias(f"{name}_sum"), F.sum(f"{name}_n").alias(f"{name}_n")]
                n = F.nullif(F.sum(f"{name}_n"), F.lit(0)) * F.lit(10**scale)
                finals.append((F.sum(f"{name}_sum").cast("double") / n.cast("double")).alias(name))
            case Total():
                sums.append(F.sum(f"{name}_sum").alias(f"{name}_sum"))
                finals.append(F.sum(f"{name}_sum").alias(name))
            case Entities():
                finals.append(F.coalesce(F.sum("_held"), F.lit(0)).alias(name))
    held = F.bitmap_count(F.bitmap_or_agg("_entities")).alias("_held")
    pages = chosen.groupBy(*by, "_page").agg(held, *sums)
    return pages.groupBy(*by).agg(*finals)
