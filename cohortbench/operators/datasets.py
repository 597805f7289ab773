"""Rows behind the dashboard's cards, tables and charts.

Each function takes a fact at entity-year grain. `year` arguments may be a
number or a scalar Column such as latest_value(fact, "year").
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortbench.functions.display import change_label
from cohortbench.functions.rates import scaled_round


def year_slice(fact: DataFrame, at: int | Column, year: str = "year") -> DataFrame:
    return fact.where(F.col(year) == at)


def cards(df: DataFrame, aggregates: Mapping[str, Column]) -> DataFrame:
    """One row of headline numbers. Without values a mean or sum is null."""
    return df.agg(*[agg.alias(name) for name, agg in aggregates.items()])


def renamed(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Column subset under display names."""
    return df.select(*[F.col(c).alias(label) for c, label in columns.items()])


# Rankings break ties by name. Rates take few distinct values, and without a
# second sort column all rows of one value would be sorted by a single task.


def ranked_table(df: DataFrame, name: str, metric: str) -> DataFrame:
    """Highest first, missing values last."""
    return df.orderBy(F.desc_nulls_last(metric), name)


def ranked_bars(df: DataFrame, name: str, metric: str) -> DataFrame:
    """Lowest first, missing values dropped."""
    return df.select(name, metric).dropna().orderBy(F.asc(metric), name)


def trend(fact: DataFrame, name: str, metrics: list[str], year: str = "year") -> DataFrame:
    """Series points in (name, year) order."""
    return fact.select(name, year, *metrics).orderBy(name, year)


def by_year_columns(
    fact: DataFrame, key: str, name: str, metric: str, years: list[int], year: str = "year"
) -> DataFrame:
    """One column per year holding the cell's value, the largest if there are several.

    Conditional aggregates in a single groupBy: the year list is given, and the
    wide row per entity is built in one shuffle.
    """
    cells = [
        F.max(F.when(F.col(year) == y, F.col(metric))).alias(str(y))
        for y in years
    ]
    # Names may be shared or change; the entity is its key.
    return fact.where(F.col(year).isin(years)).groupBy(key).agg(F.max(name).alias(name), *cells)


def year_grid(
    fact: DataFrame, key: str, name: str, metric: str, years: list[int], year: str = "year"
) -> DataFrame:
    """Every (entity, year) cell, null where the entity has no value.

    Built by turning years into columns and back, not from a product of
    entities and years.
    """
    wide = by_year_columns(fact, key, name, metric, years, year)
    long = wide.unpivot([key, name], [str(y) for y in years], year, metric)
    return long.select(key, name, F.col(year).cast("int").alias(year), metric)


def pivot_with_change(
    fact: DataFrame,
    key: str,
    name: str,
    metric: str,
    years: list[int],
    digits: int,
    year: str = "year",
    drop_empty: bool = True,
) -> DataFrame:
    """Year columns plus last minus first; the change is null if either end is."""
    first, last = str(years[0]), str(years[-1])
    wide = by_year_columns(fact, key, name, metric, years, year)
    if drop_empty:
        wide = wide.dropna("all", subset=[str(y) for y in years])
    shown = wide.select(
        key, name, *[scaled_round(F.col(str(y)).cast("double"), digits).alias(str(y)) for y in years]
    )
    change = scaled_round(F.col(last) - F.col(first), digits)
    return shown.withColumn(change_label(years[0], years[-1]), change)


def years_with_data(fact: DataFrame, metric: str, year: str = "year") -> list[int]:
    """Years holding at least one value; a handful of rows to the driver."""
    found = fact.where(F.col(metric).isNotNull()).select(year).distinct().orderBy(year)
    return [row[0] for row in found.collect()]


def long_by_group(
    df: DataFrame, name: str, groups: Mapping[str, str], group_column: str, value_column: str
) -> DataFrame:
    """Group columns to rows, with each column replaced by its label."""
    cells = df.select(name, *[F.col(c).alias(label) for c, label in groups.items()])
    return cells.unpivot([name], list(groups.values()), group_column, value_column)


def scatter(df: DataFrame, name: str, x: str, y: str) -> DataFrame:
    """Points with both coordinates present."""
    return df.select(name, x, y).dropna(subset=[x, y])


def with_focus(df: DataFrame, name: str, focus: str | Column, then: Sequence[str] = ()) -> DataFrame:
    """is_focus is 1 for the highlighted entity, which sorts last (drawn on top); then by name and ``then``."""
    flag = F.coalesce((F.col(name) == focus).cast("int"), F.lit(0))
    return df.withColumn("is_focus", flag).orderBy("is_focus", name, *then)


def star_measures(
    dim: DataFrame, fact: DataFrame, key: str, by: list[str], measures: Mapping[str, Column]
) -> DataFrame:
    """Measures over fact x dim, grouped by any dimension or fact columns."""
    own = [c for c in dim.columns if c == key or c not in fact.columns]
    joined = fact.join(dim.select(*own), key, "inner")
    return joined.groupBy(*by).agg(*[m.alias(n) for n, m in measures.items()])
