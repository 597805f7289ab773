"""Reading finished marts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def mart_rows(df: DataFrame, year: str = "year", name: str = "institution_name") -> DataFrame:
    return df.orderBy(year, name)


def year_window(df: DataFrame, first: int, last: int, year: str = "year") -> DataFrame:
    """Both ends included; a partition filter when the mart is partitioned by year."""
    return df.where(F.col(year).between(first, last))


def mart_window(
    df: DataFrame,
    columns: list[str],
    first: int,
    last: int,
    year: str = "year",
    name: str = "institution_name",
) -> DataFrame:
    return year_window(df, first, last, year).select(*columns).orderBy(year, name)


def in_years(timestamp: Column, first: int, last: int, type_name: str) -> Column:
    """Year window on a raw timestamp, as a range the Parquet scan can use to skip."""
    start = F.lit(f"{first:04d}-01-01 00:00:00").cast(type_name)
    end = F.lit(f"{last + 1:04d}-01-01 00:00:00").cast(type_name)
    return (timestamp >= start) & (timestamp < end)


def latest_value(df: DataFrame, column: str) -> Column:
    """Largest value over the whole relation, as a scalar subquery."""
    return df.select(F.max(column)).scalar()


def in_latest_year(df: DataFrame, timestamp: str) -> Column:
    """Rows of the newest calendar year of the whole relation, pushed to the scan."""
    type_name = df.schema[timestamp].dataType.simpleString()
    start = F.make_date(F.year(F.max(timestamp)), F.lit(1), F.lit(1)).cast(type_name)
    return F.col(timestamp) >= df.select(start).scalar()


def latest_year_rows(df: DataFrame, year: str = "year") -> DataFrame:
    """Rows of the newest year of `df` itself; filters applied later do not move it."""
    return df.where(F.col(year) == latest_value(df, year))
