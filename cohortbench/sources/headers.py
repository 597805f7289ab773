"""Column names of files written by many hands."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame

# The byte-order mark, decoded as UTF-8 and as latin-1.
BYTE_ORDER_MARKS = ("\ufeff", "\u00ef\u00bb\u00bf")


class MissingColumns(ValueError):
    def __init__(self, missing: list[str], where: str = ""):
        self.missing = missing
        place = f" in {where}" if where else ""
        super().__init__(f"missing required columns{place}: {', '.join(missing)}")


def clean_name(name: str) -> str:
    name = name.strip()
    for mark in BYTE_ORDER_MARKS:
        name = name.removeprefix(mark)
    return name.strip().upper()


def clean_columns(df: DataFrame) -> DataFrame:
    """Rename every column to its clean form; two that become equal are an error."""
    names = [clean_name(c) for c in df.columns]
    twice = sorted({n for n in names if names.count(n) > 1})
    if twice:
        raise ValueError(f"columns equal after cleaning: {', '.join(twice)}")
    return df.toDF(*names)


def require_columns(df: DataFrame, names: Iterable[str], where: str = "") -> DataFrame:
    """Fail before any job starts when a needed column is absent."""
    have = {clean_name(c) for c in df.columns}
    missing = [n for n in names if clean_name(n) not in have]
    if missing:
        raise MissingColumns(missing, where)
    return df


def upper_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.upper() for c in df.columns])
