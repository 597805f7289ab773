"""Numbers as table text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: text of a missing number.
MISSING = "N/A"


def show_number(x: Column, decimals: int, suffix: str = "") -> Column:
    text = F.format_string(f"%.{decimals}f", x.cast("double"))
    return F.when(x.isNull(), MISSING).otherwise(F.concat(text, F.lit(suffix)))


def show_count(x: Column) -> Column:
    """Whole number with thousands separators."""
    return F.when(x.isNull(), MISSING).otherwise(F.format_number(F.round(x), 0))


def change_label(first: int, last: int) -> str:
    """Header of the first-to-last change column, such as Change (2020-24)."""
    return f"Change ({first}-{str(last)[-2:]})"
