"""Counts, rates, gaps and means as Column expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

COUNT = "decimal(10,0)"
MONEY_TOTAL = "decimal(12,0)"
RATE = "decimal(10,2)"


def published_count(c: Column) -> Column:
    return c.cast(COUNT)


def published_rate(c: Column) -> Column:
    return c.cast(RATE)


def whole(c: Column) -> Column:
    """A count as bigint, half away from zero.

    Summing bigint keeps the aggregate buffer one machine word wide, whereas
    sum(decimal(10,0)) needs a 20-digit decimal for every partial result.
    """
    return c.cast(COUNT).cast("bigint")


def whole_double(x: Column) -> Column:
    """A double as bigint, half away from zero, in machine arithmetic.

    For the widest scans: going through a decimal builds an object per row. The
    fraction x - trunc(x) is exact, so 0.49999999999999994 stays below a half.
    """
    part = x.cast("bigint")
    return F.when(F.abs(x - part) >= 0.5, part + F.signum(x).cast("bigint")).otherwise(part)


def scaled_round(x: Column, digits: int) -> Column:
    """Round by scaling, rounding to a whole number and scaling back.

    Spark's round(double, n) rounds the printed decimal instead, and the two
    disagree at halves that a double cannot hold (0.3 / 12.0 is 0.03 here).
    """
    if digits == 0:
        return F.round(x)
    factor = F.lit(float(10**digits))
    return F.round(x * factor) / factor


def ratio(numerator: Column, denominator: Column, digits: int = 2) -> Column:
    """numerator / denominator in doubles; null for a null or zero denominator."""
    return scaled_round(
        numerator.cast("double") / F.nullif(denominator.cast("double"), F.lit(0.0)), digits
    )


def safe_pct(part: Column, total: Column, digits: int = 1) -> Column:
    return ratio(part.cast("double") * 100.0, total, digits)


def success_rate(completers: Column, transfers: Column, cohort: Column) -> Column:
    """Missing transfers count as none; missing completers leave the rate unknown."""
    return safe_pct(completers + or_zero(transfers), cohort)


def blended_rate(parts: Iterable[tuple[Column, Column]]) -> Column:
    """Rate over several (kept, cohort) parts, where a missing part weighs nothing."""
    kept, cohort = F.lit(0), F.lit(0)
    for part_kept, part_cohort in parts:
        kept = kept + or_zero(part_kept)
        cohort = cohort + or_zero(part_cohort)
    return safe_pct(kept, cohort)


def or_zero(c: Column) -> Column:
    return F.coalesce(c, F.lit(0))


def rate_gap(reference_rate: Column, group_rate: Column) -> Column:
    """Reference rate minus group rate, both already rounded.

    Positive: the reference group does better. Zero: parity. The decimal cast
    comes before any threshold, since 17.4 - 7.4 is below 10 in doubles.
    """
    return published_rate(reference_rate - group_rate)


def mean_of(c: Column, scale: int, digits: int | None = None) -> Column:
    """Mean of a column held to `scale` digits, as one double division.

    The sum runs over unscaled bigints: exact, independent of order, and the only
    rounding is that of the quotient. Doubles are read as the decimals they print as,
    since 0.29 * 100 is below 29 in doubles. Nulls are skipped; no values: null.
    """
    unit = 10**scale
    total = F.sum((c.cast(f"decimal(28,{scale})") * F.lit(unit)).cast("bigint")).cast("double")
    count = F.nullif(F.count(c), F.lit(0))
    mean = total / (count * F.lit(unit)).cast("double")
    return mean if digits is None else scaled_round(mean, digits)
