"""Aggregates over long coded facts.

All of them are conditional aggregates meant for one groupBy(...).agg(...), so a
fact is shuffled once, after map-side partial aggregation, whatever the number
of codes; pivot() would shuffle it twice.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def sum_of_codes(code: Column, codes: Iterable[int], measure: Column) -> Column:
    """Sum under the given codes; 0, not null, when none of them occurs."""
    return F.sum(F.when(code.isin(list(codes)), measure).otherwise(F.lit(0)))


def sum_where(condition: Column, measure: Column) -> Column:
    """Sum where the condition holds; null when it never does."""
    return F.sum(F.when(condition, measure))


def value_of_code(
    code: Column, value: int, measure: Column, agg: Callable[[Column], Column] = F.max
) -> Column:
    """The measure under one code; null when the code is absent."""
    return agg(F.when(code == value, measure))


def preferred_value(
    code: Column,
    preferred: int,
    alternate: int,
    measure: Column,
    agg: Callable[[Column], Column] = F.max,
) -> Column:
    """The measure under the preferred code, else under the alternate one.

    The choice is made per measure: a group may take its total from one code
    and a subgroup from the other.
    """
    return F.coalesce(
        value_of_code(code, preferred, measure, agg), value_of_code(code, alternate, measure, agg)
    )
