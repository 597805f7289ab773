"""Code lists to labels."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F


def decode(code: Column, labels: Mapping[int, str], default: str) -> Column:
    """Label of an integer code; unknown and null codes get the default.

    The map is a literal, folded once into the generated code, so a decode adds
    neither a join nor a shuffle.
    """
    table = F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in labels.items()))
    return F.coalesce(table[code.cast("int")], F.lit(default))


def bucket(code: Column, buckets: Mapping[str, Iterable[int]], default: str) -> Column:
    """Label of the bucket whose code list holds the code."""
    out = None
    for label, codes in buckets.items():
        hit = code.isin(list(codes))
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return out.otherwise(default)


def equals_code(code: Column, value: float) -> Column:
    """Numeric comparison: '99', '99.0' and 99 are one code, other text never matches."""
    return code.try_cast("double") == F.lit(float(value))


def name_contains(name: Column, terms: Iterable[str]) -> Column:
    """Case-insensitive substring match against any of the terms."""
    out = F.lit(False)
    for term in terms:
        out = out | F.lower(name).contains(term.lower())
    return out
