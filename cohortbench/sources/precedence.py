"""Base releases win over their revised companions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: mark of a revised file in its name.
REVISED_MARK = "_rv"


def is_revised(source: Column) -> Column:
    return F.lower(source).contains(REVISED_MARK)


def release_order(source: Column) -> Column:
    """Sort key: base before revised, then by lower-case name."""
    return F.struct(is_revised(source).alias("revised"), F.lower(source).alias("name"))


def preferred_file(names: list[str]) -> str:
    """The file to read when a release ships several."""
    base = [n for n in names if REVISED_MARK not in n.lower()]
    return min(base or names, key=str.lower)


def preferred_rows(df: DataFrame, keys: list[str], source: str) -> DataFrame:
    """One row per key, taken from the preferred source.

    An aggregate rather than a ranking window: each task keeps one candidate per
    key before the shuffle, so a key with very many copies stays cheap.
    """
    rest = [c for c in df.columns if c not in keys]
    pick = F.min_by(F.struct(*rest), release_order(F.col(source)))
    return df.groupBy(*keys).agg(pick.alias("_row")).select(*keys, "_row.*")


def layered(releases: list[DataFrame], keys: list[str]) -> DataFrame:
    """Rows of the first release, and of each later one the rows whose key no earlier one has.

    The result of preferred_rows for releases that come apart and hold a key once each, without an
    aggregate: a release is only held against the keys before it.
    """
    out, known = releases[0], releases[0].select(*keys)
    for release in releases[1:]:
        fresh = release.join(known, keys, "left_anti")
        out = out.unionByName(fresh)
        known = known.union(fresh.select(*keys))
    return out
