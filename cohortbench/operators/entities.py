"""Which entities take part, and how they are described."""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortbench.sinks.exports import EmptyExport
from cohortbench.sources.headers import clean_name, require_columns
from cohortbench.sources.warehouse import latest_year_rows

log = logging.getLogger("cohortbench")

def distinct_ids(df: DataFrame, key: str) -> DataFrame:
    return df.select(key).where(F.col(key).isNotNull()).distinct()


def qualify_any_year(
    directory: DataFrame,
    key: str,
    year: str,
    qualifies: Column,
    current: Column,
    newest: DataFrame | None = None,
) -> DataFrame:
    """Latest directory rows of entities that qualify in at least one year.

    One year's rename or reclassification does not drop an entity, but it must
    be current in the newest directory year. The newest year is that of the
    whole directory, before `current` is applied. Where the directory is itself
    computed, `newest` may give its newest rows from a cheaper plan.
    """
    ids = distinct_ids(directory.where(qualifies), key)
    latest = latest_year_rows(directory, year) if newest is None else newest
    return latest.where(current).join(ids, key, "left_semi")


def qualify_in_one_pass(
    directory: DataFrame,
    key: str,
    year: str,
    newest: Column,
    qualifies: Column,
    current: Column,
    described: list[str],
) -> DataFrame:
    """The result of qualify_any_year from one reading of the directory, which must hold a year of an entity once.

    Whether any year qualifies, and the columns of the newest year, are conditional aggregates of one
    group per entity. Null keys never qualify.
    """
    at = F.col(year) == newest
    found = directory.where(F.col(key).isNotNull()).groupBy(key).agg(
        F.bool_or(qualifies).alias("_qualifies"),
        F.bool_or(at & current).alias("_current"),
        *[F.max(F.when(at, F.col(c))).alias(c) for c in [year, *described]],
    )
    return found.where("_qualifies and _current").select(key, year, *described)


def restrict(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Keep rows of the id set; a relation without the key passes whole.

    No broadcast hint: Catalyst broadcasts the ids when their size allows.
    Restrict aggregates rather than their input. While the ids fit a broadcast,
    Catalyst moves the semi join below the aggregate, ahead of the shuffle; when
    they do not, it is the few aggregated rows that are shuffled, not the rows of
    a key that may hold a third of the fact.
    """
    actual = {clean_name(c): c for c in df.columns}.get(clean_name(key))
    if actual is None:
        log.warning("no column %s, relation passes unfiltered", key)
        return df
    keys = ids.select(F.col(key).alias("_id"))
    return df.join(keys, df[actual] == keys["_id"], "left_semi")


def landing_filter(directory: DataFrame, required: list[str], keep: Column) -> DataFrame:
    """Broad first cut of the directory; missing columns are an error."""
    return require_columns(directory, required).where(keep)


def landing_ids(directory: DataFrame, key: str, required: list[str], keep: Column) -> DataFrame:
    """Ids that pass the landing filter in any year; none at all is an error."""
    ids = distinct_ids(landing_filter(directory, [key, *required], keep), key)
    if ids.isEmpty():
        raise EmptyExport("no entity passes the landing filter; everything after would be empty")
    return ids


def ids_per_year(directory: DataFrame, key: str, year: str) -> DataFrame:
    """Unique ids per year, counted over pre-aggregated (year, id) pairs."""
    pairs = directory.select(year, key).where(F.col(key).isNotNull()).distinct()
    return pairs.groupBy(year).agg(F.count(F.lit(1)).alias("entities"))


def attach(entities: DataFrame, *frames: DataFrame, key: str) -> DataFrame:
    """Left joins that keep one row per entity; each frame must be unique on the key."""
    for frame in frames:
        entities = entities.join(frame, key, "left")
    return entities


def select_names(df: DataFrame, names: list[str], column: str) -> DataFrame:
    """Rows of a chosen list of names, by a semi join however long the list is."""
    chosen = df.sparkSession.createDataFrame([(n,) for n in names], f"`{column}` string")
    return df.join(chosen, column, "left_semi")


def search_names(df: DataFrame, term: str, column: str) -> DataFrame:
    """Distinct names holding the term, any case, in name order."""
    hit = F.lower(F.col(column)).contains(term.lower())
    return df.where(hit).select(column).distinct().orderBy(column)


def distinct_sorted(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct().orderBy(column)
