"""Data tests and load audit. A check yields violations as a DataFrame, never an exception.

For each kind of check there is a function returning the offending rows and a
`*_summary` with one row (check_name, checked, violations), so that a clean
table still reports.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortbench.session import settled

# A year is thin below this share of the family's median, and
# only families with this many loaded years are judged.
THIN_RATIO = 0.5
THIN_MIN_YEARS = 3

# Load states.
OK = "ok"
EMPTY = "empty"
NOT_PUBLISHED = "not_published"
ERROR = "error"


def _summary(name: str, df: DataFrame, checked: Column, violations: Column) -> DataFrame:
    return df.agg(
        F.lit(name).alias("check_name"),
        F.coalesce(checked.cast("bigint"), F.lit(0)).alias("checked"),
        F.coalesce(violations.cast("bigint"), F.lit(0)).alias("violations"),
    )


def all_checks(summaries: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, summaries)


def _key_counts(df: DataFrame, keys: list[str]) -> DataFrame:
    # Null keys are not_null's business.
    present = reduce(Column.__and__, [F.col(k).isNotNull() for k in keys])
    return df.where(present).groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys held by more than one row, with their count."""
    return _key_counts(df, keys).where("copies > 1")


def unique_summary(name: str, df: DataFrame, keys: list[str]) -> DataFrame:
    """Checked: distinct keys. Violations: keys with copies."""
    return _summary(
        name, _key_counts(df, keys), F.count(F.lit(1)), F.count_if(F.col("copies") > 1)
    )


def nulls(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def not_null_summary(name: str, df: DataFrame, column: str) -> DataFrame:
    return _summary(name, df, F.count(F.lit(1)), F.count_if(F.col(column).isNull()))


def _child_counts(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    # Children are counted per key before the join, so one overloaded key is one row.
    counts = _key_counts(child, [key])
    parents = parent.select(F.col(parent_key).alias("_parent")).distinct()
    return counts.join(parents, counts[key] == parents["_parent"], "left")


def orphans(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child keys without a parent, with the number of rows behind each."""
    counts = _key_counts(child, [key])
    parents = parent.select(F.col(parent_key).alias("_parent"))
    return counts.join(parents, counts[key] == parents["_parent"], "left_anti")


def relationship_summary(
    name: str, child: DataFrame, key: str, parent: DataFrame, parent_key: str
) -> DataFrame:
    """Checked: child rows with a key. Violations: those whose key has no parent."""
    matched = _child_counts(child, key, parent, parent_key)
    lost = F.sum(F.when(F.col("_parent").isNull(), F.col("copies")))
    return _summary(name, matched, F.sum("copies"), lost)


def outside(value: Column, low: float, high: float) -> Column:
    """Not within the closed range; a null value passes."""
    return ~value.between(low, high)


def out_of_range(df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    return df.where(outside(F.col(column), low, high))


def range_summary(name: str, df: DataFrame, column: str, low: float, high: float) -> DataFrame:
    return _summary(
        name, df, F.count(column), F.count_if(outside(F.col(column), low, high))
    )


@dataclass(frozen=True)
class Unique:
    name: str
    table: str
    keys: tuple[str, ...]


@dataclass(frozen=True)
class NotNull:
    name: str
    table: str
    column: str


@dataclass(frozen=True)
class InRange:
    name: str
    table: str
    column: str
    low: float
    high: float


@dataclass(frozen=True)
class Related:
    name: str
    table: str
    key: str
    parent: str
    parent_key: str


Check = Unique | NotNull | InRange | Related


def _key_sets(table: str, checks: list[Check]) -> list[tuple[str, ...]]:
    """The keys by which a table's rows are to be counted."""
    wanted = [c.keys for c in checks if isinstance(c, Unique) and c.table == table]
    wanted += [(c.key,) for c in checks if isinstance(c, Related) and c.table == table]
    wanted += [(c.parent_key,) for c in checks if isinstance(c, Related) and c.parent == table]
    return list(dict.fromkeys(wanted))


def _profile(df: DataFrame, table: str, checks: list[Check]) -> DataFrame:
    """Of one scan: rows per key of every key set, and in one row more the counts of the checks on columns."""
    sets = _key_sets(table, checks)
    columns = [k for keys in sets for k in keys]
    columns = list(dict.fromkeys(columns))
    # Grouping sets null the columns that they leave out, so the checked values get names of their own.
    values = {c.column: f"value_{i}" for i, c in enumerate(checks) if isinstance(c, (NotNull, InRange)) and c.table == table}
    rows = df.select(*columns, *[F.col(c).alias(v) for c, v in values.items()])
    counts = [F.count(F.lit(1)).alias("copies")]
    for i, c in enumerate(checks):
        if c.table != table:
            continue
        if isinstance(c, NotNull):
            counts.append(F.count_if(F.col(values[c.column]).isNull()).alias(f"bad_{i}"))
        elif isinstance(c, InRange):
            value = F.col(values[c.column])
            counts += [F.count(value).alias(f"seen_{i}"), F.count_if(outside(value, c.low, c.high)).alias(f"bad_{i}")]
    if not columns:
        return rows.agg(F.lit(-1).cast("long").alias("set"), *counts)
    number = F.grouping_id(*columns).alias("set")
    return rows.groupingSets([*[[F.col(k) for k in keys] for keys in sets], []], *columns).agg(number, *counts)


def _set_id(table: str, checks: list[Check], keys: tuple[str, ...]) -> int:
    """What grouping_id() gives for a key set: a bit for each column that is left out, the first one highest."""
    columns = list(dict.fromkeys(k for ks in _key_sets(table, checks) for k in ks))
    return int("".join("0" if c in keys else "1" for c in columns) or "0", 2)


def run_checks(tables: Mapping[str, DataFrame], checks: Iterable[Check]) -> DataFrame:
    """check_name, checked, violations of every check, like the summaries one by one, with one scan a table.

    All that a table's checks need is counted by one aggregate over grouping sets: one set per key, one for the
    counts on columns. The profiles, a row per distinct key, are settled and the checks are read from them.
    """
    checks = list(checks)
    used = dict.fromkeys(t for c in checks for t in ([c.table, c.parent] if isinstance(c, Related) else [c.table]))
    profiles = {t: settled(_profile(tables[t], t, checks)) for t in used}

    def counted(table: str, keys: tuple[str, ...]) -> DataFrame:
        present = reduce(Column.__and__, [F.col(k).isNotNull() for k in keys])
        return profiles[table].where((F.col("set") == _set_id(table, checks, keys)) & present).select(*keys, "copies")

    summaries = []
    for i, c in enumerate(checks):
        if isinstance(c, Unique):
            rows = counted(c.table, c.keys)
            summaries.append(_summary(c.name, rows, F.count(F.lit(1)), F.count_if(F.col("copies") > 1)))
        elif isinstance(c, Related):
            parents = counted(c.parent, (c.parent_key,)).select(F.col(c.parent_key).alias("_parent"))
            child = counted(c.table, (c.key,))
            matched = child.join(parents, child[c.key] == parents["_parent"], "left")
            lost = F.sum(F.when(F.col("_parent").isNull(), F.col("copies")))
            summaries.append(_summary(c.name, matched, F.sum("copies"), lost))
        else:
            sets = _key_sets(c.table, checks)
            whole = profiles[c.table].where(F.col("set") == (_set_id(c.table, checks, ()) if sets else -1))
            seen = F.sum("copies") if isinstance(c, NotNull) else F.sum(f"seen_{i}")
            summaries.append(_summary(c.name, whole, seen, F.sum(f"bad_{i}")))
    return all_checks(summaries)


def load_status(raw_rows: Column, kept_rows: Column, error: Column | None = None) -> Column:
    """State of one (family, year): failed, never arrived, emptied by the filter, or loaded."""
    state = F.when(raw_rows.isNull(), NOT_PUBLISHED).when(kept_rows == 0, EMPTY).otherwise(OK)
    return state if error is None else F.when(error.isNotNull(), ERROR).otherwise(state)


def thin_years(
    audit: DataFrame, ratio: float = THIN_RATIO, min_years: int = THIN_MIN_YEARS
) -> DataFrame:
    """Loaded (family, year, rows) far below the median of their family.

    Families with few years or a median of zero are not judged. The audit has a
    row per family and year, so the exact median sees a handful of values.
    """
    loaded = audit.where(F.col("status") == OK).select("family", "year", "row_count")
    medians = loaded.groupBy("family").agg(
        F.median("row_count").alias("median_rows"), F.count(F.lit(1)).alias("loaded_years")
    )
    judged = medians.where((F.col("loaded_years") >= min_years) & (F.col("median_rows") > 0))
    return (
        loaded.join(judged, "family")
        .where(F.col("row_count") < F.col("median_rows") * ratio)
        .select("family", "year", "row_count", "median_rows")
    )


def load_summary(audit: DataFrame) -> DataFrame:
    """Files per state, and which they are, in (family, year) order."""
    listed = F.sort_array(F.collect_list(F.struct("family", "year")))
    names = F.transform(listed, lambda s: F.concat_ws(" ", s["family"], s["year"].cast("string")))
    return (
        audit.groupBy("status")
        .agg(F.count(F.lit(1)).alias("files"), F.array_join(names, ", ").alias("members"))
        .orderBy("status")
    )


def load_totals(audit: DataFrame, ratio: float = THIN_RATIO) -> DataFrame:
    """One row: loaded, not yet published, suspect (thin or emptied) and failed files."""
    status = F.col("status")
    counts = audit.agg(
        F.count_if(status == OK).alias("ok"),
        F.count_if(status == NOT_PUBLISHED).alias("not_published"),
        F.count_if(status == EMPTY).alias("_empty"),
        F.count_if(status == ERROR).alias("errors"),
    )
    thin = thin_years(audit, ratio).agg(F.count(F.lit(1))).scalar()
    return counts.select("ok", "not_published", (F.col("_empty") + thin).alias("suspect"), "errors")


def load_report(audit: DataFrame) -> DataFrame:
    """The audit in (family, year) order."""
    return audit.orderBy("family", "year")


def guard_row(name: str, df: DataFrame, passed: Column, seen: Column) -> DataFrame:
    """Outcome of a guard as data: its name, whether it holds and the count it saw."""
    return df.agg(
        F.lit(name).alias("guard"), passed.alias("passed"), seen.cast("bigint").alias("seen")
    )
