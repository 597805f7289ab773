"""CSV, Parquet and JSON exports with row reports."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cohortbench.functions.rates import scaled_round
from cohortbench.sources.warehouse import year_window

BOM = "\ufeff"

# Columns of the embedded chart records and their short keys.
CHART_COLUMNS = {
    "institution_name": "college",
    "year": "year",
    "graduation_rate_150": "grad_rate",
    "success_rate": "success_rate",
    "full_time_retention_rate": "retention",
    "associate_degrees": "assoc_degrees",
    "total_completions": "total_completions",
    "grad_rate_hispanic": "grad_hispanic",
    "grad_rate_black": "grad_black",
    "grad_rate_white": "grad_white",
    "equity_gap_hispanic": "gap_hispanic",
    "equity_gap_black": "gap_black",
}


class EmptyExport(ValueError):
    pass


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """Refuse to go on with nothing. Meant for written tables, where one row is cheap to find."""
    if df.isEmpty():
        raise EmptyExport(f"no rows: {what}")
    return df


def _counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    # The count rides on the write itself, so the data is not computed twice.
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def write_parquet(
    df: DataFrame, path: str, partition_by: list[str] | None = None, rebalance: bool = False
) -> int:
    """Rows written. rebalance gathers each folder's rows into files of advisory size.

    Without it every task writes a file into every folder it has rows for. AQE
    splits a folder that is too large for one task, so a big year does not end up
    in one. Raw landings skip it: their tasks read one year each already.
    """
    counted, seen = _counted(df)
    if rebalance and partition_by:
        counted = counted.hint("rebalance", *partition_by)
    writer = counted.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return seen.get["rows"]


def write_bucketed(df: DataFrame, path: str, keys: list[str], buckets: int) -> DataFrame:
    """A table hashed on the keys into buckets, one file each and sorted in it, as read back.

    The shuffle before the write deals rows as the buckets do, so that a task writes one file. Only
    the session's catalogue knows the buckets: the table is registered there under a name of its own.
    """
    name = f"bucketed_{uuid.uuid4().hex}"
    dealt = df.repartition(buckets, *keys)
    dealt.write.bucketBy(buckets, *keys).sortBy(*keys).option("path", path).format("parquet").saveAsTable(name)
    return df.sparkSession.table(name)


def write_csv(df: DataFrame, path: str, bom: bool = True, encoding: str = "UTF-8") -> int:
    """Header row, no index. The mark before the first name tells spreadsheets it is UTF-8.

    One file per partition, each with its header; a small mart is one partition.
    """
    counted, seen = _counted(df)
    if bom:
        first, *rest = counted.columns
        counted = counted.toDF(BOM + first, *rest)
    (
        counted.write.mode("overwrite")
        .option("header", True)
        .option("encoding", encoding)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    return seen.get["rows"]


def export_tables(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    outdir: str,
    fmt: str = "csv",
    only: Iterable[str] | None = None,
) -> DataFrame:
    """Write tables as csv, parquet or both; report the rows of each file set."""
    if fmt not in ("csv", "parquet", "both"):
        raise ValueError(f"unknown format {fmt!r}")
    names = list(only) if only is not None else list(tables)
    unknown = [n for n in names if n not in tables]
    if unknown:
        raise KeyError(f"unknown tables: {', '.join(unknown)}")
    report = []
    for name in names:
        if fmt in ("csv", "both"):
            rows = write_csv(tables[name], f"{outdir}/{name}.csv")
            report.append((name, "csv", rows))
        if fmt in ("parquet", "both"):
            rows = write_parquet(tables[name], f"{outdir}/{name}.parquet")
            report.append((name, "parquet", rows))
    return spark.createDataFrame(report, "table_name string, format string, row_count bigint")


def write_yearly(
    df: DataFrame, path: str, year: str = "year", rebalance: bool = False
) -> int:
    """One folder per year, so year filters skip whole folders."""
    return write_parquet(df, path, [year], rebalance)


def chart_records(
    fact: DataFrame,
    first: int,
    last: int,
    columns: Mapping[str, str] = CHART_COLUMNS,
    year: str = "year",
) -> DataFrame:
    """Only the charted columns of the window, short keys, numbers at two digits."""
    fractional = {
        f.name for f in fact.schema if f.dataType.typeName() in ("double", "float", "decimal")
    }
    out = []
    for name, key in columns.items():
        c = F.col(name)
        if name == year:
            c = c.cast("int")
        elif name in fractional:
            c = scaled_round(c.cast("double"), 2)
        out.append(c.alias(key))
    return year_window(fact, first, last, year).select(*out)


def json_records(df: DataFrame, column: str = "record") -> DataFrame:
    """One JSON object per row; missing values and those JSON has no number for are null."""
    cells = []
    for field in df.schema:
        c = F.col(f"`{field.name}`")
        if field.dataType.typeName() in ("double", "float"):
            c = F.when(~F.isnan(c) & (F.abs(c) < float("inf")), c)
        cells.append(c.alias(field.name))
    return df.select(F.to_json(F.struct(*cells), {"ignoreNullFields": "false"}).alias(column))


def publish_records(
    fact: DataFrame,
    outdir: str,
    first: int,
    last: int,
    columns: Mapping[str, str] = CHART_COLUMNS,
    year: str = "year",
) -> list[int]:
    """Chart records to outdir/records, and beside them outdir/years: their years, ascending, and their number.

    The years ride on the write of the records, so the fact is read once. The years file comes last: records
    without one are a publication that did not end. Nothing to publish is refused before anything is overwritten.
    """
    rows = require_rows(chart_records(fact, first, last, columns, year), f"nothing to publish at {outdir}")
    seen, key = Observation(), columns[year]
    counted = rows.observe(
        seen, F.count(F.lit(1)).alias("records"), F.array_sort(F.collect_set(key)).alias("years")
    )
    json_records(counted).write.mode("overwrite").text(f"{outdir}/records")
    found = seen.get
    about = fact.sparkSession.createDataFrame(
        [(list(found["years"]), found["records"])], "years array<int>, records bigint"
    )
    about.coalesce(1).write.mode("overwrite").json(f"{outdir}/years")
    return list(found["years"])


def published_years(df: DataFrame, year: str = "year") -> list[int]:
    """The years of the records, ascending, for the file that goes beside them."""
    found = df.where(F.col(year).isNotNull()).select(F.col(year).cast("int")).distinct()
    return sorted(row[0] for row in found.collect())


def write_json(df: DataFrame, path: str) -> int:
    """JSON lines; an empty result is refused before anything is overwritten."""
    counted, seen = _counted(json_records(require_rows(df, f"nothing to publish at {path}")))
    counted.write.mode("overwrite").text(path)
    return seen.get["rows"]
