"""Spark result against DuckDB SQL: columns, types and values, in any row order."""

from __future__ import annotations

import glob
import os

import duckdb
import pyarrow as pa


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def _sorted_rows(table: pa.Table) -> list[tuple]:
    names = sorted(table.column_names)
    columns = [table[n].to_pylist() for n in names]
    rows = zip(*columns, strict=True)
    return sorted(rows, key=lambda row: [(v is not None, str(type(v)), v) for v in row])


def difference(spark_df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """What differs, or None."""
    got = spark_df.toArrow()
    want = con.sql(sql).to_arrow_table()
    types_got = {f.name: str(f.type).replace("large_", "") for f in got.schema}
    types_want = {f.name: str(f.type).replace("large_", "") for f in want.schema}
    if types_got != types_want:
        odd = sorted(set(types_got.items()) ^ set(types_want.items()))
        return f"schema differs: {odd}"
    if got.num_rows != want.num_rows:
        return f"rows: {got.num_rows} here, {want.num_rows} expected"
    rows_got, rows_want = _sorted_rows(got), _sorted_rows(want)
    wrong = [(a, b) for a, b in zip(rows_got, rows_want, strict=True) if a != b]
    if wrong:
        return f"{len(wrong)} of {len(rows_got)} rows differ, first: {wrong[0]}"
    return None
