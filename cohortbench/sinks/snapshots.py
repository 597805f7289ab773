"""Versioned tables: written data never changes, and one manifest put in place at the end makes a version.

A change writes its folders beside the old ones and then a manifest that names, for every table and year, the
folder and its rows. Until the manifest is there, readers see the version before; a change that dies on the way
leaves folders that no manifest names. A reader pinned to a version goes on reading the same files.

    root/manifests/0000000007.json
    root/data/<table>/change=<id>/<year column>=<year>/part-...parquet
"""

from __future__ import annotations

import json
import re
import time
import uuid
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Key of the only part of a table that is not split by year.
WHOLE = "*"


class Conflict(RuntimeError):
    """Another change was committed since this one began."""


@dataclass(frozen=True)
class Part:
    """A folder and its rows; a year known to be without rows has no folder."""

    folder: str | None
    rows: int


Parts = Mapping[str, Part]


@dataclass(frozen=True)
class Version:
    number: int = 0
    tables: Mapping[str, Parts] = field(default_factory=dict)
    #: What the writer wants to know again: settings, sources.
    notes: Mapping[str, Any] = field(default_factory=dict)

    def rows(self, table: str) -> dict[int, int]:
        """Rows of each year of a table."""
        return {int(y): p.rows for y, p in self.tables.get(table, {}).items() if y != WHOLE}

    def folders(self, table: str) -> dict[str, str | None]:
        return {y: p.folder for y, p in self.tables.get(table, {}).items()}


class Files:
    """Small files in whatever store the path names."""

    def __init__(self, spark: SparkSession, root: str):
        self._jvm = spark._jvm
        self._hadoop = self._jvm.org.apache.hadoop.fs
        self._conf = spark._jsc.hadoopConfiguration()
        self._fs = self._hadoop.Path(root).getFileSystem(self._conf)

    def listed(self, folder: str) -> list[tuple[str, float]]:
        """Names and times of change in seconds; none if there is no such folder."""
        path = self._hadoop.Path(folder)
        if not self._fs.exists(path):
            return []
        return [(s.getPath().getName(), s.getModificationTime() / 1000) for s in self._fs.listStatus(path)]

    def text(self, path: str) -> str:
        stream = self._fs.open(self._hadoop.Path(path))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def put(self, path: str, text: str) -> None:
        """Writes beside and renames, so that the file is there whole or not at all; it must not be there yet."""
        draft, target = self._hadoop.Path(f"{path}.{uuid.uuid4().hex}.draft"), self._hadoop.Path(path)
        stream = self._fs.create(draft, False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        context = self._hadoop.FileContext.getFileContext(self._fs.getUri(), self._conf)
        kind = getattr(self._hadoop, "Options$Rename")
        try:
            context.rename(self._fs.makeQualified(draft), self._fs.makeQualified(target),
                           self._jvm.java.lang.reflect.Array.newInstance(kind.NONE.getClass(), 0))
        except Py4JJavaError as error:
            self._fs.delete(draft, False)
            if "FileAlreadyExists" in error.java_exception.getClass().getName():
                raise FileExistsError(path) from None
            raise

    def remove(self, path: str) -> None:
        self._fs.delete(self._hadoop.Path(path), True)


class Store:
    """The versions of the tables below a folder. One change is committed at a time; of two that began together the later fails."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.files = Files(spark, self.root)

    def numbers(self) -> list[int]:
        names = (re.fullmatch(r"(\d{10})\.json", n) for n, _ in self.files.listed(f"{self.root}/manifests"))
        return sorted(int(m[1]) for m in names if m)

    def _manifest(self, number: int) -> str:
        return f"{self.root}/manifests/{number:010d}.json"

    def current(self) -> Version:
        """The newest version; number 0 without tables if there is none."""
        numbers = self.numbers()
        return self.version(numbers[-1]) if numbers else Version()

    def version(self, number: int) -> Version:
        found = json.loads(self.files.text(self._manifest(number)))
        tables = {t: {y: Part(p["folder"], p["rows"]) for y, p in parts.items()} for t, parts in found["tables"].items()}
        return Version(number, tables, found["notes"])

    def begin(self) -> Change:
        return Change(self, self.current())

    def read(self, version: Version, table: str, schema: str | StructType, years: Iterable[int] | None = None) -> DataFrame:
        """The table's rows in that version, ``schema`` naming all columns; only the folders of ``years`` if given."""
        wanted = None if years is None else {str(y) for y in years}
        parts = version.tables.get(table, {})
        folders = [f"{self.root}/{p.folder}" for y, p in sorted(parts.items()) if p.folder and (wanted is None or y in wanted)]
        if not folders:
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(schema).option("basePath", f"{self.root}/data/{table}").parquet(*folders)
        return rows.drop("change")

    def vacuum(self, keep: int = 2, older_than: float = 86_400) -> list[str]:
        """Removes all but the last ``keep`` manifests, then the folders that none names and that are older than so many seconds.

        The age keeps the folders of changes that are being written.
        """
        for number in self.numbers()[:-keep]:
            self.files.remove(self._manifest(number))
        named = {f"{self.root}/{p.folder}" for n in self.numbers() for parts in self.version(n).tables.values()
                 for p in parts.values() if p.folder}
        removed = []
        for table, _ in self.files.listed(f"{self.root}/data"):
            for change, written in self.files.listed(f"{self.root}/data/{table}"):
                path = f"{self.root}/data/{table}/{change}"
                used = {n for n in named if n == path or n.startswith(f"{path}/")}
                if not used and time.time() - written >= older_than:
                    self.files.remove(path)
                    removed.append(path)
                elif used and path not in used:
                    for part, _ in self.files.listed(path):
                        if f"{path}/{part}" not in used and "=" in part and time.time() - written >= older_than:
                            self.files.remove(f"{path}/{part}")
                            removed.append(f"{path}/{part}")
        return removed


class Change:
    """Tables and years written but not yet to be seen."""

    def __init__(self, store: Store, base: Version):
        self.store, self.base, self.id = store, base, uuid.uuid4().hex
        self._tables: dict[str, dict[str, Part]] = {t: dict(parts) for t, parts in base.tables.items()}
        self._notes = dict(base.notes)

    def write_years(self, table: str, rows: DataFrame, years: Iterable[int], year: str, rebalance: bool = False) -> None:
        """Rows of exactly these years, in place of those the table has of them; other years stay.

        The rows of each year are counted by the write itself.
        """
        years = list(years)
        if not years:
            return
        seen = Observation()
        counted = rows.observe(seen, *[F.count_if(F.col(year) == y).alias(str(y)) for y in years])
        if rebalance:
            counted = counted.hint("rebalance", year)
        folder = f"data/{table}/change={self.id}"
        counted.write.partitionBy(year).parquet(f"{self.store.root}/{folder}")
        parts = self._tables.setdefault(table, {})
        for y in years:
            n = seen.get[str(y)]
            parts[str(y)] = Part(f"{folder}/{year}={y}" if n else None, n)

    def write_whole(self, table: str, rows: DataFrame) -> None:
        """Rows in place of all the table has."""
        seen = Observation()
        folder = f"data/{table}/change={self.id}"
        rows.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(f"{self.store.root}/{folder}")
        self._tables[table] = {WHOLE: Part(folder, seen.get["rows"])}

    def clear(self) -> None:
        """Begins from no tables and no notes; the version before stays as it is."""
        self._tables = {}
        self._notes = {}

    def drop_years(self, table: str, years: Iterable[int]) -> None:
        for y in years:
            self._tables.get(table, {}).pop(str(y), None)

    def pending(self, notes: Mapping[str, Any] | None = None) -> Version:
        """The version as it would be committed now; for the writer's own reads."""
        return Version(self.base.number + 1, self._tables, dict(self._notes if notes is None else notes))

    def commit(self, notes: Mapping[str, Any] | None = None) -> Version:
        new = self.pending(notes)
        text = json.dumps({"tables": {t: {y: {"folder": p.folder, "rows": p.rows} for y, p in parts.items()}
                                      for t, parts in new.tables.items()}, "notes": dict(new.notes)}, sort_keys=True)
        try:
            self.store.files.put(self.store._manifest(new.number), text)
        except FileExistsError:
            raise Conflict(f"version {new.number} of {self.store.root} was committed by another change") from None
        return new
