"""Raw CSV scans: headers, null markers, types, years, encodings."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortbench.sources.headers import clean_columns

# Spellings of a missing value.
NULL_MARKERS = ("", ".", "NULL")

UTF8 = "UTF-8"
LATIN1 = "ISO-8859-1"


@dataclass(frozen=True)
class Catalogue:
    """Which years each family was published for, and where its files lie.

    Families end in different years, so each carries its own range. The template
    may name {family} and {year}.
    """

    root: str
    years: Mapping[str, Iterable[int]]
    template: str = "{family}_{year}.csv"

    def path(self, family: str, year: int) -> str:
        return f"{self.root.rstrip('/')}/{self.template.format(family=family, year=year)}"

    def files(self, family: str) -> list[tuple[int, str]]:
        return [(y, self.path(family, y)) for y in sorted(self.years[family])]


def read_text_columns(
    spark: SparkSession, paths: str | list[str], encoding: str = UTF8, multiline: bool = False
) -> DataFrame:
    """Header row read, names cleaned, every value still text.

    Types are declared later, so no inference pass runs over the data. The paths of
    one call must share a header; one that differs stops the job instead of being
    read into the wrong columns. Values with line breaks need multiline, which gives
    up splitting a file.
    """
    df = (
        spark.read.option("header", True)
        .option("encoding", encoding)
        .option("escape", '"')
        .option("multiLine", multiline)
        .option("enforceSchema", False)
        .csv(paths)
    )
    return clean_columns(df)


def null_if_marker(c: Column, markers: Iterable[str] = NULL_MARKERS) -> Column:
    return F.when(~F.trim(c).isin(list(markers)), c)


def typed_value(c: Column, type_name: str, strict: bool = True) -> Column:
    """Text to the declared type, reading whole numbers written as 327.0.

    Strict casts stop the job on text that is no number, or for a whole type no whole
    one (327.5 is not 328); otherwise it turns null.
    """
    if type_name == "string":
        return c
    cast = Column.cast if strict else Column.try_cast
    text = F.trim(c)
    if type_name in ("int", "bigint"):
        number = cast(text, "decimal(38,10)")
        read = F.when(number % 1 == 0, cast(number, type_name))
        if strict:
            broken = F.raise_error(F.concat(F.lit("not a whole number: "), c)).cast(type_name)
            read = read.when(number.isNotNull(), broken)
    else:
        read = cast(text, type_name)
        if not type_name.startswith("decimal"):
            return read
    # Nearly all cells are whole numbers as they print. They are read in machine arithmetic, without a
    # decimal object each; a cell that prints otherwise, or does not fit, takes the way above.
    plain = text.try_cast(type_name if type_name == "bigint" else "int")
    return F.when(plain.cast("string") == text, cast(plain, type_name)).otherwise(read)


def typed_cells(
    schema: Mapping[str, str], markers: Iterable[str] = NULL_MARKERS, strict: bool = True
) -> dict[str, Column]:
    """The expression of every declared column; files of one family can share them."""
    return {
        name: typed_value(null_if_marker(F.col(f"`{name}`"), markers), type_name, strict).alias(name)
        for name, type_name in schema.items()
    }


def typed_columns(
    df: DataFrame,
    schema: Mapping[str, str],
    markers: Iterable[str] = NULL_MARKERS,
    strict: bool = True,
    cells: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Exactly the declared columns, typed; a column the file lacks is null.

    cells are the typed_cells of the same schema, markers and strictness, if there already.
    """
    have = set(df.columns)
    if cells is None:
        cells = typed_cells({n: t for n, t in schema.items() if n in have}, markers, strict)
    return df.select(
        *[
            cells[name] if name in have else F.lit(None).cast(type_name).alias(name)
            for name, type_name in schema.items()
        ]
    )


def read_family(
    spark: SparkSession,
    catalogue: Catalogue,
    family: str,
    schema: Mapping[str, str],
    year_column: str = "YEAR",
    encodings: Mapping[str, str] | None = None,
    strict: bool = True,
    multiline: bool = False,
) -> DataFrame:
    """All years of a family as one relation, united by name, each stamped with its year.

    Every year is cast to the declared types first: a union of a number with a
    text column would silently pick one type and fail on the other's values.
    """
    schema = {name: t for name, t in schema.items() if name != year_column}
    encodings = encodings or {}
    cells = typed_cells(schema, strict=strict)
    yearly = []
    for year, path in catalogue.files(family):
        raw = read_text_columns(spark, path, encodings.get(path, UTF8), multiline)
        yearly.append(
            typed_columns(raw, schema, strict=strict, cells=cells).withColumn(year_column, F.lit(year))
        )
    return unite(yearly)


def unite(frames: list[DataFrame]) -> DataFrame:
    """Union by name; columns one side lacks are null; duplicate rows stay."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def encodings(spark: SparkSession, paths: list[str]) -> dict[str, str]:
    """Encoding of each path, a file or a folder of files: latin-1 unless all is valid UTF-8.

    One job over all paths. Lines are checked where they lie, so a large file is split
    over tasks, and each path is one row on the driver, however many part files it has.
    """
    if not paths:
        return {}
    checked = []
    for i, path in enumerate(paths):
        lines = spark.read.text(path)
        checked.append(lines.select(F.lit(i).alias("i"), F.is_valid_utf8("value").alias("utf8")))
    found = unite(checked).groupBy("i").agg(F.bool_and("utf8").alias("utf8")).collect()
    broken = {row.i for row in found if not row.utf8}
    return {path: LATIN1 if i in broken else UTF8 for i, path in enumerate(paths)}


def read_mixed_encodings(
    spark: SparkSession, paths: list[str], multiline: bool = False
) -> DataFrame:
    """UTF-8 where a path is valid UTF-8, latin-1 where it is not, decided per path."""
    known = encodings(spark, paths)
    groups = [(enc, sorted(p for p in paths if known[p] == enc)) for enc in (UTF8, LATIN1)]
    return unite([read_text_columns(spark, ps, enc, multiline) for enc, ps in groups if ps])
