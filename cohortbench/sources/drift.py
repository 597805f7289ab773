"""Schema drift: what the values of each column and year are, against what is declared.

Every file is read once. A value is missing, a whole number, a fraction or text; counts of these are merged by
adding, and the narrowest type that holds all values follows from them: nothing seen, then bigint, decimal,
string. A declared type is held against the values themselves: misfits would become null, or stop a strict load.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortbench.sources.delimited import null_if_marker, typed_value, unite

# States of a column in a year.
FITS = "fits"
MISFITS = "misfits"
ABSENT = "absent"
UNDECLARED = "undeclared"


def _counts(name: str, declared: str | None, present: bool) -> Column:
    """The counts of one column as a struct."""
    n = F.count(F.lit(1))
    zero = F.lit(0).cast("bigint")
    if not present:
        cells = {"row_count": n, "missing": n, "whole": zero, "fractional": zero, "text": zero, "misfits": zero}
    else:
        value = null_if_marker(F.col(f"`{name}`"))
        number = F.trim(value).try_cast("decimal(38,10)")
        real = F.trim(value).try_cast("double")
        whole = number.isNotNull() & (number % 1 == 0)
        # Numbers beyond the decimal's digits still are numbers.
        fraction = (number.isNotNull() & (number % 1 != 0)) | (number.isNull() & real.isNotNull())
        misfit = value.isNotNull() & typed_value(value, declared, strict=False).isNull() if declared else F.lit(False)
        cells = {
            "row_count": n, "missing": F.count_if(value.isNull()), "whole": F.count_if(whole),
            "fractional": F.count_if(fraction), "text": F.count_if(value.isNotNull() & real.isNull()),
            "misfits": F.count_if(misfit),
        }
    about = [F.lit(name).alias("column_name"), F.lit(declared).cast("string").alias("declared")]
    return F.struct(*about, *[c.alias(k) for k, c in cells.items()])


def observed(whole: Column, fractional: Column, text: Column) -> Column:
    """The narrowest type that holds what was counted."""
    return F.when(text > 0, "string").when(fractional > 0, "decimal").when(whole > 0, "bigint").otherwise("none")


def drift(years: Mapping[int, DataFrame], declared: Mapping[str, str]) -> DataFrame:
    """A row per column and year of the text frames: counts, observed type, and how it stands to the declared one.

    Declared columns that a year lacks are absent there, columns that nobody declared are undeclared. One
    aggregate a year, so no file is read twice; an empty file reports its columns with no rows. No year at all is an error.
    """
    frames = []
    for year, df in years.items():
        names = [*declared, *[c for c in df.columns if c not in declared]]
        counted = df.agg(F.array(*[_counts(c, declared.get(c), c in df.columns) for c in names]).alias("all"))
        rows = counted.select(F.explode("all").alias("c")).select("c.*").withColumn("year", F.lit(year))
        here = F.col("column_name").isin(list(df.columns))
        frames.append(rows.withColumn("present", here))
    if not frames:
        raise ValueError("no years to look at")
    seen = unite(frames)
    state = (
        F.when(~F.col("present"), ABSENT)
        .when(F.col("declared").isNull(), UNDECLARED)
        .when(F.col("misfits") > 0, MISFITS)
        .otherwise(FITS)
    )
    return seen.select(
        "column_name", "year", "declared", observed(F.col("whole"), F.col("fractional"), F.col("text")).alias("observed"),
        state.alias("state"), "row_count", "missing", "whole", "fractional", "text", "misfits",
    )


def merged(report: DataFrame) -> DataFrame:
    """One row per column over all years: the type that holds them all, and the years it drifts in."""
    total = [F.sum(c).alias(c) for c in ("row_count", "missing", "whole", "fractional", "text", "misfits")]
    drifting = F.array_sort(F.collect_set(F.when(F.col("state") != FITS, F.col("year"))))
    found = report.groupBy("column_name").agg(F.max("declared").alias("declared"), drifting.alias("drifting_years"), *total)
    return found.withColumn("observed", observed(F.col("whole"), F.col("fractional"), F.col("text")))
