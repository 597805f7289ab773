"""Search for a part of a name through a posting index of its grams.

The index holds every run of one to three letters of a lower-cased name with the name, ordered by run, so
that a search reads the row groups of its own runs and no others. A name that holds the term holds all runs
of the term; those that do are verified by the term itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

GRAM = 3

SHAPE = "gram string, name string"


def postings(names: DataFrame, column: str) -> DataFrame:
    """gram, name of every distinct run of each distinct name; absent and empty names have none."""
    distinct = names.select(F.col(column).alias("name")).where(F.length(column) > 0).distinct()
    low = F.lower("name")

    def runs(n: int) -> Column:
        found = F.transform(F.sequence(F.lit(1), F.length(low) - n + 1), lambda i: F.substring(low, i, F.lit(n)))
        return F.when(F.length(low) >= n, found).otherwise(F.array().cast("array<string>"))

    every = F.concat(*[runs(n) for n in range(1, GRAM + 1)])
    return distinct.select(F.explode(F.array_distinct(every)).alias("gram"), "name")


def write_index(names: DataFrame, column: str, path: str) -> None:
    """Postings in ranges of runs, sorted in each file, so that a scan skips by the least and largest run."""
    found = postings(names, column)
    # The name is part of the range: a run that most names have is dealt to many files.
    found.repartitionByRange("gram", "name").sortWithinPartitions("gram", "name").write.mode("overwrite").parquet(path)


def grams_of(term: str) -> list[str]:
    """The runs a name must hold to hold the term."""
    low = term.lower()
    n = min(GRAM, len(low))
    return sorted({low[i : i + n] for i in range(len(low) - n + 1)}) if low else []


def search_index(spark: SparkSession, path: str, term: str, column: str) -> DataFrame:
    """Distinct names holding the term, any case, in name order. An empty term is held by every name in the index."""
    index = spark.read.schema(SHAPE).parquet(path)
    wanted = grams_of(term)
    if not wanted:
        names = index.where(F.length("gram") == 1).select("name").distinct()
    else:
        hits = index.where(F.col("gram").isin(wanted)).groupBy("name").agg(F.count(F.lit(1)).alias("held"))
        names = hits.where(F.col("held") == len(wanted)).where(F.contains(F.lower("name"), F.lit(term.lower())))
    return names.select(F.col("name").alias(column)).orderBy(column)
