"""Roll-ups of a stored cube against direct aggregates."""

import itertools

import pytest
from pyspark.sql import functions as F

from cohortbench.functions import rates
from cohortbench.operators import cube, datasets

MEASURES = {
    "entities": cube.Entities(), "rate": cube.Mean("r", 2), "units": cube.Total("n"),
}
BY = ["size", "place", "year"]


@pytest.fixture(scope="module")
def star(spark):
    # Keys far apart, one entity without facts, facts without an entity, null dimensions and values.
    dim = spark.range(1, 200).select(
        (F.col("id") * 1_000_003).alias("k"), F.when(F.col("id") % 5 > 0, F.col("id") % 3).alias("size"),
        F.concat(F.lit("p"), (F.col("id") % 4).cast("string")).alias("place"))
    fact = spark.range(3000).select(
        ((F.col("id") % 210) * 1_000_003).alias("k"), (2000 + F.col("id") % 7).cast("int").alias("year"),
        F.when(F.col("id") % 9 > 0, (F.col("id") % 1001) / 10).cast("decimal(10,2)").alias("r"), (F.col("id") % 13).alias("n"))
    return dim, fact


@pytest.fixture(scope="module")
def stored(spark, star, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("cube") / "c")
    cube.cells(*star, "k", BY, MEASURES).write.parquet(path)
    return spark.read.parquet(path)


def rows(df, by):
    return sorted((tuple(r) for r in df.select(*by, *MEASURES).collect()), key=str)


@pytest.mark.parametrize("by", [list(c) for n in range(4) for c in itertools.combinations(BY, n)])
def test_any_subset_equals_the_direct_aggregate(star, stored, by):
    dim, fact = star
    direct = {"entities": F.countDistinct("k"), "rate": rates.mean_of(F.col("r"), 2), "units": F.sum("n")}
    want = datasets.star_measures(dim, fact, "k", by, direct)
    assert rows(cube.answer(stored, by, MEASURES), by) == rows(want, by)


def test_filters_on_dimensions(star, stored):
    dim, fact = star
    where = F.col("year").isin(2001, 2003) & (F.col("place") == "p1")
    got = rows(cube.answer(stored, ["size"], MEASURES, where), ["size"])
    direct = {"entities": F.countDistinct("k"), "rate": rates.mean_of(F.col("r"), 2), "units": F.sum("n")}
    want = datasets.star_measures(dim.where("place = 'p1'"), fact.where("year in (2001, 2003)"), "k", ["size"], direct)
    assert got == rows(want, ["size"])


def test_pages_of_entities(spark):
    dim = spark.range(100_000).select(F.col("id").alias("k"))
    fact = dim.select("k", F.lit(1).alias("g"), F.lit(None).cast("double").alias("r"), F.lit(1).alias("n"))
    stored = cube.cells(dim, fact.unionByName(fact), "k", ["g"], MEASURES)
    assert stored.count() == 4  # pages of 32,768 numbers
    got = cube.answer(stored, ["g"], MEASURES).first()
    assert (got.entities, got.rate, got.units) == (100_000, None, 200_000)
    assert cube.answer(stored.limit(0), [], MEASURES).first().entities == 0
