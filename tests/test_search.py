"""The posting index against a scan of all names."""

import pytest

from cohortbench.operators.entities import search_names
from cohortbench.operators.search import grams_of, postings, search_index, write_index

NAMES = ["Alfa College", "alfalfa", "BETA", "be", "b", "", None, "Ångström Collège", "aaa", "aaaa", "col lege", "Alfa College", "x%y_z"]


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("search") / "index")
    names = spark.createDataFrame([(n,) for n in NAMES], "name string")
    write_index(names, "name", path)
    return names, path


@pytest.mark.parametrize("term", ["alfa", "ALFA", "coll", "b", "be", "beta", "aaaa", "a", "lfal", "è", "zz", "x%y", "_", "college alfa", "l l"])
def test_same_names_as_the_scan(spark, index, term):
    names, path = index
    got = [r.name for r in search_index(spark, path, term, "name").collect()]
    assert got == [r.name for r in search_names(names, term, "name").collect()]


def test_every_name_holds_the_empty_term(spark, index):
    _, path = index
    assert {r.name for r in search_index(spark, path, "", "name").collect()} == {n for n in NAMES if n}


def test_only_the_runs_of_the_term_are_read(spark, index):
    _, path = index
    plan = search_index(spark, path, "alfa", "name")._jdf.queryExecution().executedPlan().toString()
    assert "In(gram, [alf,lfa])" in plan
    assert grams_of("Alfa") == ["alf", "lfa"] and grams_of("b") == ["b"] and grams_of("") == []
    assert postings(spark.createDataFrame([], "name string"), "name").count() == 0
