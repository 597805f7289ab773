"""Versions of tables: all or nothing, pinned readers, conflicts, removal."""

import pytest
from pyspark.sql import functions as F

from cohortbench.sinks.snapshots import WHOLE, Conflict, Store

SHAPE = "id long, v string, YEAR int"


def rows(spark, *cells):
    return spark.createDataFrame(list(cells), SHAPE)


def seen(store, version=None):
    found = store.read(version or store.current(), "t", SHAPE).select("id", "v", "YEAR").collect()
    return sorted(map(tuple, found), key=str)


@pytest.fixture
def store(spark, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    assert store.current().number == 0 and seen(store) == []
    change = store.begin()
    change.write_years("t", rows(spark, (1, "a", 2020), (2, "b", 2021)), [2020, 2021, 2022], "YEAR")
    assert seen(store) == [] and seen(store, change.pending()) == [(1, "a", 2020), (2, "b", 2021)]
    assert change.commit({"by": "test"}).number == 1
    return store


def test_a_change_is_seen_whole_or_not_at_all(spark, store):
    first = store.current()
    assert first.rows("t") == {2020: 1, 2021: 1, 2022: 0} and first.notes == {"by": "test"}
    change = store.begin()
    change.write_years("t", rows(spark, (3, None, 2021), (4, "d", 2021)), [2021], "YEAR")
    change.write_whole("u", spark.range(3))
    assert seen(store) == [(1, "a", 2020), (2, "b", 2021)]
    change.commit()
    assert seen(store) == [(1, "a", 2020), (3, None, 2021), (4, "d", 2021)]
    assert store.current().tables["u"][WHOLE].rows == 3 and store.current().notes == {"by": "test"}
    assert seen(store, first) == [(1, "a", 2020), (2, "b", 2021)] == seen(store, store.version(1))


def test_a_year_may_become_empty_or_go(spark, store):
    change = store.begin()
    change.write_years("t", rows(spark).limit(0), [2020], "YEAR")
    change.commit()
    assert seen(store) == [(2, "b", 2021)] and store.current().rows("t") == {2020: 0, 2021: 1, 2022: 0}
    change = store.begin()
    change.drop_years("t", [2020, 2021, 2030])
    change.commit()
    assert seen(store) == [] and store.current().rows("t") == {2022: 0}


def test_of_two_changes_that_began_together_the_later_fails(spark, store):
    one, two = store.begin(), store.begin()
    for change, name in ((one, "one"), (two, "two")):
        change.write_years("t", rows(spark, (9, name, 2020)), [2020], "YEAR")
    one.commit()
    with pytest.raises(Conflict):
        two.commit()
    assert seen(store) == [(2, "b", 2021), (9, "one", 2020)]
    assert not [n for n, _ in store.files.listed(f"{store.root}/manifests") if n.endswith("draft")]


def test_only_the_folders_of_the_years_are_read(spark, store):
    found = store.read(store.current(), "t", SHAPE, [2021])
    assert [r.id for r in found.collect()] == [2]
    assert all("YEAR=2021" in f for f in found.inputFiles())
    assert store.read(store.current(), "t", SHAPE).where("YEAR = 2020").agg(F.max("id")).first()[0] == 1


def test_vacuum_keeps_what_a_manifest_names_and_what_is_young(spark, store):
    for i in range(3):
        change = store.begin()
        change.write_years("t", rows(spark, (i, "x", 2020)), [2020], "YEAR")
        change.commit()
    dead = store.begin()
    dead.write_years("t", rows(spark, (7, "never", 2021)), [2021], "YEAR")
    assert store.vacuum(keep=1) == []
    removed = store.vacuum(keep=1, older_than=0)
    assert len(removed) == 4  # one year of the first change, two later ones, and the dead one
    assert store.numbers() == [4] and seen(store) == [(2, "b", 2021), (2, "x", 2020)]
