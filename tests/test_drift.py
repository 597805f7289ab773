"""Types of values by column and year against the declared ones."""

import pytest

from cohortbench.sources.drift import drift, merged

DECLARED = {"ID": "bigint", "SHARE": "decimal(4,1)", "N": "int", "NAME": "string"}


@pytest.fixture(scope="module")
def report(spark):
    def frame(rows, columns):
        return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in columns))

    years = {
        2020: frame([("1", "2.5", "7.0", "x", "u"), ("2", ".", "NULL", "5", None), (" 3 ", "99999", "7.5", None, "1e400")],
                    ["ID", "SHARE", "N", "NAME", "MORE"]),
        2021: frame([("a1", "3000000000"), ("", "1"), ("5", "1")], ["ID", "N"]),
        2022: frame([], ["ID", "SHARE", "N", "NAME"]),
    }
    return drift(years, DECLARED)


def test_counts_types_and_states(report):
    got = {(r.column_name, r.year): tuple(r)[2:] for r in report.collect()}
    assert got[("ID", 2020)] == ("bigint", "bigint", "fits", 3, 0, 3, 0, 0, 0)
    assert got[("SHARE", 2020)] == ("decimal(4,1)", "decimal", "misfits", 3, 1, 1, 1, 0, 1)
    assert got[("N", 2020)] == ("int", "decimal", "misfits", 3, 1, 1, 1, 0, 1)
    assert got[("NAME", 2020)] == ("string", "string", "fits", 3, 1, 1, 0, 1, 0)
    assert got[("MORE", 2020)][:3] == (None, "string", "undeclared")
    assert got[("ID", 2021)] == ("bigint", "string", "misfits", 3, 1, 1, 0, 1, 1)
    assert got[("N", 2021)] == ("int", "bigint", "misfits", 3, 0, 3, 0, 0, 1)
    assert got[("SHARE", 2021)] == ("decimal(4,1)", "none", "absent", 3, 3, 0, 0, 0, 0)
    assert got[("NAME", 2022)] == ("string", "none", "fits", 0, 0, 0, 0, 0, 0)
    assert len(got) == 13


def test_years_merge_to_the_type_that_holds_all(report):
    got = {r.column_name: r for r in merged(report).collect()}
    assert (got["ID"].observed, got["ID"].drifting_years) == ("string", [2021])
    assert (got["N"].observed, got["N"].misfits, got["N"].drifting_years) == ("decimal", 2, [2020, 2021])
    assert got["MORE"].declared is None and got["NAME"].drifting_years == [2021]


def test_no_year_is_an_error():
    with pytest.raises(ValueError):
        drift({}, DECLARED)
