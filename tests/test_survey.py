"""The survey plan end to end on small files written here."""

import csv
import shutil
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from cohortbench.operators import quality
from cohortbench.plans import dashboard, survey, surveyed
from cohortbench.sinks.exports import EmptyExport
from cohortbench.sinks.snapshots import Change, Store
from cohortbench.sources.delimited import Catalogue

HD = [
    "UNITID", "INSTNM", "CITY", "STABBR", "SECTOR", "CONTROL", "ICLEVEL", "LOCALE", "INSTSIZE",
    "C21BASIC", "HDEGOFR1", "CYACTIVE", "LATITUDE", "LONGITUD", "WEBADDR",
]


def put(root, name, header, rows, encoding="utf-8"):
    with open(root / name, "w", newline="", encoding=encoding) as handle:
        writer = csv.writer(handle)
        writer.writerow(header)
        writer.writerows(rows)


@pytest.fixture(scope="module")
def raw(tmp_path_factory):
    root = tmp_path_factory.mktemp("raw")

    def hd(unitid, name, state, sector, control, locale, size, active):
        return [unitid, name, "Town", state, sector, control, ".", locale, size, "", "NULL",
                active, 30.5, -97.25, "www"]

    put(root, "hd_2020.csv", HD, [
        hd(100, "Alpha College", "TX", 4, 1, 11, 2, 1),
        hd(200, "Beta Community College", "TX", 1, 1, 41, 9, 1),
        hd(300, "Private College", "TX", 2, 2, 11, 1, 1),
        hd(400, "Closing College", "TX", 4, 1, 12, 1, 1),
        hd(500, "Far College", "OK", 4, 1, 12, 1, 1),
        hd(600, "State University", "TX", 1, 1, 12, 1, 1),
    ])
    put(root, "hd_2021.csv", ["\ufeffUNITID ", *HD[1:]], [
        hd(100, "Alfa Collège", "TX", 4, 1, 11, 2, 1),
        hd(200, "Beta City College", "TX", 1, 1, 41, 9, 1),
        hd(400, "Closing College", "TX", 4, 1, 12, 1, 2),
        hd(600, "State University", "TX", 1, 1, 12, 1, 1),
    ], "utf-8")

    effy = ["UNITID", "EFFYALEV", "EFYTOTLT", "EFYHISPT", "EFYBKAAT", "EFYWHITT"]
    put(root, "effy_2020.csv", effy, [[200, 1, 9000, 1, 1, 1], [100, 1, 1, 1, 1, 1]])
    put(root, "effy_2021.csv", effy, [
        ["100.0", 1, "4000.0", 1000, 0, 2000], [100, 2, 3000, 1, 1, 1], [300, 1, 5, 5, 5, 5],
    ])

    sfa = ["UNITID", "UPGRNTN", "UPGRNTP", "UPGRNTT", "SCUGRAD"]
    put(root, "sfa_2020.csv", sfa, [[100, 10, 40, 123456789012, 25], [200, ".", 39, "", 20]])

    c_a = ["UNITID", "CIPCODE", "MAJORNUM", "AWLEVEL", "CTOTALT", "CTOTALM", "CTOTALW",
           "CHISPT", "CBKAAT", "CWHITT"]
    put(root, "c_a_2020.csv", c_a, [
        [100, "99", 1, 3, 40, 10, 30, 20, 4, 16],
        [100, "99", 1, 1, 5, 5, 0, 0, 0, 0],
        [100, "99", 1, 2, 7, 7, 0, 0, 0, 0],
        [100, "99", 1, 5, 2, 2, 0, 0, 0, 0],
        [100, "99", 2, 3, 900, 0, 0, 0, 0, 0],
        [100, "52.0101", 1, 3, 900, 0, 0, 0, 0, 0],
        [300, "99", 1, 3, 900, 0, 0, 0, 0, 0],
    ])
    put(root, "c_a_2021.csv", c_a, [[100, "99.0", 1, 1, 6, 6, 0, 0, 0, 0]])

    gr = ["UNITID", "GRTYPE", "CHRTSTAT", "GRTOTLT", "GRTOTLM", "GRTOTLW", "GRHISPT", "GRBKAAT",
          "GRWHITT", "LINE"]
    put(root, "gr_2020.csv", gr, [
        [100, 29, 12, 40, 20, 20, 10, "", 20, "50"],
        [100, 2, 12, 80, 20, 20, 10, 8, 20, "10"],
        [100, 30, 13, 10, 6, 4, 1, "", 10, "29A"],
        [100, 3, 13, 70, 6, 4, 1, 2, 10, "18"],
        [200, 2, 12, 0, 0, 0, 0, 0, 0, "10"],
        [200, 3, 13, 0, 0, 0, 0, 0, 0, "18"],
        [200, 4, 20, 5, 0, 0, 0, 0, 0, "20"],
        [200, 99, 20, 5, 0, 0, 0, 0, 0, "20"],
    ])

    ef_d = ["UNITID", "RET_PCF", "RET_PCP", "STUFACR ", "UGENTERN", "RRFTCTA", "RET_NMF",
            "RRPTCTA", "RET_NMP", "GRCOHRT", "PGRCOHRT"]
    put(root, "ef_d_2020.csv", ef_d, [[100, 55.0, 42.0, 12.0, 2022, 370.0, 205.0, 344, 144, 327, 16]])
    ef_d[3] = "STUFACR"
    put(root, "ef_d_2021.csv", ef_d, [
        [100, 60, ".", 13, 2000, 40, 20, "", "", 1, 1],
        [200, "", "", 15, 1000, 0, 0, 0, 0, 1, 1],
    ])
    return root


@pytest.fixture(scope="module")
def built(spark, raw, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("out"))
    years = {f: range(2020, 2022) for f in ("c_a", "effy", "hd", "ef_d")}
    catalogue = Catalogue(str(raw), {**years, "gr": [2020], "sfa": [2020, 2021]})
    audit = survey.land(spark, catalogue, f"{out}/landed")
    marts = survey.write_marts(spark, f"{out}/landed", f"{out}/marts")
    return out, audit, marts


def row(df, **keys):
    for name, value in keys.items():
        df = df.where(F.col(name) == value)
    (found,) = df.collect()
    return found


def test_audit(built):
    _, audit, _ = built
    got = {(r.family, r.year): (r.status, r.row_count) for r in audit.collect()}
    assert got == {
        ("hd", 2020): ("ok", 4),
        ("hd", 2021): ("ok", 4),
        ("effy", 2020): ("ok", 2),
        ("effy", 2021): ("ok", 2),
        ("sfa", 2020): ("ok", 2),
        ("sfa", 2021): ("not_published", 0),
        ("c_a", 2020): ("ok", 6),
        ("c_a", 2021): ("ok", 1),
        ("gr", 2020): ("ok", 8),
        ("ef_d", 2020): ("ok", 1),
        ("ef_d", 2021): ("ok", 2),
    }


def test_dimension(built):
    _, _, marts = built
    dim = marts["institution_dim"]
    assert sorted(r.unitid for r in dim.collect()) == [100, 200]
    a = row(dim, unitid=100)
    assert (a.institution_name, a.sector_name, a.locale_type) == (
        "Alfa Collège", "Public 2-year", "City",
    )
    assert (a.size_category_name, a.total_enrollment) == ("1,000 - 4,999", D(4000))
    assert (a.size_tier, a.is_hsi, a.pell_tier, a.urbanicity) == (
        "Small", True, "High Pell", "Urban/Suburban",
    )
    assert (a.pct_hispanic, a.pct_black, a.pct_pell) == (D("25.00"), D("0.00"), D("40.00"))
    assert (a.full_time_retention_rate, a.overall_retention_rate) == (D("60.00"), D("50.00"))
    b = row(dim, unitid=200)
    assert (b.institution_name, b.size_category_name) == ("Beta City College", "Not reported")
    assert (b.total_enrollment, b.size_tier, b.is_hsi) == (None, "Large", False)
    assert (b.pell_tier, b.urbanicity) == ("Lower Pell", "Town/Rural")
    assert b.overall_retention_rate is None


def test_fact(built):
    _, _, marts = built
    fact = marts["outcome_fact"]
    assert sorted((r.unitid, r.year) for r in fact.collect()) == [
        (100, 2020), (100, 2021), (200, 2020), (200, 2021),
    ]
    a = row(fact, unitid=100, year=2020)
    assert (a.total_completions, a.associate_degrees) == (D(54), D(40))
    assert (a.total_certificates, a.certificates_under_1yr, a.certificates_1_2yr) == (12, 5, 7)
    assert (a.pct_associate_hispanic, a.pct_associate_men) == (D("50.00"), D("25.00"))
    # Totals from the two-year codes; the black subgroup only exists under the others.
    assert (a.graduation_cohort_size, a.graduation_rate_150) == (D(40), D("25.00"))
    assert (a.grad_rate_black, a.grad_rate_white, a.grad_rate_hispanic) == (
        D("25.00"), D("50.00"), D("10.00"),
    )
    assert (a.equity_gap_hispanic, a.equity_gap_black) == (D("40.00"), D("25.00"))
    assert (a.transfer_out_rate, a.success_rate) == (None, D("25.00"))
    assert a.overall_retention_rate == D("48.90")  # 349 of 714
    later = row(fact, unitid=100, year=2021)
    assert (later.associate_degrees, later.pct_associate_white) == (D(0), None)
    assert (later.graduation_rate_150, later.overall_retention_rate) == (None, D("50.00"))
    b = row(fact, unitid=200, year=2020)
    assert (b.graduation_cohort_size, b.graduation_rate_150, b.success_rate) == (D(0), None, None)
    assert b.total_completions is None


def test_models_keep_their_null_rules(spark, built):
    out, _, _ = built
    retention = spark.read.parquet(f"{out}/marts/data/_retention")
    assert row(retention, unitid=100, year=2021).total_adjusted_cohort is None
    assert row(retention, unitid=100, year=2020).total_adjusted_cohort == D(714)


TABLES = ("institution_dim", "outcome_fact", "peer_report", "equity_report")


def cells(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture
def landing(spark, raw, tmp_path):
    """A copy of the raw files that a test may change, and how to land it."""
    source = tmp_path / "in"
    shutil.copytree(raw, source)
    years = {f: range(2020, 2022) for f in ("c_a", "effy", "hd", "ef_d")}
    catalogue = Catalogue(str(source), {**years, "gr": [2020], "sfa": [2020, 2021]})
    return source, catalogue, str(tmp_path / "landed"), str(tmp_path / "marts")


def replaced(source, name, **cells):
    """Gives a column of a file another value in every row."""
    lines = list(csv.reader((source / name).read_bytes().decode("utf-8-sig", "replace").splitlines()))
    names = [n.strip().upper() for n in lines[0]]
    for line in lines[1:]:
        for column, value in cells.items():
            line[names.index(column)] = value
    put(source, name, lines[0], lines[1:])


@pytest.mark.parametrize("name, column, value, years", [
    ("c_a_2020.csv", "CTOTALT", 77, {2020}),
    ("hd_2020.csv", "CITY", "Anders", set()),
    ("hd_2021.csv", "INSTNM", "Anders", {2020, 2021}),
])
def test_a_replaced_year_gives_what_a_full_build_gives(spark, landing, tmp_path, name, column, value, years):
    source, catalogue, out, marts = landing
    survey.land(spark, catalogue, out)
    survey.write_marts(spark, out, marts)
    before = Store(spark, marts).current()
    family, year = name.removesuffix(".csv").rsplit("_", 1)
    replaced(source, name, **{column: value})
    one = {f: [int(year)] for f in {family, "hd"} if f == family}
    survey.land(spark, Catalogue(str(source), one), out)
    version = Store(spark, out).current()
    assert survey.changed_years(version, before, family) == ([int(year)], [])
    files = survey.staged_family(spark, out, family, version, [int(year)]).inputFiles()
    assert files and all(f"YEAR={year}" in f for f in files)
    refreshed = survey.write_marts(spark, out, marts)
    anew = survey.write_marts(spark, out, str(tmp_path / "anew"))
    assert {t: cells(refreshed[t]) for t in TABLES} == {t: cells(anew[t]) for t in TABLES}
    after = Store(spark, marts).current()
    was, now = before.folders("outcome_fact"), after.folders("outcome_fact")
    assert {int(y) for y in now if now[y] != was.get(y)} == years
    model = next(t for t, (f, _) in survey.models(survey.Scope()).items() if f == family)
    was, now = before.folders(model), after.folders(model)
    assert {int(y) for y in now if now[y] != was[y]} == {int(year)}


def test_marts_without_a_new_landing_stay_as_they_are(spark, landing):
    _, catalogue, out, marts = landing
    survey.land(spark, catalogue, out)
    first = survey.write_marts(spark, out, marts)
    again = survey.write_marts(spark, out, marts)
    assert Store(spark, marts).numbers() == [1]
    assert {t: cells(first[t]) for t in TABLES} == {t: cells(again[t]) for t in TABLES}
    other = survey.write_marts(spark, out, marts, published_grain=True)
    assert "year" not in other["peer_report"].columns and Store(spark, marts).numbers() == [1, 2]


def test_a_landing_that_dies_changes_nothing(spark, landing, monkeypatch):
    source, catalogue, out, marts = landing
    survey.land(spark, catalogue, out)
    survey.write_marts(spark, out, marts)
    families = ("hd", "c_a", "gr")
    before = {f: cells(survey.landed(spark, out, f)) for f in families}
    pinned = Store(spark, out).current()
    for name in ("hd_2021.csv", "hd_2020.csv"):
        replaced(source, name, INSTNM="Anders")
    write, calls = Change.write_years, []

    def dies(self, table, *args, **kwargs):
        calls.append(table)
        if len(calls) == 3:
            raise OSError("the driver is gone")
        return write(self, table, *args, **kwargs)

    monkeypatch.setattr(Change, "write_years", dies)
    with pytest.raises(OSError):
        survey.land(spark, catalogue, out)
    monkeypatch.undo()
    assert calls[0] == "hd" and {f: cells(survey.landed(spark, out, f)) for f in families} == before
    assert len(Store(spark, out).vacuum(keep=2, older_than=0)) >= 2
    survey.land(spark, catalogue, out)
    assert {r.INSTNM for r in survey.landed(spark, out, "hd").collect()} == {"Anders"}
    assert {f: cells(survey.landed(spark, out, f, pinned)) for f in families} == before


def test_peer_report(built):
    _, _, marts = built
    a = row(marts["peer_report"], unitid=100, year=2020)
    assert (a.peer_group_count, a.peer_entity_count) == (2, 1)
    assert (a.peer_avg_grad_rate, a.grad_rate_vs_peers) == (25.0, 0.0)
    assert (a.peer_avg_overall_retention, a.peer_avg_associate_degrees) == (50.0, 20.0)
    assert a.grad_rate_performance == "At Peer Average"


def test_equity_report_by_key(built):
    _, _, marts = built
    report = marts["equity_report"]
    assert report.count() == 4
    a = row(report, unitid=100, year=2020)
    assert (a.hispanic_gap_severity, a.black_gap_severity) == ("Large Gap (10%+)",) * 2
    assert (a.hispanic_completion_equity_index, a.black_completion_equity_index) == (2.0, None)
    assert (a.associate_white, a.white_completion_equity_index) == (D(16), 0.8)


def test_published_grain(spark, built, tmp_path):
    out, _, _ = built
    marts = survey.write_marts(
        spark, f"{out}/landed", str(tmp_path), published_grain=True,
        names=survey.MartNames(dim="d", fact="f", peers="p", equity="e"),
    )
    assert set(marts) == {"d", "f", "p", "e"}
    assert "year" not in marts["p"].columns and "year" not in marts["e"].columns
    # 100 has two outcome years and two completion years, 200 two and none.
    assert marts["e"].where("unitid = 100").count() == 4
    assert marts["e"].where("unitid = 200").count() == 2
    assert len(marts["e"].columns) == 33 and len(marts["p"].columns) == 25
    survey.register(marts)
    assert spark.sql("SELECT count(*) FROM f JOIN d USING (unitid)").first()[0] == 4


def test_mart_checks_pass(spark, built):
    out, _, marts = built
    checks = survey.mart_checks(marts).collect()
    assert len(checks) == 9 and all(r.violations == 0 for r in checks)
    landed = survey.landed(spark, f"{out}/landed", "hd")
    directory = survey.directory_checks(landed, [2020, 2021]).collect()
    assert [(r.checked, r.violations) for r in directory] == [(4, 0)] * 4


def test_staged_columns(spark, built):
    out, _, _ = built
    hd = survey.staged_family(spark, f"{out}/landed", "hd")
    assert len(hd.columns) == 75
    a = row(hd, unitid=100, year=2020)
    assert (a.control_name, a.institution_level_name, a.locale_size) == ("Public", "Unknown", "Large")
    gr = survey.staged_family(spark, f"{out}/landed", "gr")
    odd = row(gr, unitid=200, cohort_type=99)
    assert odd.cohort_type_description == "Other cohort type"
    assert row(gr, unitid=100, cohort_type=30).survey_line == "29A"
    sfa = survey.staged_family(spark, f"{out}/landed", "sfa")
    assert row(sfa, unitid=100).all_ug_pell_total_amount == D(123456789012)
    effy = survey.staged_family(spark, f"{out}/landed", "effy")
    assert row(effy, unitid=100, student_level=2).student_level_name == "Undergraduate"


def test_unscoped_landing_keeps_everything(spark, raw, tmp_path):
    catalogue = Catalogue(str(raw), {"hd": [2020, 2021]})
    audit = survey.land(spark, catalogue, str(tmp_path), scope=None)
    assert {(r.year, r.row_count) for r in audit.collect()} == {(2020, 6), (2021, 4)}


def test_directory_without_its_columns_is_an_error(spark, tmp_path):
    put(tmp_path, "hd_2020.csv", ["UNITID", "INSTNM"], [[1, "x"]])
    put(tmp_path, "hd_2021.csv", ["UNITID", "STABBR", "SECTOR"], [[1, "TX", 4]])
    put(tmp_path, "gr_2020.csv", ["UNITID", "GRTYPE"], [[2, 29]])
    catalogue = Catalogue(str(tmp_path), {"gr": [2020], "hd": [2020, 2021]})
    audit = survey.land(spark, catalogue, str(tmp_path / "out"))
    got = {(r.family, r.year): (r.status, r.row_count) for r in audit.collect()}
    assert got == {
        ("hd", 2020): (quality.ERROR, 0),
        ("hd", 2021): (quality.OK, 1),
        ("gr", 2020): (quality.EMPTY, 0),
    }
    reasons = {r.reason for r in audit.collect() if r.status == quality.ERROR}
    assert len(reasons) == 1 and "STABBR, SECTOR" in reasons.pop()


def test_a_landing_keeps_the_years_it_has_no_file_for(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    header = ["UNITID", "STABBR", "SECTOR"]
    put(source, "hd_2020.csv", header, [[1, "TX", 4], [2, "TX", 4]])
    put(source, "hd_2021.csv", header, [[1, "TX", 4]])
    catalogue = Catalogue(str(source), {"hd": [2020, 2021]})

    def land():
        got = {r.year: (r.status, r.row_count) for r in survey.land(spark, catalogue, out).collect()}
        disk = {r.YEAR: r["count"] for r in survey.landed(spark, out, "hd").groupBy("YEAR").count().collect()}
        assert {y: n for y, (_, n) in got.items() if n} == disk
        return got

    assert land() == {2020: ("ok", 2), 2021: ("ok", 1)}
    (source / "hd_2020.csv").unlink()
    put(source, "hd_2021.csv", header, [[3, "TX", 4], [4, "TX", 4], [5, "TX", 4]])
    assert land() == {2020: ("not_published", 2), 2021: ("ok", 3)}
    put(source, "hd_2021.csv", header, [[3, "OK", 4]])
    assert land() == {2020: ("not_published", 2), 2021: ("empty", 0)}
    (source / "hd_2021.csv").unlink()
    assert land() == {2020: ("not_published", 2), 2021: ("not_published", 0)}


def test_no_entity_at_all_stops_the_landing(spark, tmp_path):
    put(tmp_path, "hd_2020.csv", ["UNITID", "STABBR", "SECTOR"], [[1, "OK", 4]])
    with pytest.raises(EmptyExport):
        survey.land(spark, Catalogue(str(tmp_path), {"hd": [2020]}), str(tmp_path / "out"))


def test_dashboard_tabs(built):
    _, _, marts = built
    fact = marts["outcome_fact"]
    tabs = dashboard.tabs(fact, 2020, 2021)
    assert list(tabs) == ["overview", "graduation", "retention", "completions", "equity"]
    assert tabs["overview"]["colleges"].first().colleges == 2
    newest = tabs["overview"]["cards"].first()
    assert tuple(newest) == (None, 60.0, D(0))
    earlier = dashboard.tabs(fact, 2020, 2020, colleges=["Alfa Collège"])
    assert tuple(earlier["overview"]["cards"].first()) == (25.0, 55.0, D(40))
    assert earlier["overview"]["table"].columns[:2] == ["College", "Graduation Rate"]
    pivot = row(tabs["retention"]["table"], institution_name="Alfa Collège")
    assert (pivot["2020"], pivot["2021"], pivot["Change (2020-21)"]) == (55.0, 60.0, 5.0)
    assert tabs["graduation"]["bars"].count() == 2  # no rates in 2021
    assert tabs["retention"]["bars"].count() == 4
    assert earlier["equity"]["rates"].count() == 3
    assert tuple(earlier["equity"]["gaps"].first())[1:] == (D("40.00"), D("25.00"))
    assert earlier["equity"]["table"].columns[-1] == "Black Gap"
    assert tabs["completions"]["total_trend"].count() == 4
    present = dashboard.tabs(fact, 2020, 2030, newest_present=True)
    assert tuple(present["overview"]["cards"].first()) == (None, 60.0, D(0))


def test_star_by_dimension(built):
    _, _, marts = built
    got = dashboard.by_dimension(marts["institution_dim"], marts["outcome_fact"], ["urbanicity"])
    assert row(got, urbanicity="Urban/Suburban").colleges == 1
    assert row(got, urbanicity="Urban/Suburban").avg_graduation_rate == 25.0


def test_names_over_two_lines_are_landed_whole(spark, tmp_path):
    header = ["UNITID", "INSTNM", "STABBR", "SECTOR"]
    put(tmp_path, "hd_2020.csv", header, [[1, "Alfa\nCollege", "TX", 4], [2, 'Beta "B"', "TX", 4], [3, "x", "OK", 4]])
    put(tmp_path, "hd_2021.csv", header, [[1, "Alfa\nCollège", "TX", 4]], encoding="latin-1")
    out = str(tmp_path / "out")
    audit = survey.land(spark, Catalogue(str(tmp_path), {"hd": [2020, 2021]}), out, multiline=True)
    assert {(r.year, r.status, r.row_count) for r in audit.collect()} == {(2020, "ok", 2), (2021, "ok", 1)}
    names = {(r.YEAR, r.UNITID): r.INSTNM for r in survey.landed(spark, out, "hd").collect()}
    assert names == {(2020, 1): "Alfa\nCollege", (2020, 2): 'Beta "B"', (2021, 1): "Alfa\nCollège"}


def test_lines_meet_their_orders_once_for_all_families(spark, tmp_path):
    """Both families of lines, repeated rows included, come from the rows written beside their orders."""
    at = str(tmp_path)
    spark.sql("SELECT 1L AS o_orderkey, 3L AS o_custkey, 'F' AS o_orderstatus, 1.0D AS o_totalprice, "
              "TIMESTAMP '2020-05-01' AS o_orderdate, '1-URGENT' AS o_orderpriority").write.parquet(f"{at}/orders.parquet")
    line = "SELECT 1L AS l_orderkey, 1 AS l_linenumber, 10.0D AS l_quantity, 'A' AS l_returnflag, 'F' AS l_linestatus"
    spark.sql(f"{line} UNION ALL {line}").write.parquet(f"{at}/lineitem.parquet")
    spark.sql("SELECT 3L AS c_custkey, 'c' AS c_name, 0 AS c_nationkey").write.parquet(f"{at}/customer.parquet")
    spark.sql("SELECT 0 AS n_nationkey, 'n' AS n_name, 1 AS n_regionkey").write.parquet(f"{at}/nation.parquet")
    families = surveyed.answers(spark, at)
    for family, total in (("c_a", "CTOTALT"), ("gr", "GRTOTLT")):
        assert "Join" not in families[family]._jdf.queryExecution().optimizedPlan().toString()
        assert [(r["UNITID"], r["year"], r[total]) for r in families[family].collect()] == [(3, 2020, 20 if family == "c_a" else 10)]
