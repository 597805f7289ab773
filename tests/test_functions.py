"""Column builders on inline rows, one test per trap."""

from decimal import Decimal as D

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from cohortbench.functions import codes, display, rates, tiers
from cohortbench.plans import vocabulary as v


def one(spark, schema, row, expr):
    return spark.createDataFrame([row], schema).select(expr.alias("x")).first().x


def column(spark, schema, rows, expr):
    return [r.x for r in spark.createDataFrame(rows, schema).select(expr.alias("x")).collect()]


N, A, B = F.col("n"), F.col("a"), F.col("b")


def test_zero_and_null_cohorts_give_null(spark):
    rows = [(5, 0), (5, None), (None, 10), (5, 10)]
    assert column(spark, "a int, b int", rows, rates.safe_pct(A, B)) == [None, None, None, 50.0]


def test_decimal_division_runs_in_doubles(spark):
    schema = "a decimal(10,0), b decimal(10,0)"
    assert one(spark, schema, (D(1), D(3)), rates.ratio(A, B, 9)) == 0.333333333


def test_two_digit_rounding_scales_first(spark):
    rows = [(0.3, 12.0), (1.005, 1.0)]
    schema = "a double, b double"
    assert column(spark, schema, rows, rates.ratio(A, B)) == [0.03, 1.0]
    # What Spark's own rounding of the printed decimal would give.
    assert column(spark, schema, rows, F.round(A / B, 2)) == [0.02, 1.01]


def test_count_cast_rounds_half_away_from_zero(spark):
    rows = [(2.5,), (-2.5,), (2.4,), (None,)]
    expected = [D(3), D(-3), D(2), None]
    assert column(spark, "a double", rows, rates.published_count(A)) == expected
    assert column(spark, "a double", rows, rates.whole(A)) == [3, -3, 2, None]


def test_whole_double_agrees_with_the_decimal_cast(spark):
    values = [0.0, 0.49999999999999994, 0.5, 1.5, 2.5, -0.5, -2.5, -2.4, 4503599627370495.5, 7.0]
    rows = [(x,) for x in [*values, None]]
    got = column(spark, "a double", rows, rates.whole_double(A))
    assert got == column(spark, "a double", rows, A.cast("decimal(20,0)").cast("bigint"))


def test_count_overflow_stops_the_job(spark):
    with pytest.raises(PySparkException):
        one(spark, "a bigint", (10**10,), rates.published_count(A))


def test_missing_transfers_count_as_none(spark):
    rows = [(10, None, 40), (None, 5, 40), (10, 10, 40), (10, 10, 0)]
    got = column(spark, "a int, b int, n int", rows, rates.success_rate(A, B, N))
    assert got == [25.0, None, 50.0, None]


def test_blended_rate_and_total_treat_nulls_differently(spark):
    schema = "fk int, fc int, pk int, pc int"
    parts = [(F.col("fk"), F.col("fc")), (F.col("pk"), F.col("pc"))]
    rows = [(20, 40, None, None), (None, None, None, None), (20, 40, 10, 20)]
    assert column(spark, schema, rows, rates.blended_rate(parts)) == [50.0, None, 50.0]
    assert column(spark, schema, rows, F.col("fc") + F.col("pc")) == [None, None, 60]


def test_gap_is_cast_before_thresholds(spark):
    gap = rates.rate_gap(A, B)
    assert one(spark, "a double, b double", (17.4, 7.4), gap) == D("10.00")
    assert one(spark, "a double, b double", (17.4, 7.4), tiers.gap_severity(gap)) == (
        "Large Gap (10%+)"
    )
    assert one(spark, "a double, b double", (17.4, 7.4), (A - B) >= 10) is False
    assert one(spark, "a double, b double", (17.4, None), gap) is None


def test_every_severity(spark):
    rows = [(D("10"),), (D("9.99"),), (D("5"),), (D("0.01"),), (D("0"),), (D("-3"),), (None,)]
    assert column(spark, "a decimal(10,2)", rows, tiers.gap_severity(A)) == [
        "Large Gap (10%+)",
        "Moderate Gap (5-10%)",
        "Moderate Gap (5-10%)",
        "Small Gap (<5%)",
        "No Gap / Outperforming",
        "No Gap / Outperforming",
        "Insufficient Data",
    ]


def test_nulls_fall_to_the_last_tier(spark):
    size = tiers.size_tier("size", A, 5000, 15000)
    rows = [(4999,), (5000,), (14999,), (15000,), (None,)]
    got = column(spark, "a int", rows, size.expr)
    assert got == ["Small", "Medium", "Medium", "Large", "Large"]
    share = tiers.two_way_tier("share", A >= 40, "High", "Lower")
    assert column(spark, "a int", [(40,), (39,), (None,)], share.expr) == ["High", "Lower", "Lower"]
    flag = tiers.flag_tier("flag", A, 25)
    assert column(spark, "a int", [(25,), (24,), (None,)], flag.expr) == [True, False, False]
    assert tiers.group_bound([size, share, flag]) == 12


def test_peer_standing(spark):
    rows = [(35.0, 30.0), (25.0, 30.0), (34.9, 30.0), (None, 30.0), (30.0, None)]
    assert column(spark, "a double, b double", rows, tiers.peer_standing(A, B)) == [
        "Above Peers",
        "Below Peers",
        "At Peer Average",
        "At Peer Average",
        "At Peer Average",
    ]


def test_mean_of_decimals_skips_nulls_and_is_null_when_empty(spark):
    df = spark.createDataFrame([(D("1.10"),), (D("2.25"),), (None,)], "a decimal(10,2)")
    assert df.agg(rates.mean_of(A, 2)).first()[0] == 335 / 200
    assert df.agg(rates.mean_of(A, 2, 1)).first()[0] == 1.7
    assert df.where("a is null").agg(rates.mean_of(A, 2)).first()[0] is None


def test_mean_of_doubles_reads_them_as_printed(spark):
    df = spark.createDataFrame([(0.29,), (0.57,), (None,)], "a double")
    assert df.agg(rates.mean_of(A, 2)).first()[0] == 0.43
    whole = spark.createDataFrame([(7,), (8,)], "a bigint")
    assert whole.agg(rates.mean_of(A, 0)).first()[0] == 7.5


def test_decode_defaults_for_unknown_and_null(spark):
    rows = [(3,), (99,), (None,)]
    got = column(spark, "a int", rows, codes.decode(A, v.AWARD_LEVELS, v.UNKNOWN))
    assert got == ["Associate degree", "Unknown", "Unknown"]
    got = column(spark, "a int", rows, codes.decode(A, v.SIZE_CATEGORIES, "Not reported"))
    assert got == ["5,000 - 9,999", "Not reported", "Not reported"]


def test_several_codes_may_share_a_label(spark):
    got = column(
        spark, "a int", [(4,), (16,), (25,)], codes.decode(A, v.COHORT_TYPES, "Other cohort type")
    )
    assert got == ["Transfer-out students"] * 3


def test_locale_buckets(spark):
    rows = [(11,), (22,), (33,), (41,), (50,), (None,)]
    assert column(spark, "a int", rows, codes.bucket(A, v.LOCALE_TYPES, v.UNKNOWN)) == [
        "City", "Suburb", "Town", "Rural", "Unknown", "Unknown",
    ]
    assert column(spark, "a int", rows, codes.bucket(A, v.LOCALE_SIZES, v.UNKNOWN)) == [
        "Large", "Midsize", "Small", "Large", "Unknown", "Unknown",
    ]


def test_codes_compare_as_numbers(spark):
    rows = [("99",), ("99.0",), ("99.01",), ("x",), (None,)]
    got = column(spark, "a string", rows, codes.equals_code(A, 99))
    assert got == [True, True, False, None, None]


def test_name_contains_ignores_case(spark):
    rows = [("Alpha COMMUNITY College",), ("Beta University",), (None,)]
    got = column(spark, "a string", rows, codes.name_contains(A, ["community college", "tech"]))
    assert got == [True, False, None]


def test_display(spark):
    rows = [(12.3,), (1234.0,), (None,)]
    got = column(spark, "a double", rows, display.show_number(A, 1, "%"))
    assert got == ["12.3%", "1234.0%", "N/A"]
    rows = [(1234567,), (12,), (None,)]
    assert column(spark, "a bigint", rows, display.show_count(A)) == ["1,234,567", "12", "N/A"]
    assert display.change_label(2020, 2024) == "Change (2020-24)"


def test_vocabulary_sizes():
    counts = {f: len(columns) for f, columns in v.STAGED.items()}
    assert counts == {"hd": 69, "effy": 38, "c_a": 34, "gr": 36, "sfa": 80, "ef_d": 11}
    assert (len(v.COHORT_TYPES), len(v.COHORT_STATUSES)) == (42, 16)
    names = [name for columns in v.STAGED.values() for name, _ in columns.values()]
    assert all(name == name.lower() for name in names)
    for columns in v.STAGED.values():
        outputs = [name for name, _ in columns.values()]
        assert len(outputs) == len(set(outputs))
