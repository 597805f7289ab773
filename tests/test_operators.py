"""Entity selection, coded aggregates, merging, peers, equity, dashboard rows."""

from decimal import Decimal as D

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from cohortbench.functions.rates import safe_pct
from cohortbench.functions.tiers import two_way_tier
from cohortbench.operators import coded, combine, datasets, entities, equity, peers
from cohortbench.sinks.exports import EmptyExport
from cohortbench.sources.headers import MissingColumns

K, CODE, M = F.col("k"), F.col("code"), F.col("m")


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


# --- entities ----------------------------------------------------------------


def directory(spark):
    return spark.createDataFrame(
        [
            # 1 qualifies by its first name only, and is current
            (1, 2020, "TX", 1, 1, "Old Community College", 1),
            (1, 2021, "TX", 1, 1, "New City College", 1),
            # 2 qualifies always but is inactive in the newest year
            (2, 2020, "TX", 4, 1, "Two", 1),
            (2, 2021, "TX", 4, 1, "Two", 2),
            # 3 qualifies through a rule although other inputs are null
            (3, 2021, "TX", None, 1, "Three Technical College", 1),
            # 4 has no row in the newest year
            (4, 2020, "TX", 4, 1, "Four", 1),
            # 5 never qualifies: null control
            (5, 2021, "TX", None, None, "Five Community College", 1),
            # 6 moved out of state
            (6, 2020, "TX", 4, 1, "Six", 1),
            (6, 2021, "OK", 4, 1, "Six", 1),
        ],
        "k int, year int, state string, sector int, control int, name string, active int",
    )


def test_qualify_on_any_year_describe_by_latest(spark):
    qualifies = (F.col("state") == "TX") & (
        (F.col("sector") == 4)
        | ((F.col("control") == 1) & F.lower("name").contains("community college"))
        | ((F.col("control") == 1) & F.lower("name").contains("technical college"))
    )
    current = (F.col("state") == "TX") & (F.col("active") == 1)
    got = entities.qualify_any_year(directory(spark), "k", "year", qualifies, current)
    assert rows(got, "k", "name") == [(1, "New City College"), (3, "Three Technical College")]


def test_landing_and_restriction(spark):
    df = directory(spark)
    keep = (F.col("state") == "TX") & F.col("sector").isin(1, 4)
    ids = entities.landing_ids(df, "k", ["state", "sector"], keep)
    assert rows(ids, "k") == [(1,), (2,), (4,), (6,)]
    other = spark.createDataFrame([(1, "a"), (1, "b"), (3, "c"), (None, "d")], "K int, v string")
    assert rows(entities.restrict(other, ids, "k"), "v") == [("a",), ("b",)]
    keyless = spark.createDataFrame([("a",)], "v string")
    assert entities.restrict(keyless, ids, "k") is keyless
    assert rows(entities.ids_per_year(df.where(keep), "k", "year"), "year", "entities") == [
        (2020, 4),
        (2021, 2),
    ]
    with pytest.raises(MissingColumns, match="gone"):
        entities.landing_ids(df, "k", ["gone"], keep)
    with pytest.raises(EmptyExport):
        entities.landing_ids(df, "k", ["state"], F.col("state") == "ZZ")


def test_attach_keeps_one_row_per_entity(spark):
    base = spark.createDataFrame([(1,), (2,)], "k int")
    a = spark.createDataFrame([(1, 10)], "k int, a int")
    b = spark.createDataFrame([(2, 20)], "k int, b int")
    assert rows(entities.attach(base, a, b, key="k"), "k", "a", "b") == [
        (1, 10, None),
        (2, None, 20),
    ]


def test_selection_by_short_and_long_lists(spark):
    df = spark.createDataFrame([(f"n{i}",) for i in range(300)], "name string")
    assert entities.select_names(df, ["n1", "n7", "zz"], "name").count() == 2
    long = [f"n{i}" for i in range(250)]
    assert entities.select_names(df, long, "name").count() == 250
    assert [r.name for r in entities.search_names(df, "N29", "name").collect()] == (
        ["n29"] + [f"n{i}" for i in range(290, 300)]
    )
    years = spark.createDataFrame([(2021,), (2020,), (2021,)], "year int")
    assert [r.year for r in entities.distinct_sorted(years, "year").collect()] == [2020, 2021]


# --- coded facts ----------------------------------------------------------------


def test_absent_codes_sum_to_zero_but_have_no_value(spark):
    df = spark.createDataFrame([(1, 5, 10), (1, 5, 3), (2, 6, 4)], "k int, code int, m int")
    got = df.groupBy("k").agg(
        coded.sum_of_codes(CODE, [5], M).alias("s"),
        coded.value_of_code(CODE, 5, M).alias("v"),
        coded.sum_where(CODE == 5, M).alias("w"),
    )
    assert rows(got, "k", "s", "v", "w") == [(1, 13, 10, 13), (2, 0, None, None)]


def test_preferred_code_falls_back_per_measure(spark):
    df = spark.createDataFrame(
        [(1, 29, 100, None), (1, 2, 90, 9), (2, 2, 50, 5), (3, 7, 1, 1)],
        "k int, code int, total int, part int",
    )
    got = df.groupBy("k").agg(
        coded.preferred_value(CODE, 29, 2, F.col("total")).alias("total"),
        coded.preferred_value(CODE, 29, 2, F.col("part")).alias("part"),
    )
    assert rows(got, "k", "total", "part") == [(1, 100, 9), (2, 50, 5), (3, None, None)]


def test_conditional_aggregates_shuffle_once(spark):
    df = spark.range(100).select(
        (F.col("id") % 7).alias("k"), (F.col("id") % 3).alias("code"), F.col("id").alias("m")
    )
    got = df.groupBy("k").agg(*[coded.value_of_code(CODE, c, M).alias(f"c{c}") for c in range(3)])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


# --- merging -----------------------------------------------------------------


def metric_frames(spark):
    a = spark.createDataFrame([(1, 2020, 5), (1, 2021, None)], "k int, year int, a int")
    b = spark.createDataFrame([(1, 2020, D("1.50")), (2, 2020, D("2.00"))], "k int, year int, b decimal(10,2)")
    c = spark.createDataFrame([(3, 2021, 7)], "k int, year int, c int")
    return [a, b, c]


def test_spine_join_and_merge_agree(spark):
    frames = metric_frames(spark)
    expected = [
        (1, 2020, 5, D("1.50"), None),
        (1, 2021, None, None, None),
        (2, 2020, None, D("2.00"), None),
        (3, 2021, None, None, 7),
    ]
    columns = ["k", "year", "a", "b", "c"]
    assert rows(combine.join_on_spine(frames, ["k", "year"]), *columns) == expected
    assert rows(combine.merge_on_key(frames, ["k", "year"]), *columns) == expected
    assert rows(combine.key_spine(frames, ["k", "year"]), "k", "year") == [
        r[:2] for r in expected
    ]


def test_merge_adds_no_shuffle(spark):
    base = spark.range(1000).select((F.col("id") % 50).alias("k"), "id")
    a = base.groupBy("k").agg(F.sum("id").alias("a"))
    b = base.groupBy("k").agg(F.max("id").alias("b"))
    plan = combine.merge_on_key([a, b], ["k"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2


def test_merge_stops_at_a_key_twice_in_a_model(spark):
    a = spark.createDataFrame([(1, 10), (2, 20), (None, 30)], "k int, a int")
    b = spark.createDataFrame([(1, 1), (1, 2), (3, 3)], "k int, b int")
    assert combine.merge_on_key([a, a.select("k", F.col("a").alias("b"))], ["k"]).count() == 3
    with pytest.raises(PySparkException, match="share a key: 1"):
        combine.merge_on_key([a, b], ["k"]).collect()
    with pytest.raises(PySparkException, match="share a key"):
        combine.merge_on_key([a, b], ["k"]).select("k").collect()


def test_colocated_joins_need_no_exchange(spark, tmp_path):
    frames = [
        spark.range(100).select(F.col("id").alias("k"), (F.col("id") % 3).alias("year"), F.lit(1).alias("a")),
        spark.range(50, 200).select(F.col("id").alias("k"), (F.col("id") % 3).alias("year"), F.col("id").alias("b")),
        spark.range(5).select(F.lit(7).cast("long").alias("k"), F.col("id").alias("year"), F.col("id").alias("c")),
    ]
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = combine.join_colocated(frames, ["k", "year"], str(tmp_path), 4)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and plan.count("SortMergeJoin") == 3
        want = combine.join_on_spine(frames, ["k", "year"])
        assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_semi_join_moves_below_the_aggregate(spark):
    fact = spark.range(1000).select((F.col("id") % 50).alias("k"), "id")
    ids = spark.range(2).select(F.col("id").alias("k"))  # its size is known to be small
    counted = fact.groupBy("k").agg(F.sum("id").alias("s"))
    plan = (
        entities.restrict(counted, ids, "k")._jdf.queryExecution().optimizedPlan().toString()
    )
    assert plan.index("Aggregate") < plan.index("LeftSemi")


# --- peers -----------------------------------------------------------------


def test_peer_averages_weigh_entity_years(spark):
    dim = spark.createDataFrame(
        [(1, "x", D("40.00")), (2, "x", D("80.00")), (3, "y", None), (4, None, D("10.00"))],
        "k int, tier string, retention decimal(10,2)",
    )
    fact = spark.createDataFrame(
        [(1, 2020, D("10.00")), (1, 2021, D("20.00")), (1, 2022, None), (2, 2020, D("60.00"))],
        "k int, year int, rate decimal(10,2)",
    )
    joined = peers.entity_years(dim, fact, "k")
    metrics = {"avg_rate": ("rate", 2, 1), "avg_retention": ("retention", 2, 1)}
    means = peers.peer_averages(joined, ["tier"], metrics, "k")
    got = rows(means.where("tier is not null"), "tier", "avg_rate", "avg_retention",
               "peer_group_count", "peer_entity_count")
    assert got == [("x", 30.0, 50.0, 4, 2), ("y", None, None, 1, 1)]

    tier = two_way_tier("tier", F.lit(True), "x", "y")
    compared = peers.peer_deltas(
        peers.attach_averages(joined, means, ["tier"], [tier]),
        {"vs": ("rate", "avg_rate")},
        ("standing", "rate", "avg_rate"),
    )
    assert rows(compared.where("k <> 3"), "k", "year", "vs", "standing") == [
        (1, 2020, -20.0, "Below Peers"),
        (1, 2021, -10.0, "Below Peers"),
        (1, 2022, None, "At Peer Average"),
        (2, 2020, 30.0, "Above Peers"),
        (4, None, None, "At Peer Average"),  # a null key finds no group
    ]
    assert compared.where("k = 4").first().peer_group_count is None
    with pytest.raises(ValueError, match="exactly the given tiers"):
        peers.attach_averages(joined, means, ["k"], [tier])


# --- equity ----------------------------------------------------------------


def equity_inputs(spark):
    dim = spark.createDataFrame([(1, D("50.00")), (2, D("0.00"))], "k int, pct decimal(10,2)")
    fact = spark.createDataFrame(
        [(1, 2020, D("10.00")), (1, 2021, D("4.00")), (1, 2022, None)],
        "k int, year int, gap decimal(10,2)",
    )
    done = spark.createDataFrame(
        [(1, 2020, 25.0), (1, 2021, 0.3)], "k int, year int, share double"
    )
    return dim, fact, done


def test_pairing_by_key_and_fan_out(spark):
    dim, fact, done = equity_inputs(spark)
    keyed = equity.pair_years(dim, fact, done, "k")
    assert rows(keyed, "k", "year", "share") == [
        (1, 2020, 25.0),
        (1, 2021, 0.3),
        (1, 2022, None),
        (2, None, None),
    ]
    fanned = equity.pair_years(dim, fact, done, "k", keyed=False)
    assert fanned.where("k = 1").count() == 6
    assert fanned.where("k = 2").count() == 1
    assert "year" not in fanned.columns


def test_both_fan_outs_agree(spark):
    dim, fact, done = equity_inputs(spark)
    one_frame = combine.merge_on_key([fact, done], ["k", "year"])
    fanned = equity.pair_all_years(
        dim, one_frame, "k", ["gap"], ["share"], F.col("share").isNotNull()
    )
    columns = ["k", "pct", "gap", "share"]
    other = equity.pair_years(dim, fact, done, "k", keyed=False)
    assert rows(fanned, *columns) == rows(other, *columns)


def test_severity_and_parity_columns(spark):
    dim, fact, done = equity_inputs(spark)
    report = equity.with_parity(
        equity.with_severity(equity.pair_years(dim, fact, done, "k"), {"severity": "gap"}),
        {"index": ("share", "pct")},
    )
    assert rows(report, "k", "year", "severity", "index") == [
        (1, 2020, "Large Gap (10%+)", 0.5),
        (1, 2021, "Small Gap (<5%)", 0.01),
        (1, 2022, "Insufficient Data", None),
        (2, None, "Insufficient Data", None),
    ]


# --- dashboard rows ----------------------------------------------------------------


def outcome_rows(spark):
    return spark.createDataFrame(
        [
            ("a", 2020, 10.0, 1.0),
            ("a", 2022, 12.5, None),
            ("b", 2020, None, 2.0),
            ("b", 2022, 30.0, 3.0),
            ("c", 2021, None, None),
        ],
        "name string, year int, rate double, gap double",
    )


def test_cards_are_null_without_values(spark):
    df = outcome_rows(spark)
    aggregates = {"n": F.countDistinct("name"), "avg": F.avg("rate"), "total": F.sum("rate")}
    got = datasets.cards(datasets.year_slice(df, 2022), aggregates).first()
    assert tuple(got) == (2, 21.25, 42.5)
    assert tuple(datasets.cards(datasets.year_slice(df, 2021), aggregates).first()) == (
        1, None, None,
    )


def test_rankings_place_nulls(spark):
    df = outcome_rows(spark)
    table = datasets.ranked_table(df, "name", "rate").select("rate").collect()
    assert [r.rate for r in table] == [30.0, 12.5, 10.0, None, None]
    bars = datasets.ranked_bars(df, "name", "rate").collect()
    assert [r.rate for r in bars] == [10.0, 12.5, 30.0]


def test_trend_order_and_focus_last(spark):
    df = outcome_rows(spark)
    points = datasets.trend(df, "name", ["rate"]).collect()
    assert [(r.name, r.year) for r in points] == [
        ("a", 2020), ("a", 2022), ("b", 2020), ("b", 2022), ("c", 2021),
    ]
    shown = datasets.with_focus(df, "name", "a").collect()
    assert [(r.name, r.is_focus) for r in shown][-2:] == [("a", 1), ("a", 1)]
    assert sum(r.is_focus for r in shown) == 2


def test_year_grid_has_every_cell(spark):
    keyed = outcome_rows(spark).withColumn("k", F.ascii("name"))
    grid = datasets.year_grid(keyed, "k", "name", "rate", [2020, 2021, 2022])
    assert rows(grid, "name", "year", "rate") == [
        ("a", 2020, 10.0), ("a", 2021, None), ("a", 2022, 12.5),
        ("b", 2020, None), ("b", 2021, None), ("b", 2022, 30.0),
        ("c", 2020, None), ("c", 2021, None), ("c", 2022, None),
    ]


def test_pivot_with_change(spark):
    df = outcome_rows(spark).withColumn("k", F.ascii("name"))
    years = [2020, 2021, 2022]
    got = datasets.pivot_with_change(df, "k", "name", "rate", years, 1)
    assert got.columns == ["k", "name", "2020", "2021", "2022", "Change (2020-22)"]
    assert sorted(tuple(r)[1:] for r in got.collect()) == [
        ("a", 10.0, None, 12.5, 2.5),
        ("b", None, None, 30.0, None),
    ]
    everyone = datasets.pivot_with_change(df, "k", "name", "rate", years, 0, drop_empty=False)
    assert everyone.count() == 3
    assert datasets.years_with_data(df, "rate") == [2020, 2022]


def test_entities_of_one_name_stay_apart(spark):
    df = spark.createDataFrame(
        [(1, "same", 2020, 1.0), (2, "same", 2020, 5.0), (1, "same", 2021, 2.0), (1, "same", 2021, 3.0)],
        "k int, name string, year int, rate double",
    )
    grid = datasets.year_grid(df, "k", "name", "rate", [2020, 2021])
    assert rows(grid, "k", "year", "rate") == [(1, 2020, 1.0), (1, 2021, 3.0), (2, 2020, 5.0), (2, 2021, None)]
    pivot = datasets.pivot_with_change(df, "k", "name", "rate", [2020, 2021], 1)
    assert sorted(tuple(r) for r in pivot.collect()) == [(1, "same", 1.0, 3.0, 2.0), (2, "same", 5.0, None, None)]


def test_long_form_scatter_and_rename(spark):
    df = outcome_rows(spark).where("year = 2022")
    long = datasets.long_by_group(df, "name", {"rate": "Rate", "gap": "Gap"}, "kind", "value")
    assert rows(long, "name", "kind", "value") == [
        ("a", "Gap", None), ("a", "Rate", 12.5), ("b", "Gap", 3.0), ("b", "Rate", 30.0),
    ]
    assert rows(datasets.scatter(df, "name", "rate", "gap"), "name", "rate", "gap") == [
        ("b", 30.0, 3.0)
    ]
    assert datasets.renamed(df, {"name": "College", "rate": "Rate"}).columns == ["College", "Rate"]


def test_star_measures(spark):
    dim = spark.createDataFrame([("a", "x"), ("b", "x"), ("c", "y")], "name string, tier string")
    got = datasets.star_measures(
        dim, outcome_rows(spark), "name", ["tier"],
        {"n": F.countDistinct("name"), "avg": F.avg("rate")},
    )
    assert rows(got, "tier", "n", "avg") == [("x", 2, 17.5), ("y", 1, None)]


def test_one_hot_key_keeps_exact_totals(spark):
    """Nine rows in ten under one key: partial aggregation leaves the sums whole."""
    df = spark.range(200_000).select(
        F.when(F.col("id") % 10 != 0, 0).otherwise(F.col("id")).alias("k"),
        (F.col("id") % 7 + 1).cast("int").alias("code"),
        F.lit(1).alias("m"),
    )
    hot = (
        df.groupBy("k")
        .agg(F.sum("m").alias("n"), coded.sum_of_codes(CODE, [1, 2], M).alias("part"))
        .where("k = 0")
        .select("n", "part", safe_pct(F.col("part"), F.col("n")).alias("pct"))
        .first()
    )
    ids = [i for i in range(200_000) if i % 10 != 0 or i == 0]
    part = sum(1 for i in ids if i % 7 + 1 in (1, 2))
    assert (hot.n, hot.part) == (len(ids), part)


def test_one_pass_gives_what_two_readings_give(spark):
    rows = [(1, 2020, True, True, "a"), (1, 2021, False, True, "b"), (2, 2021, False, True, "c"), (3, 2020, True, True, "d"),
            (4, 2020, None, True, "e"), (4, 2021, True, None, "f"), (5, 2021, True, True, None), (None, 2021, True, True, "g")]
    df = spark.createDataFrame(rows, "k int, year int, q boolean, c boolean, name string")
    two = entities.qualify_any_year(df, "k", "year", F.col("q"), F.col("c")).select("k", "year", "name")
    newest = df.select(F.max("year")).scalar()
    one = entities.qualify_in_one_pass(df, "k", "year", newest, F.col("q"), F.col("c"), ["name"])
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, two.collect())) == [(1, 2021, "b"), (5, 2021, None)]
