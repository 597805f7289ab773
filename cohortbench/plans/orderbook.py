"""The marts over an order book: customers as entities, order years as survey years.

    entity               customer, placed by nation and region
    year                 calendar year of the order
    coded counts         line quantities; the code is the line number, 1 to 7
    groups               return flag: A is the reference group, R and N the others
    cohort / completers  all lines / lines with status F
    retention parts      orders of priority 1-2 and 3-5; kept are those with status F
    enrollment           orders in the newest year

Line items are first summed per order and only then joined with orders, so the
join is one to one and an order with very many lines costs one row. Counts stay
bigint until published.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortbench.functions import rates as r
from cohortbench.functions.tiers import Tier, flag_tier, size_tier, two_way_tier
from cohortbench.operators.coded import sum_of_codes, sum_where
from cohortbench.operators.combine import merge_on_key
from cohortbench.operators.entities import attach
from cohortbench.operators.equity import pair_all_years, with_parity, with_severity
from cohortbench.operators.peers import (
    attach_averages,
    entity_years,
    peer_averages,
    peer_deltas,
    with_tiers,
)
from cohortbench.sources.warehouse import in_latest_year, in_years

KEYS = ["entity_id", "year"]

GROUPS = {"a": "A", "r": "R", "n": "N"}
URGENT = ("1-URGENT", "2-HIGH")
WEST = ("AMERICA", "EUROPE")

PEER_KEYS = ["size_tier", "is_flagged", "share_tier", "place_tier"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def orders(
    spark: SparkSession,
    sf_dir: str,
    window: tuple[int, int] | None = None,
    latest: bool = False,
) -> DataFrame:
    """Orders keyed by entity and year; windows reach the scan as date ranges."""
    raw = table(spark, sf_dir, "orders")
    rows = raw
    if window:
        type_name = raw.schema["o_orderdate"].dataType.simpleString()
        rows = rows.where(in_years(F.col("o_orderdate"), *window, type_name))
    if latest:
        rows = rows.where(in_latest_year(raw, "o_orderdate"))
    return rows.select(
        "o_orderkey",
        F.col("o_custkey").alias("entity_id"),
        F.year("o_orderdate").alias("year"),
        "o_orderdate",
        "o_orderstatus",
        "o_orderpriority",
        "o_totalprice",
    )


def order_years(spark: SparkSession, sf_dir: str) -> list[int]:
    """Every year from the first order's to the last one's; one row to the driver."""
    ends = table(spark, sf_dir, "orders").select(
        F.year(F.min("o_orderdate")), F.year(F.max("o_orderdate"))
    ).first()
    return [] if ends[0] is None else list(range(ends[0], ends[1] + 1))


def newest_year(spark: SparkSession, sf_dir: str) -> Column:
    """The year of the last order, as a scalar subquery."""
    return table(spark, sf_dir, "orders").select(F.year(F.max("o_orderdate"))).scalar()


def line_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coded counts as read. The count is converted here once, not in each aggregate."""
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        F.col("l_linenumber").alias("code"),
        F.col("l_returnflag").alias("member_group"),
        F.col("l_linestatus").alias("status"),
        r.whole_double(F.col("l_quantity")).alias("n"),
    )


def per_entity_year(
    spark: SparkSession, sf_dir: str, sums: dict, agg=F.sum, window=None, latest: bool = False
) -> DataFrame:
    """Line aggregates per order, then per entity-year; `agg` must compose with itself.

    With a window, or for the newest year, lines of other orders go before they are
    summed: the semi join hashes on the order key, as the sums do.
    """
    lines = line_rows(spark, sf_dir)
    keyed = orders(spark, sf_dir, window, latest).select("o_orderkey", *KEYS)
    if window or latest:
        kept = keyed.select(F.col("o_orderkey").alias("_order"))
        lines = lines.join(kept, F.col("l_orderkey") == F.col("_order"), "left_semi")
    per_order = lines.groupBy("l_orderkey").agg(*[c.alias(n) for n, c in sums.items()])
    joined = per_order.join(keyed, per_order["l_orderkey"] == keyed["o_orderkey"])
    return joined.groupBy(*KEYS).agg(*[agg(n).alias(n) for n in sums])


def line_counts(
    spark: SparkSession, sf_dir: str, window=None, latest: bool = False
) -> DataFrame:
    """All coded counts in one pass over the lines."""
    n, code = F.col("n"), F.col("code")
    group, status = F.col("member_group"), F.col("status")
    sums = {
        "total_units": F.sum(n),
        "code_1": sum_of_codes(code, [1], n),
        "code_2": sum_of_codes(code, [2], n),
        "code_3": sum_of_codes(code, [3], n),
        "codes_1_2": sum_of_codes(code, [1, 2], n),
    }
    for g, flag in GROUPS.items():
        sums[f"code_3_{g}"] = sum_of_codes(code, [3], F.when(group == flag, n).otherwise(0))
    for s, flag in {"f": "F", "o": "O"}.items():
        sums[f"code_3_{s}"] = sum_of_codes(code, [3], F.when(status == flag, n).otherwise(0))

    done = status == "F"
    subgroups = {g: group == flag for g, flag in GROUPS.items()}
    subgroups |= {"early": code <= 3, "late": code > 3}
    sums["cohort"] = F.sum(n)
    sums["completed"] = sum_where(done, n)
    sums["transferred"] = sum_where((status == "O") & (group == "N"), n)
    for name, member in subgroups.items():
        sums[f"cohort_{name}"] = sum_where(member, n)
        sums[f"completed_{name}"] = sum_where(member & done, n)
    return per_entity_year(spark, sf_dir, sums, window=window, latest=latest)


def completion_columns() -> list[Column]:
    shares = [
        r.safe_pct(F.col(f"code_3_{x}"), F.col("code_3")).alias(f"pct_{x}")
        for x in ("a", "r", "n", "f", "o")
    ]
    return ["total_units", "code_1", "code_2", "codes_1_2", "code_3", *shares]


def rate_columns() -> list[Column]:
    cohort = F.col("cohort")
    return [
        r.safe_pct(F.col("completed"), cohort).alias("grad_rate"),
        r.safe_pct(F.col("transferred"), cohort).alias("transfer_rate"),
        r.success_rate(F.col("completed"), F.col("transferred"), cohort).alias("success_rate"),
        *[
            r.safe_pct(F.col(f"completed_{x}"), F.col(f"cohort_{x}")).alias(f"rate_{x}")
            for x in ("a", "r", "n", "early", "late")
        ],
    ]


def gap_columns() -> list[Column]:
    return [
        r.rate_gap(F.col("rate_a"), F.col(f"rate_{g}")).alias(f"gap_{g}") for g in ("r", "n")
    ]


def outcome_rates(counts: DataFrame) -> DataFrame:
    return counts.select(*KEYS, "cohort", *rate_columns())


def preferred_quantities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Largest line quantity under the preferred code, else under its alternate.

    Maxima compose only per code, so codes stay apart until the last step.
    """
    n, code, flag = F.col("n"), F.col("code"), F.col("member_group")
    roles = {"cohort": (7, 1), "completers": (6, 2), "transfers": (5, 3)}
    measures = {"total": n, **{g: F.when(flag == v, n) for g, v in GROUPS.items()}}
    per_code = {
        f"{m}_{c}": F.max(F.when(code == c, expr))
        for m, expr in measures.items()
        for pair in roles.values()
        for c in pair
    }
    wide = per_entity_year(spark, sf_dir, per_code, agg=F.max)
    return wide.select(
        *KEYS,
        *[
            F.coalesce(F.col(f"{m}_{a}"), F.col(f"{m}_{b}")).alias(f"{role}_{m}")
            for role, (a, b) in roles.items()
            for m in measures
        ],
    )


def retention_counts() -> list[Column]:
    urgent = F.col("o_orderpriority").isin(*URGENT)
    kept = F.col("o_orderstatus") == "F"
    one = F.lit(1)
    return [
        F.count(one).alias("entering"),
        sum_where(urgent, one).alias("ft_cohort"),
        sum_where(urgent & kept, one).alias("ft_kept"),
        sum_where(~urgent, one).alias("pt_cohort"),
        sum_where(~urgent & kept, one).alias("pt_kept"),
    ]


def retention_rates() -> list[Column]:
    ft_kept, ft_cohort = F.col("ft_kept"), F.col("ft_cohort")
    pt_kept, pt_cohort = F.col("pt_kept"), F.col("pt_cohort")
    return [
        r.safe_pct(ft_kept, ft_cohort).alias("ft_rate"),
        r.safe_pct(pt_kept, pt_cohort).alias("pt_rate"),
        r.blended_rate([(ft_kept, ft_cohort), (pt_kept, pt_cohort)]).alias("overall_rate"),
        (ft_cohort + pt_cohort).alias("total_cohort"),
        r.ratio(F.col("entering"), ft_cohort, 2).alias("load_ratio"),
    ]


def retention(spark: SparkSession, sf_dir: str, window=None, latest: bool = False) -> DataFrame:
    counts = orders(spark, sf_dir, window, latest).groupBy(*KEYS).agg(*retention_counts())
    return counts.select("*", *retention_rates())


def entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    places = nation.join(region, nation.n_regionkey == region.r_regionkey, "left")
    placed = customer.join(places, customer.c_nationkey == places.n_nationkey, "left")
    return placed.select(
        F.col("c_custkey").alias("entity_id"),
        F.col("c_name").alias("entity_name"),
        F.col("n_name").alias("nation_name"),
        F.col("r_name").alias("region_name"),
        F.col("c_mktsegment").alias("segment"),
        F.col("c_acctbal").alias("balance"),
    )


def entity_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("entity_id"), F.col("c_name").alias("entity_name")
    )


def newest_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size, shares and retention of the newest order year, one row per active entity.

    The newest enrollment, aid and retention all come from that year's orders, so
    one aggregate serves them; unused columns are pruned.
    """
    counts = (
        orders(spark, sf_dir, latest=True)
        .groupBy("entity_id")
        .agg(
            *retention_counts(),
            F.count_if(F.col("o_orderstatus") == "F").alias("filled"),
            F.count_if(F.col("o_orderpriority").isin(*URGENT)).alias("urgent"),
        )
    )
    size = F.col("entering")
    return counts.select(
        "entity_id",
        size.alias("enrollment"),
        r.safe_pct(F.col("filled"), size).alias("pct_filled"),
        r.safe_pct(F.col("urgent"), size).alias("pct_urgent"),
        *retention_rates(),
    )


def tiers() -> list[Tier]:
    return [
        size_tier("size_tier", F.col("enrollment"), 2, 3),
        flag_tier("is_flagged", F.col("pct_filled"), 33),
        two_way_tier("share_tier", F.col("pct_urgent") >= 40, "High", "Lower"),
        two_way_tier("place_tier", F.col("region_name").isin(*WEST), "West", "Other"),
    ]


def described(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entities with their newest profile and tiers; inactive ones have neither counts nor rates."""
    placed = attach(entities(spark, sf_dir), newest_profile(spark, sf_dir), key="entity_id")
    return with_tiers(placed, tiers())


def peer_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return described(spark, sf_dir).select(
        "entity_id", "entity_name", "nation_name", "region_name", "segment",
        "enrollment", "pct_filled", "pct_urgent", *PEER_KEYS,
    )


def dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per entity: place, size, tiers, shares and newest retention."""
    published = ["pct_filled", "pct_urgent", "ft_rate", "pt_rate", "overall_rate", "load_ratio"]
    return described(spark, sf_dir).select(
        "entity_id",
        "entity_name",
        "nation_name",
        "region_name",
        "segment",
        "enrollment",
        *PEER_KEYS,
        *[r.published_rate(F.col(c)).alias(c) for c in published],
    )


FACT_COUNTS = ["total_units", "code_3", "codes_1_2", "code_1", "code_2"]
FACT_RATES = [
    "pct_a", "pct_r", "pct_n", "pct_f", "pct_o",
    "grad_rate", "transfer_rate", "success_rate",
    "rate_a", "rate_r", "rate_n", "rate_early", "rate_late",
]
FACT_GAPS = ["gap_r", "gap_n"]
RETENTION_RATES = ["ft_rate", "pt_rate", "overall_rate"]


def outcomes(spark: SparkSession, sf_dir: str, window=None, latest: bool = False) -> DataFrame:
    """Both metric models on one (entity, year) key, before names are added."""
    counts = line_counts(spark, sf_dir, window, latest)
    rated = counts.select(*KEYS, "cohort", *completion_columns(), *rate_columns())
    line_model = rated.select(
        *KEYS,
        *FACT_COUNTS,
        *[r.published_rate(F.col(c)).alias(c) for c in FACT_RATES],
        *gap_columns(),
        F.col("cohort").alias("cohort_size"),
    )
    order_model = retention(spark, sf_dir, window, latest).select(
        *KEYS,
        *[r.published_rate(F.col(c)).alias(c) for c in RETENTION_RATES],
        F.col("entering").alias("entering_size"),
    )
    return merge_on_key([line_model, order_model], KEYS, grouped=True)


def fact(spark: SparkSession, sf_dir: str, window=None, latest: bool = False) -> DataFrame:
    """One row per entity-year that has lines or orders."""
    named = outcomes(spark, sf_dir, window, latest).join(entity_names(spark, sf_dir), "entity_id")
    return named.select(
        "entity_id",
        "entity_name",
        "year",
        *FACT_COUNTS,
        *FACT_RATES,
        *FACT_GAPS,
        *RETENTION_RATES,
        "cohort_size",
        "entering_size",
    )


PEER_METRICS = {
    "peer_avg_grad_rate": ("grad_rate", 2, 1),
    "peer_avg_success_rate": ("success_rate", 2, 1),
    "peer_avg_ft_rate": ("dim_ft_rate", 2, 1),
    "peer_avg_overall_rate": ("dim_overall_rate", 2, 1),
    "peer_avg_code_3": ("code_3", 0, 0),
    "peer_avg_load_ratio": ("load_ratio", 2, 1),
}

PEER_DELTAS = {
    "grad_rate_vs_peers": ("grad_rate", "peer_avg_grad_rate"),
    "success_rate_vs_peers": ("success_rate", "peer_avg_success_rate"),
    "ft_rate_vs_peers": ("dim_ft_rate", "peer_avg_ft_rate"),
    "overall_rate_vs_peers": ("dim_overall_rate", "peer_avg_overall_rate"),
}


def peer_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entities with their fact years; retention is the entity's newest, not the year's."""
    members = dim(spark, sf_dir).select(
        "entity_id",
        "entity_name",
        *PEER_KEYS,
        F.col("ft_rate").alias("dim_ft_rate"),
        F.col("overall_rate").alias("dim_overall_rate"),
        "load_ratio",
    )
    yearly = outcomes(spark, sf_dir).select(*KEYS, "grad_rate", "success_rate", "code_3")
    return entity_years(members, yearly, "entity_id")


def peer_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    return peer_averages(peer_rows(spark, sf_dir), PEER_KEYS, PEER_METRICS, "entity_id")


def peer_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = peer_rows(spark, sf_dir)
    means = peer_averages(rows, PEER_KEYS, PEER_METRICS, "entity_id")
    compared = attach_averages(rows, means, PEER_KEYS, tiers())
    return peer_deltas(
        compared, PEER_DELTAS, ("grad_rate_performance", "grad_rate", "peer_avg_grad_rate")
    )


SEVERITIES = {"gap_r_severity": "gap_r", "gap_n_severity": "gap_n"}
PARITIES = {"parity_f": ("share_f", "pct_filled")}


def equity_report(spark: SparkSession, sf_dir: str, keyed: bool = True) -> DataFrame:
    """Outcome rates and gaps beside completion shares.

    Keyed rows take both from one pass over the lines: the outcome and the
    completion side of an entity-year are columns of the same aggregate.
    """
    members = dim(spark, sf_dir).select(
        "entity_id", "entity_name", "is_flagged", "share_tier", "pct_filled", "pct_urgent",
        F.col("overall_rate").alias("dim_overall_rate"),
    )
    counts = line_counts(spark, sf_dir)
    both = counts.select(*KEYS, "cohort", *completion_columns(), *rate_columns()).select(
        *KEYS,
        *[r.published_rate(F.col(c)).alias(c) for c in ("grad_rate", "rate_a", "rate_r", "rate_n")],
        *gap_columns(),
        F.col("cohort").alias("cohort_size"),
        F.col("pct_a").alias("share_a"),
        F.col("pct_r").alias("share_r"),
        F.col("pct_n").alias("share_n"),
        F.col("pct_f").alias("share_f"),
        F.col("code_3").alias("completions"),
    )
    spine = retention(spark, sf_dir).select(*KEYS)
    yearly = merge_on_key([both, spine], KEYS, grouped=True)
    if keyed:
        rows = members.join(yearly, "entity_id", "left")
    else:
        rows = pair_all_years(
            members,
            yearly,
            "entity_id",
            outcome=["grad_rate", "rate_a", "rate_r", "rate_n", "gap_r", "gap_n", "cohort_size"],
            completion=["share_a", "share_r", "share_n", "share_f", "completions"],
            completed=F.col("completions").isNotNull(),
        )
    return with_parity(with_severity(rows, SEVERITIES), PARITIES)


def gap_severity(spark: SparkSession, sf_dir: str) -> DataFrame:
    rated = outcome_rates(line_counts(spark, sf_dir)).select("*", *gap_columns())
    return with_severity(
        rated.select(*KEYS, "rate_a", "rate_r", "rate_n", "gap_r", "gap_n"), SEVERITIES
    )
