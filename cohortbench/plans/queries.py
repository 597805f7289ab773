"""The registered queries: one per operator group, over the order-book universe.

Each takes (spark, sf_dir) and reads whole tables. Results are published with
bigint and double columns only, besides strings and booleans.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortbench.functions import codes, display, rates
from cohortbench.operators import cube, datasets, entities, quality, search
from cohortbench.operators.combine import join_colocated, key_spine
from cohortbench.operators.ranking import numbered
from cohortbench.plans import orderbook as ob
from cohortbench.plans import surveyed
from cohortbench.plans import vocabulary as v
from cohortbench.session import scratch_path
from cohortbench.sinks import exports
from cohortbench.sources import delimited, drift, headers, precedence, records, warehouse

Query = Callable[[SparkSession, str], DataFrame]
KEYS = ob.KEYS


def published(df: DataFrame) -> DataFrame:
    """Integers as bigint, decimals as double."""
    out = []
    for field in df.schema:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.IntegralType):
            c = c.cast("bigint")
        elif isinstance(field.dataType, T.FractionalType):
            c = c.cast("double")
        out.append(c.alias(field.name))
    return df.select(*out)


# --- sources -----------------------------------------------------------------


def raw_csv_clean_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders through a CSV with blanks and a mark in its header and three null markers."""
    raw = ob.table(spark, sf_dir, "orders")
    priority = F.col("o_orderpriority")
    price = (
        F.when(priority == "1-URGENT", ".")
        .when(priority == "2-HIGH", "NULL")
        .when(priority == "3-MEDIUM", "")
        .otherwise(F.col("o_totalprice").cast("decimal(12,2)").cast("string"))
    )
    path = scratch_path(spark, "orders-csv")
    exports.write_csv(
        raw.select(
            F.col("o_orderkey").alias("orderkey"),
            F.concat(F.col("o_custkey").cast("string"), F.lit(".0")).alias("CustKey "),
            price.alias(" totalprice"),
            F.col("o_orderstatus").alias("STATUS"),
        ),
        path,
    )
    text = headers.require_columns(
        delimited.read_text_columns(spark, path), ["ORDERKEY", "CUSTKEY", "TOTALPRICE"], "orders"
    )
    declared = {
        "ORDERKEY": "bigint",
        "CUSTKEY": "bigint",
        "TOTALPRICE": "decimal(12,2)",
        "STATUS": "string",
    }
    clean = delimited.typed_columns(text, declared)
    return published(clean.toDF("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus"))


def yearly_stamp_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One file set per year, the early ones without a priority column, united by name."""
    rows = ob.orders(spark, sf_dir).select(
        "o_orderkey", "entity_id", "year", "o_orderdate", "o_orderpriority", "o_orderstatus"
    )
    turn = F.lit("1998-01-01 00:00:00").cast(rows.schema["o_orderdate"].dataType)
    root = scratch_path(spark, "orders-yearly")
    early, late = f"{root}/early", f"{root}/late"
    for path, part in (
        (early, rows.where(F.col("o_orderdate") < turn).drop("o_orderpriority", "o_orderdate")),
        (late, rows.where(F.col("o_orderdate") >= turn).drop("o_orderdate")),
    ):
        part.hint("rebalance", "year").write.partitionBy("year").option("header", True).csv(path)
    declared = {
        "O_ORDERKEY": "bigint",
        "ENTITY_ID": "bigint",
        "O_ORDERPRIORITY": "string",
        "O_ORDERSTATUS": "string",
    }
    years = exports.published_years(rows)
    families = [
        delimited.read_family(
            spark,
            delimited.Catalogue(path, {"orders": published_years}, "year={year}"),
            "orders",
            declared,
        )
        for path, published_years in (
            (early, [y for y in years if y < 1998]),
            (late, [y for y in years if y >= 1998]),
        )
        if published_years
    ]
    united = delimited.unite(families)
    return published(united.toDF(*[c.lower() for c in united.columns]))


def source_precedence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base release: all but pending orders. Revised release: all but open ones, repriced."""
    rows = ob.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    base = rows.where("o_orderstatus <> 'P'").withColumn("source", F.lit("orders.csv"))
    revised = (
        rows.where("o_orderstatus <> 'O'")
        .withColumn("o_totalprice", F.col("o_totalprice") + 1)
        .withColumn("source", F.lit("Orders_RV.csv"))
    )
    releases = [base.drop("o_orderstatus"), revised.drop("o_orderstatus")]
    return published(precedence.layered(releases, ["o_orderkey"]))


def preferred_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same two releases in one relation, in which each row names its file."""
    rows = ob.table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    revised = F.array(
        F.when(F.col("o_orderstatus") != "P", F.struct(F.col("o_totalprice"), F.lit("orders.csv").alias("source"))),
        F.when(F.col("o_orderstatus") != "O", F.struct((F.col("o_totalprice") + 1).alias("o_totalprice"), F.lit("Orders_RV.csv").alias("source"))),
    )
    both = rows.select("o_orderkey", F.explode(revised).alias("r")).where("r is not null").select("o_orderkey", "r.*")
    return published(precedence.preferred_rows(both, ["o_orderkey"], "source"))


def schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Yearly order files against declared types: counts, observed type and state of every column and year.

    Customers arrive as 12.0, urgent prices as a point, early years have no priority, prices are declared whole.
    """
    rows = ob.orders(spark, sf_dir)
    root = scratch_path(spark, "orders-drift")
    price = F.when(F.col("o_orderpriority") == "1-URGENT", ".").otherwise(F.col("o_totalprice").cast("decimal(12,2)").cast("string"))
    cells = rows.select(
        "year", F.col("o_orderkey").alias("key"), F.concat(F.col("entity_id").cast("string"), F.lit(".0")).alias("customer"),
        price.alias("price"), F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"))
    early, late = f"{root}/early", f"{root}/late"
    for path, part in ((early, cells.where("year < 1995").drop("priority")), (late, cells.where("year >= 1995"))):
        part.hint("rebalance", "year").write.partitionBy("year").option("header", True).csv(path)
    files = {y: f"{early if y < 1995 else late}/year={y}" for y in ob.order_years(spark, sf_dir)}
    declared = {"KEY": "bigint", "CUSTOMER": "bigint", "PRICE": "bigint", "PRIORITY": "string"}
    return published(drift.drift({y: delimited.read_text_columns(spark, f) for y, f in files.items()}, declared))


def mixed_encoding_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents, line breaks and quotes included, from latin-1 and UTF-8 files side by side.

    Texts that latin-1 can hold go to the first set of files, all others to the second.
    """
    rows = ob.table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text")
    root = scratch_path(spark, "documents-csv")
    latin, utf8 = f"{root}/latin1", f"{root}/utf8"
    narrow = F.coalesce(F.rlike("text", F.lit(r"\A[\x00-\xFF]*\z")), F.lit(True))
    exports.write_csv(rows.where(narrow), latin, bom=False, encoding=delimited.LATIN1)
    exports.write_csv(rows.where(~narrow), utf8, bom=False)
    text = delimited.read_mixed_encodings(spark, [latin, utf8], multiline=True)
    declared = {"DOC_ID": "bigint", "LANG": "string", "SOURCE": "string", "TEXT": "string"}
    return delimited.typed_columns(text, declared).toDF("doc_id", "lang", "source", "text")


def multiline_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents out as files with line breaks and quotes in their values, cut into records by many tasks."""
    rows = ob.table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars", "text")
    path = scratch_path(spark, "records-csv")
    exports.write_csv(rows, path)
    declared = {"DOC_ID": "bigint", "LANG": "string", "SOURCE": "string", "N_CHARS": "bigint", "TEXT": "string"}
    text = delimited.typed_columns(records.read_records(spark, path), declared)
    return text.toDF("doc_id", "lang", "source", "n_chars", "text")


def window_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Named columns of the fact for a window of years, with each row's place in (year, name) order."""
    columns = ["entity_name", "year", "overall_rate", "entering_size"]
    fact = ob.fact(spark, sf_dir, window=(1996, 1999))
    return numbered(published(warehouse.mart_window(fact, columns, 1996, 1999, name="entity_name")))


# --- projections, decodes, filters ----------------------------------------------


def staged_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rename and cast from a map: counts, money totals and rates."""
    lines = ob.table(spark, sf_dir, "lineitem")
    declared = {
        "l_orderkey": ("order_id", "bigint"),
        "l_linenumber": ("line_code", "int"),
        "l_quantity": ("unit_count", rates.COUNT),
        "l_extendedprice": ("price_total", rates.MONEY_TOTAL),
        "l_discount": ("discount_rate", rates.RATE),
        "l_returnflag": ("group_code", "string"),
    }
    return published(
        lines.select(*[F.col(a).cast(t).alias(b) for a, (b, t) in declared.items()])
    )


def decode_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part sizes, 1 to 50, read as each of the code lists."""
    size = F.col("p_size")
    decoded = [
        codes.decode(size, labels, default).alias(name)
        for name, (labels, default) in v.DECODES.items()
    ]
    return published(
        ob.table(spark, sf_dir, "part").select("p_partkey", F.col("p_size").alias("code"), *decoded)
    )


def bucket_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size")
    return published(
        ob.table(spark, sf_dir, "part").select(
            "p_partkey",
            F.col("p_size").alias("code"),
            codes.bucket(size, v.LOCALE_TYPES, v.UNKNOWN).alias("locale_type"),
            codes.bucket(size, v.LOCALE_SIZES, v.UNKNOWN).alias("locale_size"),
        )
    )


def grand_total_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three code filters, and a total-row filter on a code that arrives as text."""
    lines = ob.table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_quantity",
        F.concat(F.col("l_quantity").cast("int").cast("string"), F.lit(".0")).alias("text_code"),
        "l_linestatus",
        "l_returnflag",
    )
    return published(
        lines.where(F.col("l_linestatus") == "F")
        .where(F.col("l_returnflag") == "N")
        .where(F.col("l_linenumber").isin(2, 3, 4, 29, 30, 33))
        .where(codes.equals_code(F.col("text_code"), 50))
        .select("l_orderkey", "l_linenumber", "l_quantity")
    )


def directory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entity-year directory: yearly size and top price beside the fixed attributes."""
    yearly = (
        ob.orders(spark, sf_dir)
        .groupBy(*KEYS)
        .agg(
            F.count(F.lit(1)).alias("n_orders"),
            F.max("o_totalprice").alias("top_price"),
            F.bool_or(F.col("o_orderstatus") == "O").alias("is_active"),
        )
    )
    return yearly.join(ob.entities(spark, sf_dir), "entity_id")


def qualified_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """In region and matched by any of five rules in any year; active in the newest."""
    in_region = F.col("region_name").isin("AMERICA", "ASIA")
    solvent = F.col("balance") > 0
    qualifies = in_region & (
        (F.col("segment") == "BUILDING")
        | (solvent & (F.col("n_orders") == 4))
        | (solvent & F.col("n_orders").between(2, 3) & (F.col("segment") == "FURNITURE"))
        | (solvent & (F.col("top_price") >= 450000))
        | (solvent & codes.name_contains(F.col("entity_name"), ["#00000012", "#00000034", "R#7"]))
    )
    current = in_region & F.col("is_active")
    kept = entities.qualify_in_one_pass(
        directory(spark, sf_dir),
        "entity_id",
        "year",
        ob.newest_year(spark, sf_dir),
        qualifies,
        current,
        ["entity_name", "segment", "n_orders", "top_price"],
    )
    return published(
        kept.select("entity_id", "entity_name", "year", "segment", "n_orders", "top_price")
    )


def latest_year_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Finished orders of the newest year; the year is that of all orders."""
    rows = ob.orders(spark, sf_dir, latest=True).where("o_orderstatus = 'F'")
    return published(rows.select("o_orderkey", "entity_id", "year", "o_totalprice"))


def fact_restricted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of landed entities: entities and rows per year."""
    keep = F.col("region_name").isin("AMERICA", "ASIA") & F.col("segment").isin(
        "BUILDING", "MACHINERY"
    )
    required = ["region_name", "segment"]
    landed = entities.landing_filter(ob.entities(spark, sf_dir), required, keep)
    ids = entities.distinct_ids(landed, "entity_id")
    yearly = ob.orders(spark, sf_dir).groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n"))
    kept = entities.restrict(yearly, ids, "entity_id")
    # One row per entity-year here, so rows count entities.
    return published(
        kept.groupBy("year").agg(
            F.count(F.lit(1)).alias("entities"), F.sum("n").alias("row_count")
        )
    )


# --- metric models -----------------------------------------------------------


def coded_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    sums = ["total_units", "code_1", "code_2", "code_3", "codes_1_2"]
    groups = [f"code_3_{x}" for x in ("a", "r", "n", "f", "o")]
    return published(ob.line_counts(spark, sf_dir).select(*KEYS, *sums, *groups))


def credential_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    shares = [f"pct_{x}" for x in ("a", "r", "n", "f", "o")]
    counts = ob.line_counts(spark, sf_dir).select(*KEYS, *ob.completion_columns())
    return published(counts.select(*KEYS, "code_3", *shares))


def preferred_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return published(ob.preferred_quantities(spark, sf_dir))


def outcome_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return published(ob.outcome_rates(ob.line_counts(spark, sf_dir)))


def gap_severity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return published(ob.gap_severity(spark, sf_dir))


def blended_retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    return published(ob.retention(spark, sf_dir))


# --- entities and marts --------------------------------------------------------


def peer_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return published(ob.peer_attributes(spark, sf_dir))


def dim_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return published(ob.dim(spark, sf_dir))


def outcome_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of three families, none within another: finished orders by their year, first
    lines by the year they ship, returned lines by the year after it."""
    lines = ob.table(spark, sf_dir, "lineitem")
    shipped = lines.groupBy("l_orderkey", F.year("l_shipdate").alias("shipped")).agg(
        F.bool_or(F.col("l_linenumber") == 1).alias("is_first"),
        F.bool_or(F.col("l_returnflag") == "R").alias("is_returned"),
    )
    orders = ob.orders(spark, sf_dir).select("o_orderkey", *KEYS, "o_orderstatus")
    # The line families share one scan: a shipment gives a year to either.
    years = F.array(
        F.when(F.col("is_first"), F.col("shipped")),
        F.when(F.col("is_returned"), F.col("shipped") + 1),
    )
    by_line = shipped.join(orders, shipped["l_orderkey"] == orders["o_orderkey"]).select(
        "entity_id", F.explode(years).alias("year")
    )
    finished = orders.where("o_orderstatus = 'F'")
    return published(key_spine([by_line.where("year is not null"), finished], KEYS))


def colocated_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three models, each with keys of its own, joined bucket by bucket: intakes, lines, and finished orders a year on."""
    intakes = ob.retention(spark, sf_dir).select(*KEYS, "entering")
    units = ob.line_counts(spark, sf_dir).select(*KEYS, "total_units")
    finished = ob.orders(spark, sf_dir).where("o_orderstatus = 'F'").groupBy(
        "entity_id", (F.col("year") + 1).alias("year")).agg(F.count(F.lit(1)).alias("finished"))
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return published(join_colocated([intakes, units, finished], KEYS, scratch_path(spark, "models"), buckets))


def error_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The load audit's totals, with lines of the last two years taken for files that failed."""
    audit = load_audit(spark, sf_dir)
    last = audit.where("status = 'ok'").select(F.max("year")).scalar()
    failed = (F.col("family") == "lineitem") & (F.col("year") >= last - 1)
    state = F.when(failed & F.col("row_count").isNotNull(), quality.ERROR).otherwise(F.col("status"))
    return published(quality.load_totals(audit.withColumn("status", state), ratio=0.6))


def fact_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return published(ob.fact(spark, sf_dir))


def peer_averages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return published(ob.peer_means(spark, sf_dir))


def peer_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    return published(ob.peer_comparison(spark, sf_dir))


def equity_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return published(ob.equity_report(spark, sf_dir))


def equity_report_compat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return published(ob.equity_report(spark, sf_dir, keyed=False))


# --- dashboard datasets -----------------------------------------------------------


def newest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fact rows of the newest year present; the scans read that year alone."""
    return ob.fact(spark, sf_dir, latest=True)


def overview_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return published(
        datasets.cards(
            newest(spark, sf_dir),
            {
                "entities": F.countDistinct("entity_id"),
                "avg_grad_rate": rates.mean_of(F.col("grad_rate"), 2, 1),
                "avg_ft_rate": rates.mean_of(F.col("ft_rate"), 2, 1),
                "total_code_3": F.sum("code_3"),
            },
        )
    )


def equity_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    gaps = {f"avg_{g}": rates.mean_of(F.col(g), 2, 1) for g in ob.FACT_GAPS}
    return published(datasets.cards(newest(spark, sf_dir), gaps))


OVERVIEW_COLUMNS = {
    "entity_name": "entity",
    "grad_rate": "graduation",
    "success_rate": "success",
    "ft_rate": "retention",
    "code_3": "degrees",
    "total_units": "completions",
}


def overview_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    shown = datasets.renamed(newest(spark, sf_dir), OVERVIEW_COLUMNS)
    return numbered(published(datasets.ranked_table(shown, "entity", "graduation")))


def display_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The overview as text, with upper-case headers."""
    shown = datasets.renamed(newest(spark, sf_dir), OVERVIEW_COLUMNS)
    text = shown.select(
        "entity",
        *[display.show_number(F.col(c), 1, "%").alias(c) for c in ("graduation", "success")],
        display.show_number(F.col("retention"), 1).alias("retention"),
        *[display.show_count(F.col(c)).alias(c) for c in ("degrees", "completions")],
    )
    return headers.upper_columns(text)


def ranked_metric(spark: SparkSession, sf_dir: str) -> DataFrame:
    return numbered(published(datasets.ranked_bars(newest(spark, sf_dir), "entity_name", "grad_rate")))


def metric_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = ["grad_rate", "ft_rate", "code_3", "total_units"]
    return numbered(published(datasets.trend(ob.fact(spark, sf_dir), "entity_name", metrics)))


def year_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    years = ob.order_years(spark, sf_dir)
    fact = ob.fact(spark, sf_dir)
    return published(datasets.year_grid(fact, "entity_id", "entity_name", "grad_rate", years))


def pivot_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    years = ob.order_years(spark, sf_dir)
    fact = ob.fact(spark, sf_dir)
    return published(
        datasets.pivot_with_change(fact, "entity_id", "entity_name", "grad_rate", years, 1)
    )


def group_rate_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = {"rate_a": "Group A", "rate_r": "Group R", "rate_n": "Group N"}
    return published(
        datasets.long_by_group(
            newest(spark, sf_dir), "entity_name", labels, "member_group", "rate"
        )
    )


def gap_scatter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return published(datasets.scatter(newest(spark, sf_dir), "entity_name", "gap_r", "gap_n"))


def equity_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = {
        "entity_name": "entity",
        "rate_a": "a_rate",
        "rate_r": "r_rate",
        "rate_n": "n_rate",
        "gap_r": "r_gap",
        "gap_n": "n_gap",
    }
    return published(datasets.renamed(newest(spark, sf_dir), columns))


def entity_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct names with any outcome that hold the term, numbered in name order."""
    keys = ob.orders(spark, sf_dir).select("entity_id").distinct()
    named = ob.entity_names(spark, sf_dir).join(keys, "entity_id", "left_semi")
    return numbered(entities.search_names(named, "R#00000001", "entity_name"))


def entity_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trend of a chosen segment with its last name highlighted."""
    chosen = ob.entities(spark, sf_dir).where("segment = 'BUILDING'")
    focus = chosen.select(F.max("entity_name")).scalar()
    yearly = ob.retention(spark, sf_dir).select(
        *KEYS, rates.published_rate(F.col("overall_rate")).alias("overall_rate")
    )
    picked = entities.restrict(yearly, chosen, "entity_id").join(
        ob.entity_names(spark, sf_dir), "entity_id"
    )
    shown = datasets.with_focus(picked, "entity_name", focus)
    return published(shown.select("entity_name", "year", "overall_rate", "is_focus"))


def star_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    measures = {
        "entities": F.countDistinct("entity_id"),
        "avg_grad_rate": rates.mean_of(F.col("grad_rate"), 2),
        "avg_ft_rate": rates.mean_of(F.col("ft_rate"), 2),
        "total_code_3": F.sum("code_3"),
        "avg_gap_r": rates.mean_of(F.col("gap_r"), 2),
        "avg_gap_n": rates.mean_of(F.col("gap_n"), 2),
    }
    members = ob.peer_attributes(spark, sf_dir).select("entity_id", *ob.PEER_KEYS)
    return published(
        datasets.star_measures(
            members, ob.outcomes(spark, sf_dir), "entity_id", ["size_tier", "place_tier", "year"],
            measures,
        )
    )


CUBE = {
    "entities": cube.Entities(),
    "avg_grad_rate": cube.Mean("grad_rate", 2),
    "avg_gap_r": cube.Mean("gap_r", 2),
    "total_code_3": cube.Total("code_3"),
}
CUBE_BY = ["size_tier", "place_tier", "share_tier", "year"]
CUBE_ASKED = [["size_tier"], ["place_tier", "year"], ["share_tier", "size_tier", "place_tier"], ["year"], []]


def star_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several choices of dimensions, each rolled up from one stored cube."""
    members = ob.peer_attributes(spark, sf_dir).select("entity_id", *ob.PEER_KEYS)
    path = scratch_path(spark, "cube")
    built = cube.cells(members, ob.outcomes(spark, sf_dir), "entity_id", CUBE_BY, CUBE)
    built.write.parquet(path)
    stored = spark.read.parquet(path)
    frames = []
    for by in CUBE_ASKED:
        found = cube.answer(stored, by, CUBE)
        dims = [F.col(d).cast("string").alias(d) if d in by else F.lit(None).cast("string").alias(d) for d in CUBE_BY]
        frames.append(found.select(F.lit(",".join(by)).alias("dims"), *dims, *CUBE))
    return published(delimited.unite(frames))


def search_by_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names that hold a term, found through the posting index written beside them, numbered in name order."""
    path = scratch_path(spark, "names-index")
    search.write_index(ob.entity_names(spark, sf_dir), "entity_name", path)
    return numbered(search.search_index(spark, path, "R#0000001", "entity_name"))


# --- quality ----------------------------------------------------------------


def dq_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    checks = {
        "customer": ["c_custkey"],
        "orders": ["o_orderkey"],
        "lineitem": ["l_orderkey", "l_linenumber"],
        "conversations": ["conv_id", "turn"],
    }
    return quality.all_checks(
        quality.unique_summary(f"unique_{name}", ob.table(spark, sf_dir, name), keys)
        for name, keys in checks.items()
    )


def dq_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    rated = ob.gap_severity(spark, sf_dir)
    summaries = [
        quality.not_null_summary("not_null_name", ob.table(spark, sf_dir, "customer"), "c_name"),
        quality.not_null_summary("not_null_order", ob.table(spark, sf_dir, "orders"), "o_orderkey"),
        quality.not_null_summary("not_null_gap_r", rated, "gap_r"),
    ]
    return quality.all_checks(summaries)


def dq_relationships(spark: SparkSession, sf_dir: str) -> DataFrame:
    checks = [
        ("lineitem", "l_orderkey", "orders", "o_orderkey"),
        ("orders", "o_custkey", "customer", "c_custkey"),
        ("events", "user_id", "supplier", "s_suppkey"),
        ("documents", "doc_id", "labels", "doc_id"),
    ]
    return quality.all_checks(
        quality.relationship_summary(
            f"{child}_in_{parent}",
            ob.table(spark, sf_dir, child),
            key,
            ob.table(spark, sf_dir, parent),
            parent_key,
        )
        for child, key, parent, parent_key in checks
    )


def dq_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    rated = ob.outcome_rates(ob.line_counts(spark, sf_dir))
    return quality.all_checks(
        [
            quality.range_summary("grad_rate_0_100", rated, "grad_rate", 0, 100),
            quality.range_summary("success_rate_0_60", rated, "success_rate", 0, 60),
            quality.range_summary(
                "balance_0_9000", ob.table(spark, sf_dir, "customer"), "c_acctbal", 0, 9000
            ),
        ]
    )


def dq_fact_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entity-year: a key of the fact, not of the orders it is built from."""
    return quality.all_checks(
        [
            quality.unique_summary("fact_key", ob.outcomes(spark, sf_dir), KEYS),
            quality.unique_summary("order_key", ob.orders(spark, sf_dir), KEYS),
        ]
    )


def load_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per family and year. Lines shipped before 1996 do not pass the load filter."""
    one = F.lit(1)
    ordered = (
        ob.orders(spark, sf_dir)
        .groupBy("year")
        .agg(F.count(one).alias("raw_rows"), F.count(one).alias("row_count"))
        .select(F.lit("orders").alias("family"), "*")
    )
    shipped = (
        ob.table(spark, sf_dir, "lineitem")
        .groupBy(F.year("l_shipdate").alias("year"))
        .agg(
            F.count(one).alias("raw_rows"),
            F.count_if(F.year("l_shipdate") >= 1996).alias("row_count"),
        )
        .select(F.lit("lineitem").alias("family"), "*")
    )
    loaded = ordered.unionByName(shipped)
    # Every family is due from the first year that any has to the year after the last.
    due = loaded.agg(F.sequence(F.min("year"), F.max("year") + 1).alias("years")).select(
        F.explode(F.array(F.lit("orders"), F.lit("lineitem"))).alias("family"), "years"
    )
    expected = due.select("family", F.explode("years").alias("year"))
    audit = expected.join(loaded, ["family", "year"], "full")
    return audit.select(
        "family",
        "year",
        "row_count",
        quality.load_status(F.col("raw_rows"), F.col("row_count")).alias("status"),
    )


def thin_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    return published(quality.thin_years(load_audit(spark, sf_dir), ratio=0.6))


def load_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return numbered(published(quality.load_summary(load_audit(spark, sf_dir))))


def guards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the guards see: entity set, export window, required columns."""
    names = ob.entity_names(spark, sf_dir)
    window = ob.orders(spark, sf_dir, window=(1996, 1999))
    empty = ob.orders(spark, sf_dir, window=(2010, 2012))
    orders = ob.table(spark, sf_dir, "orders")
    try:
        headers.require_columns(orders, ["O_ORDERKEY", "O_SECTOR"])
        missing = []
    except headers.MissingColumns as error:
        missing = error.missing
    seen = F.count(F.lit(1))
    return quality.all_checks(
        [
            quality.guard_row("entity_set", names, seen > 0, seen),
            quality.guard_row("window_1996_1999", window, seen > 0, seen),
            quality.guard_row("window_2010_2012", empty, seen > 0, seen),
            quality.guard_row("required_columns", orders, F.lit(not missing), seen),
        ]
    )


# --- exports ----------------------------------------------------------------


def export_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Retention mart out as marked CSV and as yearly Parquet, both read back."""
    columns = ["entity_id", "year", "entering", "ft_rate", "pt_rate", "overall_rate"]
    mart = ob.retention(spark, sf_dir).select(*columns)
    root = scratch_path(spark, "export")
    mart_path = f"{root}/landed"
    exports.write_yearly(mart, mart_path, rebalance=True)
    landed = spark.read.parquet(mart_path).select(*columns)
    report = exports.export_tables(spark, {"retention": landed}, root, "both")

    declared = {c.upper(): "double" for c in columns}
    declared |= {"ENTITY_ID": "bigint", "YEAR": "bigint", "ENTERING": "bigint"}
    csv = delimited.typed_columns(
        delimited.read_text_columns(spark, f"{root}/retention.csv"), declared
    ).toDF(*columns)
    parquet = spark.read.parquet(f"{root}/retention.parquet").select(*columns)
    both = csv.withColumn("format", F.lit("csv")).unionByName(
        parquet.withColumn("format", F.lit("parquet"))
    )
    counts = F.broadcast(report.select("format", "row_count"))  # one row per format
    return published(both.join(counts, "format"))


def export_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chart records of a window written as JSON lines, parsed back beside the years file."""
    columns = {
        "entity_name": "entity",
        "year": "year",
        "grad_rate": "grad_rate",
        "ft_rate": "retention",
        "code_3": "degrees",
        "gap_r": "gap_r",
    }
    root = scratch_path(spark, "records")
    fact = ob.fact(spark, sf_dir).select(*columns)
    exports.write_yearly(fact, f"{root}/fact", rebalance=True)
    mart = spark.read.parquet(f"{root}/fact")
    exports.publish_records(mart, f"{root}/out", 1996, 1999, columns)
    records_back = spark.read.schema(
        "entity string, year int, grad_rate double, retention double, degrees bigint, gap_r double"
    ).json(f"{root}/out/records")
    years = spark.read.schema("years array<int>, records bigint").json(f"{root}/out/years")
    listed = years.select(F.posexplode("years").alias("year_number", "year"), F.col("records").alias("published"))
    return published(records_back.join(listed, "year", "left"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        raw_csv_clean_read, yearly_stamp_union, source_precedence, mixed_encoding_read,
        multiline_records, window_read, preferred_source, schema_drift,
        staged_orders, decode_codes, bucket_codes, grand_total_filter,
        qualified_entities, latest_year_rows, fact_restricted,
        coded_sums, credential_shares, preferred_pivot, outcome_rates, gap_severity,
        blended_retention, peer_attributes, dim_entities, outcome_spine, fact_outcomes,
        peer_averages, peer_comparison, equity_report, equity_report_compat, colocated_models,
        overview_cards, equity_cards, overview_table, display_table, ranked_metric, metric_trend,
        year_grid, pivot_change, group_rate_long, gap_scatter, equity_table,
        entity_search, entity_selection, star_measures, star_cube, search_by_index,
        dq_unique, dq_not_null, dq_relationships, dq_range, dq_fact_key,
        thin_years, load_summary, error_states, guards, export_roundtrip, export_json,
    )
}


def _published(query: Query) -> Query:
    return lambda spark, sf_dir: published(query(spark, sf_dir))


QUERIES |= {name: _published(query) for name, query in surveyed.QUERIES.items()}
