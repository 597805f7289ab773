"""The yearly college survey, from delimited files to marts.

    land      files of six families -> Parquet by family and year, with a load audit
    stage     renamed, typed and decoded columns
    models    entity set, peer groups, completions, graduation, retention
    marts     dimension, outcome fact, peer report, equity report

land() and write_marts() write tables; everything between is lazy. Later steps
read the written tables back, so Catalyst plans with their true sizes.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Mapping
from dataclasses import asdict, dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from cohortbench.functions import codes
from cohortbench.functions import rates as r
from cohortbench.functions.tiers import Tier, flag_tier, size_tier, two_way_tier
from cohortbench.operators import entities as ent
from cohortbench.operators import quality
from cohortbench.operators.coded import preferred_value, sum_of_codes
from cohortbench.operators.combine import join_on_spine
from cohortbench.operators.equity import pair_years, with_parity, with_severity
from cohortbench.operators.peers import (
    attach_averages,
    entity_years,
    peer_averages,
    peer_deltas,
    with_tiers,
)
from cohortbench.plans import vocabulary as v
from cohortbench.sinks import exports
from cohortbench.sinks.snapshots import Store, Version
from cohortbench.sources.delimited import (
    Catalogue,
    encodings,
    read_text_columns,
    typed_cells,
    typed_columns,
    unite,
)
from cohortbench.sources.headers import MissingColumns, clean_name, require_columns
from cohortbench.sources.records import read_records
from cohortbench.sources.warehouse import latest_year_rows

KEY = "unitid"
KEYS = [KEY, "year"]


@dataclass(frozen=True)
class Scope:
    """Which entities a build compares."""

    state: str = "TX"
    landed_sectors: tuple[int, ...] = (1, 4)
    name_terms: tuple[str, ...] = ("community college", "junior college", "technical college")


@dataclass(frozen=True)
class MartNames:
    """Table names of the marts; set them to what the readers expect."""

    dim: str = "institution_dim"
    fact: str = "outcome_fact"
    peers: str = "peer_report"
    equity: str = "equity_report"


# --- landing -----------------------------------------------------------------


IDS = "UNITID bigint"


def file_schema(family: str) -> dict[str, str]:
    return {name: type_name for name, (_, type_name) in v.STAGED[family].items()}


def landed_schema(family: str) -> str:
    columns = ", ".join(f"`{n}` {t}" for n, t in file_schema(family).items())
    return f"{columns}, YEAR int"


def published_files(spark: SparkSession, files: list[tuple[int, str]]) -> dict[int, str]:
    """Years whose file is there."""
    there = {}
    for year, path in files:
        try:
            spark.read.text(path)
            there[year] = path
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    return there


def _landing_cut(scope: Scope) -> Column:
    return (F.col("STABBR") == scope.state) & F.col("SECTOR").isin(*scope.landed_sectors)


def land(
    spark: SparkSession,
    catalogue: Catalogue,
    out: str,
    scope: Scope | None = Scope(),
    strict: bool = True,
    multiline: bool = False,
) -> DataFrame:
    """Files to Parquet under out, by family and year; returns the load audit.

    A landing replaces the years it finds files for and keeps the other years that lie
    there; the audit of a year without a file counts the rows kept of it. All families
    become a new version at once, at the end: a landing that dies on the way changes
    nothing that readers see.

    The directory comes first: its ids, over all years, restrict every other
    family; without one in the catalogue the ids of the version before do. Without a
    scope everything is kept. The audit has a row per family and year with status,
    reason and row_count. Files whose quoted values hold line breaks need multiline.
    """
    audit: list[tuple[str, int, str, str | None, int]] = []
    store = Store(spark, out)
    change = store.begin()
    ids = None
    if scope and "hd" not in catalogue.years and "_ids" in change.base.tables:
        ids = store.read(change.base, "_ids", IDS)
    families = sorted(catalogue.years, key=lambda f: f != "hd")
    written = False
    for family in families:
        frames, years, unread = [], [], []
        schema = file_schema(family)
        cells = typed_cells(schema, strict=strict)
        files = catalogue.files(family)
        there = published_files(spark, files)
        known = {} if multiline else encodings(spark, list(there.values()))
        for year, path in files:
            if year not in there:
                unread.append((year, quality.NOT_PUBLISHED, f"no file {path}"))
                continue
            raw = read_records(spark, path) if multiline else read_text_columns(spark, path, known[path])
            if family == "hd" and scope:
                try:
                    require_columns(raw, ["UNITID", "STABBR", "SECTOR"], path)
                except MissingColumns as error:
                    unread.append((year, quality.ERROR, str(error)))
                    continue
            typed = typed_columns(raw, schema, strict=strict, cells=cells)
            if scope and family == "hd":
                typed = typed.where(_landing_cut(scope))
            elif ids is not None and "UNITID" in raw.columns:
                typed = ent.restrict(typed, ids, "UNITID")
            elif scope:
                ent.log.warning("%s %s has no ids to be restricted by", family, year)
            frames.append(typed.withColumn("YEAR", F.lit(year)))
            years.append(year)
        if frames:
            change.write_years(family, unite(frames), years, "YEAR")
            written = True
        counts = change.pending().rows(family)
        audit += [(family, year, state, why, counts.get(year, 0)) for year, state, why in unread]
        for year in years:
            n = counts.get(year, 0)
            audit.append((family, year, quality.OK if n else quality.EMPTY, None, n))
        if family == "hd" and scope and (frames or counts):
            kept = landed(spark, out, family, change.pending())
            change.write_whole("_ids", ent.distinct_ids(kept, "UNITID"))
            ids = exports.require_rows(
                store.read(change.pending(), "_ids", IDS), "no entity passes the landing filter"
            )
    if written:
        change.commit()
    return spark.createDataFrame(
        audit, "family string, year int, status string, reason string, row_count bigint"
    )


def landed(
    spark: SparkSession,
    out: str,
    family: str,
    version: Version | None = None,
    years: Iterable[int] | None = None,
) -> DataFrame:
    """Rows of a family in a version of the landing, the newest if none is given."""
    store = Store(spark, out)
    return store.read(version or store.current(), family, landed_schema(family), years)


# --- staging -----------------------------------------------------------------


def stage(landed_rows: DataFrame, family: str) -> DataFrame:
    """Output names, decoded labels and the year."""
    renamed = landed_rows.select(
        *[F.col(c).alias(name) for c, (name, _) in v.STAGED[family].items()],
        F.col("YEAR").alias("year"),
    )
    decoded = {
        name: codes.decode(F.col(code), *v.DECODES[name])
        for name, code in v.STAGED_DECODES[family].items()
    }
    if family == "hd":
        locale = F.col("locale")
        decoded["locale_type"] = codes.bucket(locale, v.LOCALE_TYPES, v.UNKNOWN)
        decoded["locale_size"] = codes.bucket(locale, v.LOCALE_SIZES, v.UNKNOWN)
    staged = renamed.withColumns(decoded) if decoded else renamed
    if family == "c_a":
        staged = staged.where(F.col("major_number") == 1)
    return staged


def staged_family(
    spark: SparkSession,
    out: str,
    family: str,
    version: Version | None = None,
    years: Iterable[int] | None = None,
) -> DataFrame:
    return stage(landed(spark, out, family, version, years), family)


# --- models -----------------------------------------------------------------


def directory_rows(institutions: DataFrame, scope: Scope = Scope()) -> DataFrame:
    """Directory rows with whether the entity qualifies by any of five rules and is current.

    A rule with a null input does not hold, and does not keep the others from holding.
    """
    public = F.col("control") == 1
    in_state = F.col("state_code") == scope.state
    qualifies = in_state & (
        (F.col("sector") == 4)
        | (public & (F.col("institution_level") == 2))
        | (public & F.col("carnegie_basic_2021").between(2, 10))
        | (public & (F.col("highest_degree_offered") == 3))
        | (public & codes.name_contains(F.col("institution_name"), scope.name_terms))
    )
    current = in_state & (F.col("active_current_year") == 1)
    return institutions.select(
        *KEYS, qualifies.alias("qualifies"), current.alias("current"),
        "institution_name", "city", "state_code", "latitude", "longitude",
        "sector", "sector_name", "control_name", "locale_type",
        "institution_size_category", "website_url",
        codes.decode(
            F.col("institution_size_category"), *v.DECODES["size_category_name"]
        ).alias("size_category_name"),
    )


def entity_set(directory: DataFrame) -> DataFrame:
    """Public two-year colleges of the state by any of the rules in any year.

    Rows describe the entity by the newest directory year.
    """
    described = ent.qualify_any_year(directory, KEY, "year", F.col("qualifies"), F.col("current"))
    return described.drop("year", "qualifies", "current")


def peer_tiers() -> list[Tier]:
    return [
        size_tier("size_tier", F.col("total_enrollment"), 5000, 15000),
        flag_tier("is_hsi", F.col("pct_hispanic"), 25),
        two_way_tier("pell_tier", F.col("pct_pell") >= 40, "High Pell", "Lower Pell"),
        two_way_tier(
            "urbanicity",
            F.col("locale_type").isin("City", "Suburb"),
            "Urban/Suburban",
            "Town/Rural",
        ),
    ]


def enrollment_rows(enrollment: DataFrame) -> DataFrame:
    """Totals and shares of all students together."""
    total = F.col("total_enrollment")
    return enrollment.where(F.col("student_level") == 1).select(
        *KEYS,
        total,
        *[
            r.safe_pct(F.col(f"{g}_total"), total).alias(f"pct_{g}")
            for g in ("hispanic", "black", "white")
        ],
    )


def aid_rows(aid: DataFrame) -> DataFrame:
    return aid.select(*KEYS, F.col("all_ug_pell_recipients_percent").alias("pct_pell"))


def peer_groups(members: DataFrame, enrollment: DataFrame, aid: DataFrame) -> DataFrame:
    """Tiers from the rows of the newest enrollment and aid years."""
    described = members.select(KEY, "institution_name", "city", "locale_type", "size_category_name")
    attached = ent.attach(described, enrollment.drop("year"), aid.drop("year"), key=KEY)
    return with_tiers(attached, peer_tiers())


COMPLETION_GROUPS = {
    "hispanic": "hispanic_total",
    "black": "black_total",
    "white": "white_total",
    "asian": "asian_total",
    "amer_indian": "amer_indian_total",
    "two_or_more": "two_or_more_total",
    "men": "total_completions_men",
    "women": "total_completions_women",
}


def completion_metrics(completions: DataFrame) -> DataFrame:
    """Awards per entity-year from the all-programs rows, code 99."""
    level, all_awards = F.col("award_level"), r.whole(F.col("total_completions"))
    totals = completions.where(codes.equals_code(F.col("cip_code"), 99))
    sums = {
        "total_completions": F.sum(all_awards),
        "certificates_under_1yr": sum_of_codes(level, [1], all_awards),
        "certificates_1_2yr": sum_of_codes(level, [2], all_awards),
        "total_certificates": sum_of_codes(level, [1, 2], all_awards),
        "associate_degrees": sum_of_codes(level, [3], all_awards),
    }
    for group, column in COMPLETION_GROUPS.items():
        sums[f"associate_{group}"] = sum_of_codes(level, [3], r.whole(F.col(column)))
    counted = totals.groupBy(*KEYS).agg(*[s.alias(name) for name, s in sums.items()])
    counted = counted.select(
        *KEYS, *[r.published_count(F.col(name)).alias(name) for name in sums]
    )
    degrees = F.col("associate_degrees")
    return counted.select(
        "*",
        *[
            r.safe_pct(F.col(f"associate_{g}"), degrees).alias(f"pct_associate_{g}")
            for g in ("hispanic", "black", "white", "men", "women")
        ],
    )


# Cohort type codes by role: (two-year colleges, four-year style). Fixed values.
COHORT_ROLES = {"cohort": (29, 2), "completers": (30, 3), "transfers": (33, 4)}
RATE_GROUPS = {
    "hispanic": "hispanic_total",
    "black": "black_total",
    "white": "white_total",
    "asian": "asian_total",
    "men": "total_men",
    "women": "total_women",
}


def graduation_metrics(graduation: DataFrame) -> DataFrame:
    """Rates per entity-year, two-year cohort codes before four-year ones."""
    code = F.col("cohort_type")
    wanted = [c for pair in COHORT_ROLES.values() for c in pair]
    measures = {"all": "total", **RATE_GROUPS}
    roles = {
        f"{role}_{m}": preferred_value(code, *pair, F.col(column))
        for role, pair in COHORT_ROLES.items()
        for m, column in measures.items()
    }
    wide = (
        graduation.where(code.isin(wanted))
        .groupBy(*KEYS)
        .agg(*[value.alias(name) for name, value in roles.items()])
    )
    cohort, completers, transfers = (F.col(f"{role}_all") for role in COHORT_ROLES)
    rated = wide.select(
        "*",
        r.safe_pct(completers, cohort).alias("graduation_rate_150"),
        r.safe_pct(transfers, cohort).alias("transfer_out_rate"),
        r.success_rate(completers, transfers, cohort).alias("success_rate"),
        *[
            r.safe_pct(F.col(f"completers_{g}"), F.col(f"cohort_{g}")).alias(f"grad_rate_{g}")
            for g in RATE_GROUPS
        ],
    )
    return rated.select(
        *KEYS,
        cohort.alias("adjusted_cohort_total"),
        completers.alias("completers_150_total"),
        transfers.alias("transfer_out_total"),
        "graduation_rate_150",
        "transfer_out_rate",
        "success_rate",
        *[f"grad_rate_{g}" for g in RATE_GROUPS],
        *[
            r.rate_gap(F.col("grad_rate_white"), F.col(f"grad_rate_{g}")).alias(f"equity_gap_{g}")
            for g in ("hispanic", "black")
        ],
        *[f"cohort_{g}" for g in ("hispanic", "black", "white", "men", "women")],
    )


def retention_metrics(retention: DataFrame) -> DataFrame:
    """Retention rows with the rate over both parts.

    The blended rate treats a missing part as absent; the cohort total is unknown
    as soon as one part is.
    """
    ft = (F.col("ft_students_retained"), F.col("ft_adjusted_cohort"))
    pt = (F.col("pt_students_retained"), F.col("pt_adjusted_cohort"))
    return retention.select(
        *KEYS,
        "full_time_retention_rate",
        "part_time_retention_rate",
        r.blended_rate([ft, pt]).alias("overall_retention_rate"),
        "student_faculty_ratio",
        "total_entering_undergrads",
        "ft_adjusted_cohort",
        "pt_adjusted_cohort",
        r.published_count(ft[1] + pt[1]).alias("total_adjusted_cohort"),
        "ft_students_retained",
        "pt_students_retained",
        "grs_cohort_count",
        "grs_cohort_pct_of_entering",
    )


# --- marts -----------------------------------------------------------------


def dimension(members: DataFrame, groups: DataFrame, retention: DataFrame) -> DataFrame:
    """One row per entity; retention is that of the newest retention year."""
    attributes = groups.select(
        KEY,
        r.published_count(F.col("total_enrollment")).alias("total_enrollment"),
        *[t.name for t in peer_tiers()],
        *[
            r.published_rate(F.col(c)).alias(c)
            for c in ("pct_hispanic", "pct_black", "pct_white", "pct_pell")
        ],
    )
    newest = latest_year_rows(retention).select(
        KEY,
        *[
            r.published_rate(F.col(c)).alias(c)
            for c in (
                "full_time_retention_rate",
                "part_time_retention_rate",
                "overall_retention_rate",
                "student_faculty_ratio",
            )
        ],
    )
    place = members.select(
        KEY, "institution_name", "city", "state_code", "latitude", "longitude", "website_url",
        "sector_name", "control_name", "size_category_name", "locale_type",
    )
    return ent.attach(place, attributes, newest, key=KEY)


FACT_COUNTS = [
    "total_completions",
    "associate_degrees",
    "total_certificates",
    "certificates_under_1yr",
    "certificates_1_2yr",
]
FACT_RATES = [
    *[f"pct_associate_{g}" for g in ("hispanic", "black", "white", "men", "women")],
    "graduation_rate_150",
    "transfer_out_rate",
    "success_rate",
    *[f"grad_rate_{g}" for g in ("hispanic", "black", "white", "men", "women")],
    "equity_gap_hispanic",
    "equity_gap_black",
    "full_time_retention_rate",
    "part_time_retention_rate",
    "overall_retention_rate",
]
FACT_COHORTS = {
    "adjusted_cohort_total": "graduation_cohort_size",
    "total_entering_undergrads": "retention_cohort_size",
}


def outcome_fact(
    members: DataFrame, completions: DataFrame, graduation: DataFrame, retention: DataFrame
) -> DataFrame:
    """One row per entity-year found in any of the three models."""
    aligned = join_on_spine([completions, graduation, retention], KEYS)
    named = aligned.join(members.select(KEY, "institution_name"), KEY)
    return named.select(
        KEY,
        "institution_name",
        "year",
        *[r.published_count(F.col(c)).alias(c) for c in FACT_COUNTS],
        *[r.published_rate(F.col(c)).alias(c) for c in FACT_RATES],
        *[r.published_count(F.col(c)).alias(name) for c, name in FACT_COHORTS.items()],
    )


PEER_KEYS = ["size_tier", "is_hsi", "pell_tier", "urbanicity"]

# Output name: (column, digits held, digits shown). Retention is the entity's.
PEER_METRICS = {
    "peer_avg_grad_rate": ("graduation_rate_150", 2, 1),
    "peer_avg_success_rate": ("success_rate", 2, 1),
    "peer_avg_ft_retention": ("full_time_retention_rate", 2, 1),
    "peer_avg_overall_retention": ("overall_retention_rate", 2, 1),
    "peer_avg_associate_degrees": ("associate_degrees", 0, 0),
    "peer_avg_student_faculty_ratio": ("student_faculty_ratio", 2, 1),
}
PEER_DELTAS = {
    "grad_rate_vs_peers": ("graduation_rate_150", "peer_avg_grad_rate"),
    "success_rate_vs_peers": ("success_rate", "peer_avg_success_rate"),
    "ft_retention_vs_peers": ("full_time_retention_rate", "peer_avg_ft_retention"),
    "overall_retention_vs_peers": ("overall_retention_rate", "peer_avg_overall_retention"),
}


def peer_report(dim: DataFrame, fact: DataFrame, with_year: bool = True) -> DataFrame:
    """Entity-years beside the means of their peer group.

    with_year=False gives the published columns, in which the years of an entity
    cannot be told apart.
    """
    rows = entity_years(dim, fact, KEY)
    means = peer_averages(rows, PEER_KEYS, PEER_METRICS, KEY)
    compared = peer_deltas(
        attach_averages(rows, means, PEER_KEYS, peer_tiers()),
        PEER_DELTAS,
        ("grad_rate_performance", "graduation_rate_150", "peer_avg_grad_rate"),
    )
    years = ["year", "peer_entity_count"] if with_year else []
    return compared.select(
        KEY, "institution_name", "city", *PEER_KEYS, "peer_group_count", *years,
        "graduation_rate_150", "success_rate", "full_time_retention_rate",
        "overall_retention_rate", "associate_degrees", "student_faculty_ratio",
        *PEER_METRICS, *PEER_DELTAS, "grad_rate_performance",
    )


def equity_report(
    dim: DataFrame, fact: DataFrame, completions: DataFrame, keyed: bool = True
) -> DataFrame:
    """Gaps, severities and parity indices.

    keyed=False gives the published grain: no year, every outcome year beside
    every completion year.
    """
    shares = {f"pct_associate_{g}": f"share_{g}" for g in ("hispanic", "black", "white")}
    counts = [f"associate_{g}" for g in ("hispanic", "black", "white")]
    completion_side = completions.select(
        *KEYS, *[F.col(c).alias(s) for c, s in shares.items()], *counts
    )
    outcome_side = fact.select(
        *KEYS,
        F.col("graduation_rate_150").alias("overall_grad_rate"),
        *[f"grad_rate_{g}" for g in ("hispanic", "black", "white", "men", "women")],
        "equity_gap_hispanic",
        "equity_gap_black",
        "pct_associate_men",
        "pct_associate_women",
        "graduation_cohort_size",
    )
    own = dim.select(
        KEY, "institution_name", "city", "is_hsi", "pell_tier", "total_enrollment",
        "pct_hispanic", "pct_black", "pct_white", "pct_pell", "overall_retention_rate",
    )
    rows = pair_years(own, outcome_side, completion_side, KEY, keyed=keyed)
    rows = with_severity(
        rows,
        {
            "hispanic_gap_severity": "equity_gap_hispanic",
            "black_gap_severity": "equity_gap_black",
        },
    )
    indexes = {
        f"{g}_completion_equity_index": (f"share_{g}", f"pct_{g}")
        for g in ("hispanic", "black", "white")
    }
    return with_parity(rows, indexes).select(
        KEY, "institution_name", *(["year"] if keyed else []), "city", "is_hsi", "pell_tier",
        "total_enrollment", "pct_hispanic", "pct_black", "pct_white", "pct_pell",
        "overall_grad_rate", "grad_rate_hispanic", "grad_rate_black", "grad_rate_white",
        "equity_gap_hispanic", "equity_gap_black",
        "hispanic_gap_severity", "black_gap_severity",
        *[F.col(s).alias(c) for c, s in shares.items()],
        *indexes,
        "grad_rate_men", "grad_rate_women", "pct_associate_men", "pct_associate_women",
        "overall_retention_rate", "graduation_cohort_size", *counts,
    )


def models(scope: Scope) -> dict[str, tuple[str, Callable[[DataFrame], DataFrame]]]:
    """Tables by entity and year, each with its family and how a year's staged rows become it.

    No model looks beyond the year it is built for, so a year of one stays right
    while the files of other years change.
    """
    return {
        "_directory": ("hd", lambda rows: directory_rows(rows, scope)),
        "_completions": ("c_a", completion_metrics),
        "_graduation": ("gr", graduation_metrics),
        "_retention": ("ef_d", retention_metrics),
        "_enrollment": ("effy", enrollment_rows),
        "_aid": ("sfa", aid_rows),
    }


def changed_years(landing: Version, built: Version, family: str) -> tuple[list[int], list[int]]:
    """Years of a family to be built anew, and years that are gone, since the marts were built."""
    now, then = landing.folders(family), built.notes.get("sources", {}).get(family, {})
    anew = sorted(int(y) for y, folder in now.items() if y not in then or then[y] != folder)
    return anew, sorted(int(y) for y in then if y not in now)


def _differ(one: DataFrame, other: DataFrame) -> bool:
    return not one.exceptAll(other).isEmpty() or not other.exceptAll(one).isEmpty()


def write_marts(
    spark: SparkSession,
    landed_root: str,
    out: str,
    scope: Scope = Scope(),
    published_grain: bool = False,
    names: MartNames = MartNames(),
    full: bool = False,
) -> dict[str, DataFrame]:
    """Bring the four marts up to the newest landing; returns them as read back.

    The marts know which landed folders they were built from. Models by entity and
    year are built anew for the years whose folder is another one now, and kept for
    the others, so that only those years are scanned. From there on tables have a row
    per entity and year: the fact is written for the years any model changed in, or
    for all of them once the entity set differs; dimension and reports are written if
    what they are made of changed. All of it becomes a new version at the end. Other
    settings, or full, build everything.

    published_grain leaves the year out of both reports and pairs all years in the
    equity report.
    """
    landing, store = Store(spark, landed_root).current(), Store(spark, out)
    settings = json.loads(json.dumps([asdict(scope), published_grain, asdict(names)]))
    change = store.begin()
    if full or change.base.notes.get("settings") != settings:
        change.clear()
    built = Version(tables=change.base.tables, notes=change.pending().notes)
    schemas: dict[str, StructType] = {}
    touched: dict[str, set[int]] = {}

    def read(table: str, years: Iterable[int] | None = None) -> DataFrame:
        schema = schemas[table]
        return store.read(change.pending(), table, schema, years).select(*schema.fieldNames())

    def write(table: str, rows: DataFrame, years: list[int] | None = None) -> None:
        schemas[table] = rows.schema
        if years is None:
            change.write_whole(table, rows)
        else:
            change.write_years(table, rows, years, "year", rebalance=True)

    for table, (family, build) in models(scope).items():
        anew, gone = changed_years(landing, built, family)
        rows = build(staged_family(spark, landed_root, family, landing, anew))
        write(table, rows, anew)
        change.drop_years(table, gone)
        touched[table] = {*anew, *gone}

    def newest(table: str) -> DataFrame:
        """The model's rows of the newest year its family has any of."""
        years = [y for y, n in landing.rows(models(scope)[table][0]).items() if n]
        return read(table, [max(years)] if years else [])

    def renewed(table: str, rows: DataFrame, due: bool) -> bool:
        """Writes a table if it is due; whether it differs from the one before."""
        schemas[table] = rows.schema
        if table not in change.pending().tables:
            write(table, rows)
            return True
        if not due:
            return False
        before = read(table)
        write(table, rows)
        return _differ(read(table), before)

    regrouped = renewed("_members", entity_set(read("_directory")), bool(touched["_directory"]))
    members = exports.require_rows(read("_members"), "no entity qualifies")
    yearly = [t for t in ("_completions", "_graduation", "_retention")]
    completions, graduation, retention = (ent.restrict(read(t), members, KEY) for t in yearly)
    groups = peer_groups(members, newest("_enrollment"), newest("_aid"))
    due = regrouped or any(touched[t] for t in ("_enrollment", "_aid", "_retention"))
    described = renewed(names.dim, dimension(members, groups, retention), due)

    every = {y for t in yearly for y in change.pending().rows(t)}
    anew = set().union(*(touched[t] for t in yearly))
    anew = every if regrouped else anew & every
    parts = [ent.restrict(read(t, anew), members, KEY) for t in yearly]
    write(names.fact, outcome_fact(members, *parts), sorted(anew))
    gone = set(change.pending().rows(names.fact)) - every
    change.drop_years(names.fact, gone)

    dim, fact = read(names.dim), read(names.fact)
    due = described or bool(anew or gone)
    renewed(names.peers, peer_report(dim, fact, with_year=not published_grain), due)
    equity = equity_report(dim, fact, completions, keyed=not published_grain)
    renewed(names.equity, equity, due)
    if due or any(touched.values()):
        sources = {family: landing.folders(family) for family, _ in models(scope).values()}
        change.commit({"settings": settings, "sources": sources, "landing": landing.number})
    return {t: read(t) for t in (names.dim, names.fact, names.peers, names.equity)}


def register(marts: Mapping[str, DataFrame]) -> None:
    """Marts as temporary views, for SQL."""
    for name, df in marts.items():
        df.createOrReplaceTempView(name)


def mart_checks(marts: Mapping[str, DataFrame], names: MartNames = MartNames()) -> DataFrame:
    """The data tests declared for the marts, one row each."""
    dim, fact = names.dim, names.fact
    return quality.run_checks(marts, [
        quality.Unique("dim_unique", dim, (KEY,)),
        quality.NotNull("dim_id_not_null", dim, KEY),
        quality.NotNull("dim_name_not_null", dim, "institution_name"),
        quality.NotNull("fact_id_not_null", fact, KEY),
        quality.Related("fact_in_dim", fact, KEY, dim, KEY),
        quality.InRange("fact_graduation_rate", fact, "graduation_rate_150", 0, 100),
        quality.Unique("fact_key_unique", fact, tuple(KEYS)),
        quality.NotNull("peers_id_not_null", names.peers, KEY),
        quality.NotNull("equity_id_not_null", names.equity, KEY),
    ])


def directory_checks(landed_directory: DataFrame, years: Iterable[int]) -> DataFrame:
    """Ids present and unique in each yearly directory."""
    key = clean_name(KEY)
    copies = landed_directory.groupBy("YEAR", key).agg(F.count(F.lit(1)).alias("copies"))
    has_id = F.col(key).isNotNull()
    found = copies.groupBy("YEAR").agg(
        F.count_if(has_id).alias("ids"),
        F.count_if(has_id & (F.col("copies") > 1)).alias("twice"),
        F.sum("copies").alias("rows"),
        F.coalesce(F.sum(F.when(~has_id, F.col("copies"))), F.lit(0)).alias("nulls"),
    )
    asked = landed_directory.sparkSession.createDataFrame([(y,) for y in years], "YEAR int")
    name = F.concat(F.lit("hd_"), F.col("YEAR").cast("string"))

    def check(suffix: str, checked: str, violations: str) -> Column:
        return F.struct(
            F.concat(name, F.lit(suffix)).alias("check_name"),
            F.coalesce(F.col(checked), F.lit(0)).alias("checked"),
            F.coalesce(F.col(violations), F.lit(0)).alias("violations"),
        )

    both = F.array(check("_unique", "ids", "twice"), check("_not_null", "rows", "nulls"))
    return asked.join(found, "YEAR", "left").select(F.explode(both).alias("c")).select("c.*")
