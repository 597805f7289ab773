"""The survey pipeline over an order book: files of all six families written from the tables.

Customers are colleges and order years survey years. Each family is one set of yearly
files, in which values arrive as text, with blanks, points and NULL for missing ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortbench.operators.ranking import numbered
from cohortbench.plans import dashboard, orderbook, survey
from cohortbench.session import scratch_path
from cohortbench.sinks.snapshots import Files
from cohortbench.sources.delimited import Catalogue, unite

# One relation per family in SQL that Spark and DuckDB read alike: the colleges' answers
# before they are written as text. order_rows and line_rows are those of the order book.
# Small answers are not published (awards without returned or accepted lines, cohorts under
# ten, intakes of a single urgent order), each family's own way: no family's keys hold another's.
FAMILIES = {
    "hd": """
SELECT y.year, c_custkey AS UNITID, c_name AS INSTNM, n_name AS CITY,
  CASE WHEN n_regionkey IN (1, 2) THEN 'TX' ELSE 'OK' END AS STABBR,
  CASE WHEN c_custkey % 3 = 0 THEN 1 WHEN c_custkey % 3 = 1 THEN 4 ELSE 2 END AS SECTOR,
  CASE WHEN c_custkey % 7 = 0 THEN 2 ELSE 1 END AS CONTROL, c_custkey % 4 AS ICLEVEL,
  10 * (1 + c_custkey % 5) + 1 + c_custkey % 3 AS LOCALE, c_custkey % 7 AS INSTSIZE,
  c_custkey % 15 AS C21BASIC, c_custkey % 5 AS HDEGOFR1,
  CASE WHEN c_custkey % 11 = 0 THEN 2 ELSE 1 END AS CYACTIVE
FROM (SELECT DISTINCT entity_id, year FROM order_rows) y
JOIN customer ON c_custkey = y.entity_id JOIN nation ON n_nationkey = c_nationkey""",
    "effy": """
SELECT year, entity_id AS UNITID, 1 AS EFFYALEV, count(*) * 2500 + entity_id % 100 AS EFYTOTLT,
  count(*) FILTER (WHERE urgent) * 700 AS EFYHISPT, count(*) * 300 AS EFYBKAAT,
  count(*) * 900 AS EFYWHITT
FROM order_rows GROUP BY year, entity_id
UNION ALL SELECT year, entity_id, 2, 1, 1, 1, 1 FROM order_rows GROUP BY year, entity_id""",
    "sfa": """
SELECT year, entity_id AS UNITID, CASE WHEN entity_id % 9 <> 0 THEN entity_id % 97 END AS UPGRNTP
FROM order_rows GROUP BY year, entity_id""",
    "c_a": """
SELECT year, entity_id AS UNITID, CASE WHEN status = 'F' THEN '99' ELSE '52.0101' END AS CIPCODE,
  CASE WHEN code = 7 THEN 2 ELSE 1 END AS MAJORNUM, 1 + code % 4 AS AWLEVEL, sum(n) AS CTOTALT,
  sum(n) FILTER (WHERE code <= 3) AS CTOTALM, sum(n) FILTER (WHERE code > 3) AS CTOTALW,
  sum(n) FILTER (WHERE grp = 'A') AS CHISPT, sum(n) FILTER (WHERE grp = 'R') AS CBKAAT,
  sum(n) FILTER (WHERE grp = 'N') AS CWHITT
FROM line_rows GROUP BY year, entity_id, 3, 4, 5
HAVING count(*) FILTER (WHERE grp <> 'N') > 0""",
    "gr": """
SELECT year, entity_id AS UNITID,
  CASE code WHEN 1 THEN 29 WHEN 2 THEN 30 WHEN 3 THEN 33 WHEN 4 THEN 2 WHEN 5 THEN 3
            WHEN 6 THEN 4 ELSE 12 END AS GRTYPE,
  max(n) AS GRTOTLT, max(n) FILTER (WHERE status = 'F') AS GRTOTLM,
  max(n) FILTER (WHERE status = 'O') AS GRTOTLW, max(n) FILTER (WHERE grp = 'A') AS GRHISPT,
  max(n) FILTER (WHERE grp = 'R') AS GRBKAAT, max(n) FILTER (WHERE grp = 'N') AS GRWHITT
FROM line_rows GROUP BY year, entity_id, 3 HAVING max(n) >= 10""",
    "ef_d": """
SELECT year, entity_id AS UNITID, CASE WHEN entity_id % 6 <> 0 THEN entity_id % 101 END AS RET_PCF,
  CASE WHEN entity_id % 5 <> 0 THEN entity_id % 89 END AS RET_PCP, 5 + entity_id % 30 AS STUFACR,
  count(*) AS UGENTERN, count(*) FILTER (WHERE urgent) AS RRFTCTA,
  count(*) FILTER (WHERE urgent AND o_orderstatus = 'F') AS RET_NMF,
  NULLIF(count(*) FILTER (WHERE NOT urgent), 0) AS RRPTCTA,
  count(*) FILTER (WHERE NOT urgent AND o_orderstatus = 'F') AS RET_NMP
FROM order_rows GROUP BY year, entity_id HAVING count(*) > 1 OR count(*) FILTER (WHERE urgent) = 0""",
}

SEARCHED = "R#00000"
TEMPLATE = "{family}/year={year}"


def answers(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The families' relations over the tables; the lines beside their orders are written below the scratch folder."""
    order_rows = orderbook.orders(spark, sf_dir).select(
        "o_orderkey", "entity_id", "year", "o_orderstatus",
        F.col("o_orderpriority").isin(*orderbook.URGENT).alias("urgent"),
    )
    lines = orderbook.line_rows(spark, sf_dir).withColumnRenamed("member_group", "grp")
    # Two families are made of the lines beside their orders, and one is written twice by a query: joined once.
    joined = lines.join(order_rows, lines["l_orderkey"] == order_rows["o_orderkey"])
    joined = joined.select("entity_id", "year", "code", "grp", "status", "n")
    path = scratch_path(spark, "lines")
    joined.write.parquet(path)
    line_rows = spark.read.schema(joined.schema).parquet(path)
    tables = {name: orderbook.table(spark, sf_dir, name) for name in ("customer", "nation")}
    tables |= {"order_rows": order_rows, "line_rows": line_rows}
    out = {}
    for family, sql in FAMILIES.items():
        marked = sql
        for name in tables:
            marked = marked.replace(f" {name}", f" {{{name}}}")
        used = {n: df for n, df in tables.items() if f"{{{n}}}" in marked}
        out[family] = spark.sql(marked, **used)
    return out


def write_files(rows: DataFrame, path: str) -> None:
    """Yearly sets of text files; missing values are spelt in one of three ways."""
    marker = F.when(F.col("UNITID") % 3 == 0, ".").when(F.col("UNITID") % 3 == 1, "NULL").otherwise("")
    cells = [
        F.coalesce(F.col(c).cast("string"), marker).alias(c) for c in rows.columns if c != "year"
    ]
    text = rows.select("year", *cells).hint("rebalance", "year")
    text.write.partitionBy("year").option("header", True).csv(path)


Built = tuple[str, DataFrame, dict[str, DataFrame]]


def build(spark: SparkSession, sf_dir: str) -> Built:
    """Files, landing and marts below a scratch folder; returns it, the load audit and the marts."""
    root = scratch_path(spark, "survey")
    years = orderbook.order_years(spark, sf_dir)
    for family, rows in answers(spark, sf_dir).items():
        write_files(rows, f"{root}/raw/{family}")
    catalogue = Catalogue(f"{root}/raw", {f: years for f in FAMILIES}, TEMPLATE)
    audit = survey.land(spark, catalogue, f"{root}/landed")
    return root, audit, survey.write_marts(spark, f"{root}/landed", f"{root}/marts")


# The last build, by session and state of the tables it was made of.
_last: dict[tuple, Built] = {}


def built_once(spark: SparkSession, sf_dir: str) -> Built:
    """The build of these tables: queries of one session share it, until a table's files are other ones."""
    used = [f"{sf_dir.rstrip('/')}/{name}.parquet" for name in ("customer", "nation", "orders", "lineitem")]
    files = Files(spark, used[0])
    key = (spark.sparkContext.applicationId, *((path, *files.listed(path)) for path in used))
    if key not in _last:
        built = build(spark, sf_dir)
        _last.clear()
        _last[key] = built
    return _last[key]


# Each query may be given a build.


def mart(spark: SparkSession, sf_dir: str, name: str, built: Built | None) -> DataFrame:
    return (built or built_once(spark, sf_dir))[2][name]


def dim(spark: SparkSession, sf_dir: str, built: Built | None = None) -> DataFrame:
    return mart(spark, sf_dir, "institution_dim", built)


def fact(spark: SparkSession, sf_dir: str, built: Built | None = None) -> DataFrame:
    return mart(spark, sf_dir, "outcome_fact", built)


def peers(spark: SparkSession, sf_dir: str, built: Built | None = None) -> DataFrame:
    return mart(spark, sf_dir, "peer_report", built)


def equity(spark: SparkSession, sf_dir: str, built: Built | None = None) -> DataFrame:
    return mart(spark, sf_dir, "equity_report", built)


def audit(spark: SparkSession, sf_dir: str, built: Built | None = None) -> DataFrame:
    """The load audit beside the declared checks of the marts."""
    _, loads, marts = built or built_once(spark, sf_dir)
    checks = survey.mart_checks(marts)
    return loads.select(
        F.concat_ws(" ", "family", F.col("year").cast("string"), "status").alias("check_name"),
        F.col("row_count").alias("checked"), F.lit(0).cast("bigint").alias("violations"),
    ).unionByName(checks)


def grid(spark: SparkSession, sf_dir: str, built: Built | None = None) -> DataFrame:
    """The graduation tab's bars over all order years."""
    years = orderbook.order_years(spark, sf_dir)
    rows = dashboard.shown_rows(fact(spark, sf_dir, built), min(years), max(years))
    return dashboard.metric_tab(rows, "graduation_rate_150", years, 1)["bars"]


def highlighted(spark: SparkSession, sf_dir: str, built: Built | None = None) -> DataFrame:
    """The retention tab's lines of the colleges found by a search, the last of them marked, numbered as drawn."""
    years = orderbook.order_years(spark, sf_dir)
    rows = fact(spark, sf_dir, built)
    focus = dashboard.found_names(rows, SEARCHED).select(F.max(dashboard.NAME)).scalar()
    tabs = dashboard.tabs(rows, min(years), max(years), focus=focus, search=SEARCHED)
    return numbered(tabs["retention"]["trend"])


def staged(spark: SparkSession, sf_dir: str, built: Built | None = None) -> DataFrame:
    """Every staged row of every family: its key, how many of its columns hold a value, and a digest of them all."""
    root, _, _ = built or built_once(spark, sf_dir)
    frames = []
    for family in FAMILIES:
        rows = survey.staged_family(spark, f"{root}/landed", family)
        cells = [F.col(c).cast("string") for c in sorted(rows.columns)]
        filled = sum((c.isNotNull().cast("int") for c in cells), F.lit(0))
        text = F.concat_ws("|", *[F.coalesce(c, F.lit("~")) for c in cells])
        frames.append(rows.select(
            "unitid", "year", F.lit(family).alias("family"), filled.alias("filled"),
            F.sha2(text.cast("binary"), 256).alias("digest"),
        ))
    return unite(frames)


def refreshed(spark: SparkSession, sf_dir: str, built: Built | None = None) -> DataFrame:
    """The fact after a correction: built from awards whose newest year is wrong, then brought up to the right ones.

    The second landing brings that year of one family, and only it is scanned again.
    """
    root = scratch_path(spark, "survey")
    years = orderbook.order_years(spark, sf_dir)
    for family, rows in answers(spark, sf_dir).items():
        write_files(rows, f"{root}/raw/{family}")
        if family == "c_a":
            wrong = F.when(F.col("year") == max(years), F.lit(1)).otherwise(F.col("CTOTALT"))
            write_files(rows.withColumn("CTOTALT", wrong), f"{root}/draft/{family}")
    others = Catalogue(f"{root}/raw", {f: years for f in FAMILIES if f != "c_a"}, TEMPLATE)
    survey.land(spark, others, f"{root}/landed")
    survey.land(spark, Catalogue(f"{root}/draft", {"c_a": years}, TEMPLATE), f"{root}/landed")
    survey.write_marts(spark, f"{root}/landed", f"{root}/marts")
    survey.land(spark, Catalogue(f"{root}/raw", {"c_a": [max(years)]}, TEMPLATE), f"{root}/landed")
    return survey.write_marts(spark, f"{root}/landed", f"{root}/marts")["outcome_fact"]


QUERIES = {
    "survey_dim": dim, "survey_fact": fact, "survey_peers": peers, "survey_equity": equity,
    "survey_audit": audit, "survey_grid": grid, "survey_staged": staged,
    "survey_refresh": refreshed, "survey_focus": highlighted,
}
