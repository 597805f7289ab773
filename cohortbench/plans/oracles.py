"""DuckDB SQL for the registered queries, written from their meaning, not from their plans."""

from __future__ import annotations

from cohortbench.plans import vocabulary as v


def with_ctes(*ctes: str, select: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + select


def pct(part: str, total: str) -> str:
    return f"round(({part}) * 100.0 / nullif({total}, 0), 1)"


def doubles(*columns: str) -> str:
    return ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in columns)


def bigints(*columns: str) -> str:
    return ", ".join(f"CAST({c} AS BIGINT) AS {c}" for c in columns)


def dec2(*columns: str) -> str:
    return ", ".join(f"CAST({c} AS DECIMAL(10,2)) AS {c}" for c in columns)


def case_of(code: str, labels: dict[int, str], default: str) -> str:
    arms = " ".join(f"WHEN {k} THEN '{label}'" for k, label in labels.items())
    return f"CASE {code} {arms} ELSE '{default}' END"


def bucket_of(code: str, buckets: dict[str, list[int]], default: str) -> str:
    arms = " ".join(
        f"WHEN {code} IN ({', '.join(map(str, codes))}) THEN '{label}'"
        for label, codes in buckets.items()
    )
    return f"CASE {arms} ELSE '{default}' END"


ORDER_ROWS = """order_rows AS (
  SELECT o_orderkey, o_custkey AS entity_id, year(o_orderdate) AS year, o_orderstatus,
         o_orderpriority, o_totalprice,
         o_orderpriority IN ('1-URGENT', '2-HIGH') AS urgent
  FROM orders)"""

LINE_ROWS = """line_rows AS (
  SELECT o.entity_id, o.year, l.l_linenumber AS code, l.l_returnflag AS grp,
         l.l_linestatus AS status, CAST(l.l_quantity AS DECIMAL(10,0)) AS n
  FROM lineitem l JOIN order_rows o ON l.l_orderkey = o.o_orderkey)"""

COUNTS = """counts AS (
  SELECT entity_id, year,
    sum(n) AS total_units,
    sum(CASE WHEN code = 1 THEN n ELSE 0 END) AS code_1,
    sum(CASE WHEN code = 2 THEN n ELSE 0 END) AS code_2,
    sum(CASE WHEN code = 3 THEN n ELSE 0 END) AS code_3,
    sum(CASE WHEN code IN (1, 2) THEN n ELSE 0 END) AS codes_1_2,
    sum(CASE WHEN code = 3 AND grp = 'A' THEN n ELSE 0 END) AS code_3_a,
    sum(CASE WHEN code = 3 AND grp = 'R' THEN n ELSE 0 END) AS code_3_r,
    sum(CASE WHEN code = 3 AND grp = 'N' THEN n ELSE 0 END) AS code_3_n,
    sum(CASE WHEN code = 3 AND status = 'F' THEN n ELSE 0 END) AS code_3_f,
    sum(CASE WHEN code = 3 AND status = 'O' THEN n ELSE 0 END) AS code_3_o,
    sum(n) AS cohort,
    sum(n) FILTER (WHERE status = 'F') AS completed,
    sum(n) FILTER (WHERE status = 'O' AND grp = 'N') AS transferred,
    sum(n) FILTER (WHERE grp = 'A') AS cohort_a,
    sum(n) FILTER (WHERE grp = 'R') AS cohort_r,
    sum(n) FILTER (WHERE grp = 'N') AS cohort_n,
    sum(n) FILTER (WHERE code <= 3) AS cohort_early,
    sum(n) FILTER (WHERE code > 3) AS cohort_late,
    sum(n) FILTER (WHERE grp = 'A' AND status = 'F') AS completed_a,
    sum(n) FILTER (WHERE grp = 'R' AND status = 'F') AS completed_r,
    sum(n) FILTER (WHERE grp = 'N' AND status = 'F') AS completed_n,
    sum(n) FILTER (WHERE code <= 3 AND status = 'F') AS completed_early,
    sum(n) FILTER (WHERE code > 3 AND status = 'F') AS completed_late
  FROM line_rows GROUP BY entity_id, year)"""

RATED = f"""rated AS (
  SELECT *,
    {pct('code_3_a', 'code_3')} AS pct_a,
    {pct('code_3_r', 'code_3')} AS pct_r,
    {pct('code_3_n', 'code_3')} AS pct_n,
    {pct('code_3_f', 'code_3')} AS pct_f,
    {pct('code_3_o', 'code_3')} AS pct_o,
    {pct('completed', 'cohort')} AS grad_rate,
    {pct('transferred', 'cohort')} AS transfer_rate,
    {pct('completed + coalesce(transferred, 0)', 'cohort')} AS success_rate,
    {pct('completed_a', 'cohort_a')} AS rate_a,
    {pct('completed_r', 'cohort_r')} AS rate_r,
    {pct('completed_n', 'cohort_n')} AS rate_n,
    {pct('completed_early', 'cohort_early')} AS rate_early,
    {pct('completed_late', 'cohort_late')} AS rate_late
  FROM counts)"""

GAPPED = """gapped AS (
  SELECT *, CAST(rate_a - rate_r AS DECIMAL(10,2)) AS gap_r,
            CAST(rate_a - rate_n AS DECIMAL(10,2)) AS gap_n
  FROM rated)"""

RETENTION = f"""retained AS (
  SELECT entity_id, year, count(*) AS entering,
    sum(1) FILTER (WHERE urgent) AS ft_cohort,
    sum(1) FILTER (WHERE urgent AND o_orderstatus = 'F') AS ft_kept,
    sum(1) FILTER (WHERE NOT urgent) AS pt_cohort,
    sum(1) FILTER (WHERE NOT urgent AND o_orderstatus = 'F') AS pt_kept
  FROM order_rows GROUP BY entity_id, year),
retention AS (
  SELECT *,
    {pct('ft_kept', 'ft_cohort')} AS ft_rate,
    {pct('pt_kept', 'pt_cohort')} AS pt_rate,
    {pct('coalesce(ft_kept, 0) + coalesce(pt_kept, 0)',
         'coalesce(ft_cohort, 0) + coalesce(pt_cohort, 0)')} AS overall_rate,
    ft_cohort + pt_cohort AS total_cohort,
    round(CAST(entering AS DOUBLE) / nullif(CAST(ft_cohort AS DOUBLE), 0), 2) AS load_ratio
  FROM retained)"""

PLACED = """placed AS (
  SELECT c_custkey AS entity_id, c_name AS entity_name, n_name AS nation_name,
         r_name AS region_name, c_mktsegment AS segment, c_acctbal AS balance
  FROM customer
  LEFT JOIN nation ON c_nationkey = n_nationkey
  LEFT JOIN region ON n_regionkey = r_regionkey)"""

PEERS = f"""enrolled AS (
  SELECT entity_id, count(*) AS enrollment,
    {pct("count(*) FILTER (WHERE o_orderstatus = 'F')", 'count(*)')} AS pct_filled,
    {pct('count(*) FILTER (WHERE urgent)', 'count(*)')} AS pct_urgent
  FROM order_rows WHERE year = (SELECT max(year) FROM order_rows)
  GROUP BY entity_id),
peers AS (
  SELECT p.*, e.enrollment, e.pct_filled, e.pct_urgent,
    CASE WHEN enrollment < 2 THEN 'Small' WHEN enrollment < 3 THEN 'Medium'
         ELSE 'Large' END AS size_tier,
    CASE WHEN pct_filled >= 33 THEN true ELSE false END AS is_flagged,
    CASE WHEN pct_urgent >= 40 THEN 'High' ELSE 'Lower' END AS share_tier,
    CASE WHEN region_name IN ('AMERICA', 'EUROPE') THEN 'West' ELSE 'Other' END AS place_tier
  FROM placed p LEFT JOIN enrolled e USING (entity_id))"""

DIM = f"""dim AS (
  SELECT p.entity_id, entity_name, nation_name, region_name, segment, enrollment,
    size_tier, is_flagged, share_tier, place_tier,
    {dec2('pct_filled', 'pct_urgent', 'ft_rate', 'pt_rate', 'overall_rate', 'load_ratio')}
  FROM peers p
  LEFT JOIN (SELECT * FROM retention WHERE year = (SELECT max(year) FROM retention)) r
    ON p.entity_id = r.entity_id)"""

FACT_RATES = [
    "pct_a", "pct_r", "pct_n", "pct_f", "pct_o",
    "grad_rate", "transfer_rate", "success_rate",
    "rate_a", "rate_r", "rate_n", "rate_early", "rate_late",
]
FACT_COUNTS = ["total_units", "code_3", "codes_1_2", "code_1", "code_2"]

FACT = f"""spine AS (
  SELECT entity_id, year FROM counts UNION SELECT entity_id, year FROM retention),
fact AS (
  SELECT s.entity_id, c_name AS entity_name, s.year,
    {bigints(*FACT_COUNTS)},
    {dec2(*FACT_RATES)}, gap_r, gap_n,
    {dec2('ft_rate', 'pt_rate', 'overall_rate')},
    CAST(cohort AS BIGINT) AS cohort_size, entering AS entering_size
  FROM spine s
  JOIN customer ON c_custkey = s.entity_id
  LEFT JOIN gapped g ON g.entity_id = s.entity_id AND g.year = s.year
  LEFT JOIN retention r ON r.entity_id = s.entity_id AND r.year = s.year)"""

LINES = (ORDER_ROWS, LINE_ROWS, COUNTS)
RATES = (*LINES, RATED, GAPPED)
FACTS = (*RATES, RETENTION, FACT)
DIMS = (PLACED, PEERS, DIM)
NEWEST = """newest AS (SELECT * FROM fact WHERE year = (SELECT max(year) FROM fact))"""

SEVERITY = """CASE WHEN {g} >= 10 THEN 'Large Gap (10%+)'
    WHEN {g} >= 5 THEN 'Moderate Gap (5-10%)'
    WHEN {g} > 0 THEN 'Small Gap (<5%)'
    WHEN {g} <= 0 THEN 'No Gap / Outperforming'
    ELSE 'Insufficient Data' END AS {g}_severity"""
SEVERITIES = ",\n    ".join(SEVERITY.format(g=g) for g in ("gap_r", "gap_n"))

RET_COLUMNS = (
    f"entity_id, year, entering, {bigints('ft_cohort', 'ft_kept', 'pt_cohort', 'pt_kept')}, "
    "ft_rate, pt_rate, overall_rate, CAST(total_cohort AS BIGINT) AS total_cohort, load_ratio"
)

PEER_AVERAGES = """peer_rows AS (
  SELECT d.entity_id, d.entity_name, size_tier, is_flagged, share_tier, place_tier,
    d.ft_rate AS dim_ft_rate, d.overall_rate AS dim_overall_rate, d.load_ratio,
    f.year, f.grad_rate, f.success_rate, f.code_3
  FROM dim d LEFT JOIN fact f ON d.entity_id = f.entity_id),
averages AS (
  SELECT size_tier, is_flagged, share_tier, place_tier,
    round(avg(grad_rate), 1) AS peer_avg_grad_rate,
    round(avg(success_rate), 1) AS peer_avg_success_rate,
    round(avg(dim_ft_rate), 1) AS peer_avg_ft_rate,
    round(avg(dim_overall_rate), 1) AS peer_avg_overall_rate,
    round(avg(code_3), 0) AS peer_avg_code_3,
    round(avg(load_ratio), 1) AS peer_avg_load_ratio,
    count(*) AS peer_group_count,
    count(DISTINCT entity_id) AS peer_entity_count
  FROM peer_rows GROUP BY size_tier, is_flagged, share_tier, place_tier)"""

EQUITY = """SELECT d.entity_id, d.entity_name, d.is_flagged, d.share_tier,
    CAST(d.pct_filled AS DOUBLE) AS pct_filled, CAST(d.pct_urgent AS DOUBLE) AS pct_urgent,
    CAST(d.overall_rate AS DOUBLE) AS dim_overall_rate, {year}
    CAST(o.grad_rate AS DOUBLE) AS grad_rate, CAST(o.rate_a AS DOUBLE) AS rate_a,
    CAST(o.rate_r AS DOUBLE) AS rate_r, CAST(o.rate_n AS DOUBLE) AS rate_n,
    CAST(o.gap_r AS DOUBLE) AS gap_r, CAST(o.gap_n AS DOUBLE) AS gap_n,
    o.cohort_size,
    c.pct_a AS share_a, c.pct_r AS share_r, c.pct_n AS share_n, c.pct_f AS share_f,
    CAST(c.code_3 AS BIGINT) AS completions,
    {severities},
    round(c.pct_f / nullif(d.pct_filled, 0), 2) AS parity_f
  FROM dim d
  LEFT JOIN fact o ON d.entity_id = o.entity_id
  LEFT JOIN rated c ON {on}"""
EQUITY_SEVERITIES = ",\n    ".join(
    SEVERITY.format(g=g).replace(g + " ", f"o.{g} ") .replace(f"AS o.{g}", f"AS {g}")
    for g in ("gap_r", "gap_n")
)

AUDIT = """loaded AS (
  SELECT 'orders' AS family, year(o_orderdate) AS year, count(*) AS raw_rows,
         count(*) AS row_count FROM orders GROUP BY ALL
  UNION ALL
  SELECT 'lineitem', year(l_shipdate), count(*), count(*) FILTER (WHERE year(l_shipdate) >= 1996)
  FROM lineitem GROUP BY ALL),
expected AS (
  SELECT due AS family, unnest(range(min(year), max(year) + 2)) AS year
  FROM loaded, (VALUES ('orders'), ('lineitem')) f(due) GROUP BY due),
audit AS (
  SELECT family, year, l.row_count,
    CASE WHEN l.raw_rows IS NULL THEN 'not_published' WHEN l.row_count = 0 THEN 'empty'
         ELSE 'ok' END AS status
  FROM expected FULL JOIN loaded l USING (family, year))"""


def unique_check(name: str, relation: str, keys: str) -> str:
    present = " AND ".join(f"{k} IS NOT NULL" for k in keys.split(", "))
    return (
        f"SELECT '{name}' AS check_name, count(*) AS checked, "
        "count(*) FILTER (WHERE copies > 1) AS violations "
        f"FROM (SELECT {keys}, count(*) AS copies FROM {relation} WHERE {present} GROUP BY ALL)"
    )


def not_null_check(name: str, relation: str, column: str) -> str:
    return (
        f"SELECT '{name}' AS check_name, count(*) AS checked, "
        f"count(*) FILTER (WHERE {column} IS NULL) AS violations FROM {relation}"
    )


def relationship_check(child: str, key: str, parent: str, parent_key: str) -> str:
    return (
        f"SELECT '{child}_in_{parent}' AS check_name, count(*) AS checked, "
        f"count(*) FILTER (WHERE c.{key} NOT IN (SELECT {parent_key} FROM {parent} "
        f"WHERE {parent_key} IS NOT NULL)) AS violations "
        f"FROM {child} c WHERE c.{key} IS NOT NULL"
    )


def range_check(name: str, relation: str, column: str, low: float, high: float) -> str:
    return (
        f"SELECT '{name}' AS check_name, count({column}) AS checked, "
        f"count(*) FILTER (WHERE {column} < {low} OR {column} > {high}) AS violations "
        f"FROM {relation}"
    )


def preferred_columns() -> str:
    roles = {"cohort": (7, 1), "completers": (6, 2), "transfers": (5, 3)}
    groups = {"total": "true", "a": "grp = 'A'", "r": "grp = 'R'", "n": "grp = 'N'"}
    return ",\n    ".join(
        f"CAST(coalesce(max(n) FILTER (WHERE code = {a} AND {condition}), "
        f"max(n) FILTER (WHERE code = {b} AND {condition})) AS BIGINT) AS {role}_{g}"
        for role, (a, b) in roles.items()
        for g, condition in groups.items()
    )


def year_columns() -> str:
    return ", ".join(
        f'CAST(max(grad_rate) FILTER (WHERE year = {y}) AS DOUBLE) AS "{y}"'
        for y in range(1995, 2002)
    )


FACT_OUT = (
    f"entity_id, entity_name, year, {', '.join(FACT_COUNTS)}, "
    f"{doubles(*FACT_RATES, 'gap_r', 'gap_n', 'ft_rate', 'pt_rate', 'overall_rate')}, "
    "cohort_size, entering_size"
)

ORACLES: dict[str, str] = {
    "raw_csv_clean_read": """
SELECT o_orderkey, o_custkey,
  CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM') THEN NULL
       ELSE o_totalprice END AS o_totalprice,
  o_orderstatus
FROM orders""",
    "yearly_stamp_union": """
SELECT o_orderkey, o_custkey AS entity_id, year(o_orderdate) AS year,
  CASE WHEN year(o_orderdate) >= 1998 THEN o_orderpriority END AS o_orderpriority, o_orderstatus
FROM orders""",
    "source_precedence": """
SELECT o_orderkey,
  CASE WHEN o_orderstatus = 'P' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
  CASE WHEN o_orderstatus = 'P' THEN 'Orders_RV.csv' ELSE 'orders.csv' END AS source
FROM orders""",
    "mixed_encoding_read": """
SELECT doc_id, lang, source, CASE WHEN trim(text) NOT IN ('', '.', 'NULL') THEN text END AS text
FROM documents""",
    "schema_drift": with_ctes(
        """cells AS (SELECT year(o_orderdate) AS year, o_orderpriority = '1-URGENT' AS urgent,
    CAST(o_totalprice AS DECIMAL(12,2)) AS price FROM orders)""",
        """each AS (SELECT year, count(*) AS n, count(*) FILTER (WHERE urgent) AS urgent,
    count(*) FILTER (WHERE NOT urgent AND price % 1 = 0) AS whole FROM cells GROUP BY year)""",
        select="""SELECT 'KEY' AS column_name, year, 'bigint' AS declared, 'bigint' AS observed, 'fits' AS state, n AS row_count,
  0::BIGINT AS missing, n AS whole, 0::BIGINT AS fractional, 0::BIGINT AS text, 0::BIGINT AS misfits FROM each
UNION ALL SELECT 'CUSTOMER', year, 'bigint', 'bigint', 'fits', n, 0, n, 0, 0, 0 FROM each
UNION ALL SELECT 'PRICE', year, 'bigint', CASE WHEN n > urgent + whole THEN 'decimal' WHEN whole > 0 THEN 'bigint' ELSE 'none' END,
  CASE WHEN n > urgent + whole THEN 'misfits' ELSE 'fits' END, n, urgent, whole, n - urgent - whole, 0, n - urgent - whole FROM each
UNION ALL SELECT 'STATUS', year, NULL, 'string', 'undeclared', n, 0, 0, 0, n, 0 FROM each
UNION ALL SELECT 'PRIORITY', year, 'string', 'none', 'absent', n, n, 0, 0, 0, 0 FROM each WHERE year < 1995
UNION ALL SELECT 'PRIORITY', year, 'string', 'string', 'fits', n, 0, 0, 0, n, 0 FROM each WHERE year >= 1995""",
    ),
    "multiline_records": """
SELECT doc_id, lang, source, n_chars, CASE WHEN trim(text) NOT IN ('', '.', 'NULL') THEN text END AS text
FROM documents""",
    "window_read": with_ctes(
        *FACTS,
        select="""SELECT entity_name, year, CAST(overall_rate AS DOUBLE) AS overall_rate, entering_size,
  row_number() OVER (ORDER BY year, entity_name) AS place
FROM fact WHERE year BETWEEN 1996 AND 1999""",
    ),
    "staged_orders": """
SELECT l_orderkey AS order_id, CAST(l_linenumber AS BIGINT) AS line_code,
  CAST(CAST(l_quantity AS DECIMAL(10,0)) AS DOUBLE) AS unit_count,
  CAST(CAST(l_extendedprice AS DECIMAL(12,0)) AS DOUBLE) AS price_total,
  CAST(CAST(l_discount AS DECIMAL(10,2)) AS DOUBLE) AS discount_rate,
  l_returnflag AS group_code
FROM lineitem""",
    "decode_codes": "SELECT p_partkey, CAST(p_size AS BIGINT) AS code, "
    + ", ".join(
        f"{case_of('p_size', labels, default)} AS {name}"
        for name, (labels, default) in v.DECODES.items()
    )
    + " FROM part",
    "bucket_codes": f"""
SELECT p_partkey, CAST(p_size AS BIGINT) AS code,
  {bucket_of('p_size', v.LOCALE_TYPES, v.UNKNOWN)} AS locale_type,
  {bucket_of('p_size', v.LOCALE_SIZES, v.UNKNOWN)} AS locale_size
FROM part""",
    "grand_total_filter": """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_quantity
FROM lineitem
WHERE l_linestatus = 'F' AND l_returnflag = 'N' AND l_linenumber IN (2, 3, 4, 29, 30, 33)
  AND l_quantity = 50""",
    "qualified_entities": with_ctes(
        ORDER_ROWS,
        PLACED,
        """directory AS (
  SELECT o.*, p.* EXCLUDE (entity_id) FROM (
    SELECT entity_id, year, count(*) AS n_orders, max(o_totalprice) AS top_price,
           bool_or(o_orderstatus = 'O') AS is_active
    FROM order_rows GROUP BY entity_id, year) o JOIN placed p USING (entity_id))""",
        """matching AS (
  SELECT DISTINCT entity_id FROM directory
  WHERE region_name IN ('AMERICA', 'ASIA') AND (
    segment = 'BUILDING'
    OR (balance > 0 AND n_orders = 4)
    OR (balance > 0 AND n_orders BETWEEN 2 AND 3 AND segment = 'FURNITURE')
    OR (balance > 0 AND top_price >= 450000)
    OR (balance > 0 AND (lower(entity_name) LIKE '%#00000012%'
        OR lower(entity_name) LIKE '%#00000034%' OR lower(entity_name) LIKE '%r#7%'))))""",
        select="""SELECT entity_id, entity_name, year, segment, n_orders, top_price
FROM directory
WHERE year = (SELECT max(year) FROM order_rows) AND is_active
  AND region_name IN ('AMERICA', 'ASIA') AND entity_id IN (SELECT entity_id FROM matching)""",
    ),
    "latest_year_rows": with_ctes(
        ORDER_ROWS,
        select="""SELECT o_orderkey, entity_id, year, o_totalprice FROM order_rows
WHERE o_orderstatus = 'F' AND year = (SELECT max(year) FROM order_rows)""",
    ),
    "fact_restricted": with_ctes(
        ORDER_ROWS,
        PLACED,
        select="""SELECT year, count(DISTINCT entity_id) AS entities, count(*) AS row_count
FROM order_rows
WHERE entity_id IN (SELECT entity_id FROM placed
  WHERE region_name IN ('AMERICA', 'ASIA') AND segment IN ('BUILDING', 'MACHINERY'))
GROUP BY year""",
    ),
    "coded_sums": with_ctes(
        *LINES,
        select="SELECT entity_id, year, "
        + bigints(
            "total_units", "code_1", "code_2", "code_3", "codes_1_2",
            "code_3_a", "code_3_r", "code_3_n", "code_3_f", "code_3_o",
        )
        + " FROM counts",
    ),
    "credential_shares": with_ctes(
        *LINES,
        RATED,
        select="SELECT entity_id, year, CAST(code_3 AS BIGINT) AS code_3, "
        "pct_a, pct_r, pct_n, pct_f, pct_o FROM rated",
    ),
    "preferred_pivot": with_ctes(
        ORDER_ROWS,
        LINE_ROWS,
        select=f"SELECT entity_id, year, {preferred_columns()} FROM line_rows GROUP BY entity_id, year",
    ),
    "outcome_rates": with_ctes(
        *LINES,
        RATED,
        select="""SELECT entity_id, year, CAST(cohort AS BIGINT) AS cohort, grad_rate, transfer_rate,
  success_rate, rate_a, rate_r, rate_n, rate_early, rate_late FROM rated""",
    ),
    "gap_severity": with_ctes(
        *RATES,
        select=f"""SELECT entity_id, year, rate_a, rate_r, rate_n, {doubles('gap_r', 'gap_n')},
    {SEVERITIES} FROM gapped""",
    ),
    "blended_retention": with_ctes(ORDER_ROWS, RETENTION, select=f"SELECT {RET_COLUMNS} FROM retention"),
    "peer_attributes": with_ctes(
        ORDER_ROWS, PLACED, PEERS, select="SELECT * EXCLUDE (balance) FROM peers"
    ),
    "dim_entities": with_ctes(
        ORDER_ROWS,
        RETENTION,
        *DIMS,
        select="""SELECT entity_id, entity_name, nation_name, region_name, segment, enrollment,
  size_tier, is_flagged, share_tier, place_tier, """
        + doubles("pct_filled", "pct_urgent", "ft_rate", "pt_rate", "overall_rate", "load_ratio")
        + " FROM dim",
    ),
    "outcome_spine": with_ctes(
        ORDER_ROWS,
        LINE_ROWS,
        select="""SELECT entity_id, year FROM order_rows WHERE o_orderstatus = 'F'
UNION SELECT entity_id, year(l_shipdate) FROM lineitem JOIN order_rows ON l_orderkey = o_orderkey
  WHERE l_linenumber = 1
UNION SELECT entity_id, year(l_shipdate) + 1 FROM lineitem JOIN order_rows ON l_orderkey = o_orderkey
  WHERE l_returnflag = 'R'""",
    ),
    "fact_outcomes": with_ctes(*FACTS, select=f"SELECT {FACT_OUT} FROM fact"),
    "peer_averages": with_ctes(*FACTS, *DIMS, PEER_AVERAGES, select="SELECT * FROM averages"),
    "peer_comparison": with_ctes(
        *FACTS,
        *DIMS,
        PEER_AVERAGES,
        select="""SELECT p.entity_id, p.entity_name, p.size_tier, p.is_flagged, p.share_tier,
  p.place_tier, CAST(p.dim_ft_rate AS DOUBLE) AS dim_ft_rate,
  CAST(p.dim_overall_rate AS DOUBLE) AS dim_overall_rate, CAST(p.load_ratio AS DOUBLE) AS load_ratio,
  p.year, CAST(p.grad_rate AS DOUBLE) AS grad_rate, CAST(p.success_rate AS DOUBLE) AS success_rate,
  p.code_3, a.* EXCLUDE (size_tier, is_flagged, share_tier, place_tier),
  round(p.grad_rate - a.peer_avg_grad_rate, 1) AS grad_rate_vs_peers,
  round(p.success_rate - a.peer_avg_success_rate, 1) AS success_rate_vs_peers,
  round(p.dim_ft_rate - a.peer_avg_ft_rate, 1) AS ft_rate_vs_peers,
  round(p.dim_overall_rate - a.peer_avg_overall_rate, 1) AS overall_rate_vs_peers,
  CASE WHEN p.grad_rate >= a.peer_avg_grad_rate + 5 THEN 'Above Peers'
       WHEN p.grad_rate <= a.peer_avg_grad_rate - 5 THEN 'Below Peers'
       ELSE 'At Peer Average' END AS grad_rate_performance
FROM peer_rows p LEFT JOIN averages a ON p.size_tier = a.size_tier AND p.is_flagged = a.is_flagged
  AND p.share_tier = a.share_tier AND p.place_tier = a.place_tier""",
    ),
    "equity_report": with_ctes(
        *FACTS,
        *DIMS,
        select=EQUITY.format(
            year="o.year,",
            severities=EQUITY_SEVERITIES,
            on="o.entity_id = c.entity_id AND o.year = c.year",
        ),
    ),
    "equity_report_compat": with_ctes(
        *FACTS,
        *DIMS,
        select=EQUITY.format(
            year="", severities=EQUITY_SEVERITIES, on="d.entity_id = c.entity_id"
        ),
    ),
    "overview_cards": with_ctes(
        *FACTS,
        NEWEST,
        select="""SELECT count(DISTINCT entity_id) AS entities, round(avg(grad_rate), 1) AS avg_grad_rate,
  round(avg(ft_rate), 1) AS avg_ft_rate, CAST(sum(code_3) AS BIGINT) AS total_code_3 FROM newest""",
    ),
    "equity_cards": with_ctes(
        *FACTS,
        NEWEST,
        select="SELECT round(avg(gap_r), 1) AS avg_gap_r, round(avg(gap_n), 1) AS avg_gap_n FROM newest",
    ),
    "overview_table": with_ctes(
        *FACTS,
        NEWEST,
        select="""SELECT entity_name AS entity, CAST(grad_rate AS DOUBLE) AS graduation,
  CAST(success_rate AS DOUBLE) AS success, CAST(ft_rate AS DOUBLE) AS retention,
  code_3 AS degrees, total_units AS completions,
  row_number() OVER (ORDER BY grad_rate DESC NULLS LAST, entity_name) AS place FROM newest""",
    ),
    "display_table": with_ctes(
        *FACTS,
        NEWEST,
        select="""SELECT entity_name AS "ENTITY",
  coalesce(printf('%.1f', CAST(grad_rate AS DOUBLE)) || '%', 'N/A') AS "GRADUATION",
  coalesce(printf('%.1f', CAST(success_rate AS DOUBLE)) || '%', 'N/A') AS "SUCCESS",
  coalesce(printf('%.1f', CAST(ft_rate AS DOUBLE)), 'N/A') AS "RETENTION",
  coalesce(format('{:,}', code_3), 'N/A') AS "DEGREES",
  coalesce(format('{:,}', total_units), 'N/A') AS "COMPLETIONS"
FROM newest""",
    ),
    "ranked_metric": with_ctes(
        *FACTS,
        NEWEST,
        select="""SELECT entity_name, CAST(grad_rate AS DOUBLE) AS grad_rate,
  row_number() OVER (ORDER BY grad_rate, entity_name) AS place
FROM newest WHERE grad_rate IS NOT NULL AND entity_name IS NOT NULL""",
    ),
    "metric_trend": with_ctes(
        *FACTS,
        select="""SELECT entity_name, year, CAST(grad_rate AS DOUBLE) AS grad_rate,
  CAST(ft_rate AS DOUBLE) AS ft_rate, code_3, total_units,
  row_number() OVER (ORDER BY entity_name, year) AS place FROM fact""",
    ),
    "year_grid": with_ctes(
        *FACTS,
        select="""SELECT n.entity_id, n.entity_name, y.year, CAST(f.grad_rate AS DOUBLE) AS grad_rate
FROM (SELECT DISTINCT entity_id, entity_name FROM fact) n
CROSS JOIN (SELECT unnest(range(min(year), max(year) + 1)) AS year FROM fact) y
LEFT JOIN fact f ON f.entity_id = n.entity_id AND f.year = y.year""",
    ),
    "pivot_change": with_ctes(
        *FACTS,
        f"""wide AS (SELECT entity_id, entity_name, {year_columns()} FROM fact
  GROUP BY entity_id, entity_name HAVING count(grad_rate) > 0)""",
        select='SELECT *, round("2001" - "1995", 1) AS "Change (1995-01)" FROM wide',
    ),
    "group_rate_long": with_ctes(
        *FACTS,
        NEWEST,
        select=" UNION ALL ".join(
            f"SELECT entity_name, 'Group {g.upper()}' AS member_group, "
            f"CAST(rate_{g} AS DOUBLE) AS rate FROM newest"
            for g in ("a", "r", "n")
        ),
    ),
    "gap_scatter": with_ctes(
        *FACTS,
        NEWEST,
        select=f"""SELECT entity_name, {doubles('gap_r', 'gap_n')} FROM newest
WHERE gap_r IS NOT NULL AND gap_n IS NOT NULL""",
    ),
    "equity_table": with_ctes(
        *FACTS,
        NEWEST,
        select="""SELECT entity_name AS entity, CAST(rate_a AS DOUBLE) AS a_rate,
  CAST(rate_r AS DOUBLE) AS r_rate, CAST(rate_n AS DOUBLE) AS n_rate,
  CAST(gap_r AS DOUBLE) AS r_gap, CAST(gap_n AS DOUBLE) AS n_gap FROM newest""",
    ),
    "entity_search": """
SELECT entity_name, row_number() OVER (ORDER BY entity_name) AS place
FROM (SELECT DISTINCT c_name AS entity_name FROM customer JOIN orders ON o_custkey = c_custkey
      WHERE lower(c_name) LIKE '%r#00000001%')""",
    "entity_selection": with_ctes(
        ORDER_ROWS,
        RETENTION,
        select="""SELECT c_name AS entity_name, year, CAST(overall_rate AS DOUBLE) AS overall_rate,
  CAST(c_name = (SELECT max(c_name) FROM customer WHERE c_mktsegment = 'BUILDING') AS BIGINT)
    AS is_focus
FROM retention JOIN customer ON c_custkey = entity_id WHERE c_mktsegment = 'BUILDING'""",
    ),
    "star_measures": with_ctes(
        *FACTS,
        *DIMS,
        select="""SELECT size_tier, place_tier, year, count(DISTINCT f.entity_id) AS entities,
  avg(grad_rate) AS avg_grad_rate, avg(f.ft_rate) AS avg_ft_rate,
  CAST(sum(code_3) AS BIGINT) AS total_code_3, avg(gap_r) AS avg_gap_r, avg(gap_n) AS avg_gap_n
FROM fact f JOIN dim d ON f.entity_id = d.entity_id GROUP BY size_tier, place_tier, year""",
    ),
    "dq_unique": " UNION ALL ".join(
        (
            unique_check("unique_customer", "customer", "c_custkey"),
            unique_check("unique_orders", "orders", "o_orderkey"),
            unique_check("unique_lineitem", "lineitem", "l_orderkey, l_linenumber"),
            unique_check("unique_conversations", "conversations", "conv_id, turn"),
        )
    ),
    "dq_not_null": with_ctes(
        *RATES,
        select=" UNION ALL ".join(
            (
                not_null_check("not_null_name", "customer", "c_name"),
                not_null_check("not_null_order", "orders", "o_orderkey"),
                not_null_check("not_null_gap_r", "gapped", "gap_r"),
            )
        ),
    ),
    "dq_relationships": " UNION ALL ".join(
        (
            relationship_check("lineitem", "l_orderkey", "orders", "o_orderkey"),
            relationship_check("orders", "o_custkey", "customer", "c_custkey"),
            relationship_check("events", "user_id", "supplier", "s_suppkey"),
            relationship_check("documents", "doc_id", "labels", "doc_id"),
        )
    ),
    "dq_range": with_ctes(
        *LINES,
        RATED,
        select=" UNION ALL ".join(
            (
                range_check("grad_rate_0_100", "rated", "grad_rate", 0, 100),
                range_check("success_rate_0_60", "rated", "success_rate", 0, 60),
                range_check("balance_0_9000", "customer", "c_acctbal", 0, 9000),
            )
        ),
    ),
    "dq_fact_key": with_ctes(
        *FACTS,
        select=" UNION ALL ".join(
            (
                unique_check("fact_key", "fact", "entity_id, year"),
                unique_check("order_key", "order_rows", "entity_id, year"),
            )
        ),
    ),
    "thin_years": with_ctes(
        AUDIT,
        """medians AS (
  SELECT family, median(row_count) AS median_rows, count(*) AS years
  FROM audit WHERE status = 'ok' GROUP BY family)""",
        select="""SELECT a.family, a.year, a.row_count, m.median_rows
FROM audit a JOIN medians m ON a.family = m.family
WHERE a.status = 'ok' AND m.years >= 3 AND m.median_rows > 0 AND a.row_count < m.median_rows * 0.6""",
    ),
    "load_summary": with_ctes(
        AUDIT,
        select="""SELECT status, count(*) AS files,
  string_agg(family || ' ' || year, ', ' ORDER BY family, year) AS members,
  row_number() OVER (ORDER BY status) AS place
FROM audit GROUP BY status""",
    ),
    "guards": """
SELECT 'entity_set' AS guard, count(*) > 0 AS passed, count(*) AS seen FROM customer
UNION ALL SELECT 'window_1996_1999', count(*) > 0, count(*) FROM orders
  WHERE year(o_orderdate) BETWEEN 1996 AND 1999
UNION ALL SELECT 'window_2010_2012', count(*) > 0, count(*) FROM orders
  WHERE year(o_orderdate) BETWEEN 2010 AND 2012
UNION ALL SELECT 'required_columns', false, count(*) FROM orders""",
    "export_roundtrip": with_ctes(
        ORDER_ROWS,
        RETENTION,
        select="""SELECT f.format, entity_id, year, entering, ft_rate, pt_rate, overall_rate,
  (SELECT count(*) FROM retention) AS row_count
FROM retention CROSS JOIN (VALUES ('csv'), ('parquet')) f(format)""",
    ),
    "export_json": with_ctes(
        *FACTS,
        select="""SELECT entity_name AS entity, year, CAST(grad_rate AS DOUBLE) AS grad_rate,
  CAST(ft_rate AS DOUBLE) AS retention, code_3 AS degrees, CAST(gap_r AS DOUBLE) AS gap_r,
  dense_rank() OVER (ORDER BY year) - 1 AS year_number, count(*) OVER () AS published
FROM fact WHERE year BETWEEN 1996 AND 1999""",
    ),
}
ORACLES["preferred_source"] = ORACLES["source_precedence"]
ORACLES["search_by_index"] = """
SELECT entity_name, row_number() OVER (ORDER BY entity_name) AS place
FROM (SELECT DISTINCT c_name AS entity_name FROM customer WHERE lower(c_name) LIKE '%r#0000001%')"""


def _mean(column: str) -> str:
    """One division of the exact sum of a column with two digits."""
    return f"CAST(sum(CAST({column} * 100 AS BIGINT)) AS DOUBLE) / CAST(nullif(count({column}), 0) * 100 AS DOUBLE)"


def _rolled_up(by: list[str]) -> str:
    """The measures straight from the fact, by one choice of dimensions."""
    dims = ", ".join(f"CAST({d} AS VARCHAR) AS {d}" if d in by else f"CAST(NULL AS VARCHAR) AS {d}"
                     for d in ("size_tier", "place_tier", "share_tier", "year"))
    grouped = f" GROUP BY {', '.join(by)}" if by else ""
    return f"""SELECT '{','.join(by)}' AS dims, {dims}, count(DISTINCT f.entity_id) AS entities,
  {_mean('grad_rate')} AS avg_grad_rate, {_mean('gap_r')} AS avg_gap_r, CAST(sum(code_3) AS BIGINT) AS total_code_3
FROM fact f JOIN dim d ON f.entity_id = d.entity_id{grouped}"""


ORACLES["star_cube"] = with_ctes(*FACTS, *DIMS, select=" UNION ALL ".join(_rolled_up(by) for by in (
    ["size_tier"], ["place_tier", "year"], ["share_tier", "size_tier", "place_tier"], ["year"], [])))
ORACLES["error_states"] = with_ctes(
    AUDIT,
    """states AS (SELECT family, year, row_count, CASE WHEN family = 'lineitem' AND row_count IS NOT NULL
    AND year >= (SELECT max(year) FROM audit WHERE status = 'ok') - 1 THEN 'error' ELSE status END AS status FROM audit)""",
    """medians AS (SELECT family, median(row_count) AS median_rows, count(*) AS years
  FROM states WHERE status = 'ok' GROUP BY family)""",
    """thin AS (SELECT count(*) AS n FROM states s JOIN medians m ON s.family = m.family
  WHERE s.status = 'ok' AND m.years >= 3 AND m.median_rows > 0 AND s.row_count < m.median_rows * 0.6)""",
    select="""SELECT count(*) FILTER (WHERE status = 'ok') AS ok, count(*) FILTER (WHERE status = 'not_published') AS not_published,
  count(*) FILTER (WHERE status = 'empty') + (SELECT n FROM thin) AS suspect, count(*) FILTER (WHERE status = 'error') AS errors
FROM states""",
)
ORACLES["colocated_models"] = with_ctes(
    ORDER_ROWS, LINE_ROWS, RETENTION,
    "a AS (SELECT entity_id, year, entering FROM retention)",
    "b AS (SELECT entity_id, year, sum(n) AS total_units FROM line_rows GROUP BY ALL)",
    "c AS (SELECT entity_id, year + 1 AS year, count(*) AS finished FROM order_rows WHERE o_orderstatus = 'F' GROUP BY ALL)",
    "spine AS (SELECT entity_id, year FROM a UNION SELECT entity_id, year FROM b UNION SELECT entity_id, year FROM c)",
    select="""SELECT s.entity_id, CAST(s.year AS BIGINT) AS year, CAST(entering AS BIGINT) AS entering,
  CAST(total_units AS BIGINT) AS total_units, finished
FROM spine s LEFT JOIN a ON a.entity_id = s.entity_id AND a.year = s.year
LEFT JOIN b ON b.entity_id = s.entity_id AND b.year = s.year
LEFT JOIN c ON c.entity_id = s.entity_id AND c.year = s.year""",
)
