"""DuckDB SQL of the survey marts, from the families' relations and the meaning of each column."""

from __future__ import annotations

import re

from cohortbench.plans import vocabulary as v
from cohortbench.plans.oracles import (
    LINE_ROWS,
    ORDER_ROWS,
    bucket_of,
    case_of,
    dec2,
    doubles,
    pct,
    with_ctes,
)
from cohortbench.plans.surveyed import FAMILIES


def family(name: str) -> str:
    return f"{name}_all AS (SELECT * FROM ({FAMILIES[name]}))"


def landed(name: str) -> str:
    return f"{name} AS (SELECT * FROM {name}_all WHERE UNITID IN (SELECT UNITID FROM hd))"


LANDED = (
    ORDER_ROWS, LINE_ROWS, family("hd"),
    "hd AS (SELECT * FROM hd_all WHERE STABBR = 'TX' AND SECTOR IN (1, 4))",
    *[x for name in ("effy", "sfa", "c_a", "gr", "ef_d") for x in (family(name), landed(name))],
)

MEMBERS = f"""members AS (
  SELECT UNITID AS unitid, INSTNM AS institution_name, CITY AS city, STABBR AS state_code,
    {case_of('SECTOR', v.SECTORS, v.UNKNOWN)} AS sector_name,
    {case_of('CONTROL', v.CONTROLS, v.UNKNOWN)} AS control_name,
    {bucket_of('LOCALE', v.LOCALE_TYPES, v.UNKNOWN)} AS locale_type,
    {case_of('INSTSIZE', v.SIZE_CATEGORIES, 'Not reported')} AS size_category_name
  FROM hd WHERE year = (SELECT max(year) FROM hd) AND CYACTIVE = 1 AND UNITID IN (
    SELECT UNITID FROM hd WHERE SECTOR = 4 OR (CONTROL = 1 AND (
      ICLEVEL = 2 OR C21BASIC BETWEEN 2 AND 10 OR HDEGOFR1 = 3))))"""

COMPLETIONS = f"""done AS (
  SELECT UNITID AS unitid, year, sum(CTOTALT) AS total_completions,
    sum(CASE WHEN AWLEVEL = 1 THEN CTOTALT ELSE 0 END) AS certificates_under_1yr,
    sum(CASE WHEN AWLEVEL = 2 THEN CTOTALT ELSE 0 END) AS certificates_1_2yr,
    sum(CASE WHEN AWLEVEL IN (1, 2) THEN CTOTALT ELSE 0 END) AS total_certificates,
    sum(CASE WHEN AWLEVEL = 3 THEN CTOTALT ELSE 0 END) AS associate_degrees,
    sum(CASE WHEN AWLEVEL = 3 THEN CHISPT ELSE 0 END) AS associate_hispanic,
    sum(CASE WHEN AWLEVEL = 3 THEN CBKAAT ELSE 0 END) AS associate_black,
    sum(CASE WHEN AWLEVEL = 3 THEN CWHITT ELSE 0 END) AS associate_white,
    sum(CASE WHEN AWLEVEL = 3 THEN CTOTALM ELSE 0 END) AS associate_men,
    sum(CASE WHEN AWLEVEL = 3 THEN CTOTALW ELSE 0 END) AS associate_women
  FROM c_a WHERE CIPCODE = '99' AND MAJORNUM = 1 AND UNITID IN (SELECT unitid FROM members)
  GROUP BY UNITID, year),
completions AS (SELECT *, {', '.join(
    f"{pct(f'associate_{g}', 'associate_degrees')} AS pct_associate_{g}"
    for g in ('hispanic', 'black', 'white', 'men', 'women'))} FROM done)"""

ROLES = {"cohort": (29, 2), "completers": (30, 3), "transfers": (33, 4)}
SIDES = {"all": "GRTOTLT", "hispanic": "GRHISPT", "black": "GRBKAAT", "white": "GRWHITT",
         "men": "GRTOTLM", "women": "GRTOTLW"}

GRADUATION = f"""wide AS (
  SELECT UNITID AS unitid, year, {', '.join(
    f"coalesce(max({c}) FILTER (WHERE GRTYPE = {a}), max({c}) FILTER (WHERE GRTYPE = {b})) AS {role}_{side}"
    for role, (a, b) in ROLES.items() for side, c in SIDES.items())}
  FROM gr WHERE GRTYPE IN (29, 2, 30, 3, 33, 4) AND UNITID IN (SELECT unitid FROM members)
  GROUP BY UNITID, year),
rated AS (SELECT *, {pct('completers_all', 'cohort_all')} AS graduation_rate_150,
    {pct('transfers_all', 'cohort_all')} AS transfer_out_rate,
    {pct('completers_all + coalesce(transfers_all, 0)', 'cohort_all')} AS success_rate, {', '.join(
    f"{pct(f'completers_{g}', f'cohort_{g}')} AS grad_rate_{g}"
    for g in ('hispanic', 'black', 'white', 'men', 'women'))} FROM wide),
graduation AS (SELECT *,
    CAST(grad_rate_white - grad_rate_hispanic AS DECIMAL(10,2)) AS equity_gap_hispanic,
    CAST(grad_rate_white - grad_rate_black AS DECIMAL(10,2)) AS equity_gap_black FROM rated)"""

RETENTION = f"""retention AS (
  SELECT UNITID AS unitid, year, RET_PCF AS full_time_retention_rate,
    RET_PCP AS part_time_retention_rate, STUFACR AS student_faculty_ratio,
    UGENTERN AS total_entering_undergrads,
    {pct('coalesce(RET_NMF, 0) + coalesce(RET_NMP, 0)',
         'coalesce(RRFTCTA, 0) + coalesce(RRPTCTA, 0)')} AS overall_retention_rate
  FROM ef_d WHERE UNITID IN (SELECT unitid FROM members))"""

DIM = f"""described AS (
  SELECT m.*, e.EFYTOTLT AS total_enrollment, {', '.join(
    f"{pct(f'e.{c}', 'e.EFYTOTLT')} AS pct_{g}"
    for g, c in (('hispanic', 'EFYHISPT'), ('black', 'EFYBKAAT'), ('white', 'EFYWHITT')))},
    CAST(s.UPGRNTP AS DOUBLE) AS pct_pell
  FROM members m
  LEFT JOIN (SELECT * FROM effy WHERE year = (SELECT max(year) FROM effy) AND EFFYALEV = 1) e USING (unitid)
  LEFT JOIN (SELECT * FROM sfa WHERE year = (SELECT max(year) FROM sfa)) s USING (unitid)),
dim AS (
  SELECT d.unitid, institution_name, city, state_code, sector_name, control_name,
    size_category_name, locale_type, total_enrollment,
    CASE WHEN total_enrollment < 5000 THEN 'Small' WHEN total_enrollment < 15000 THEN 'Medium'
         ELSE 'Large' END AS size_tier,
    coalesce(pct_hispanic >= 25, false) AS is_hsi,
    CASE WHEN pct_pell >= 40 THEN 'High Pell' ELSE 'Lower Pell' END AS pell_tier,
    CASE WHEN locale_type IN ('City', 'Suburb') THEN 'Urban/Suburban' ELSE 'Town/Rural' END AS urbanicity,
    {dec2('pct_hispanic', 'pct_black', 'pct_white', 'pct_pell', 'full_time_retention_rate',
          'part_time_retention_rate', 'overall_retention_rate', 'student_faculty_ratio')}
  FROM described d LEFT JOIN (
    SELECT * FROM retention WHERE year = (SELECT max(year) FROM retention)) r USING (unitid))"""

COUNTS = ["total_completions", "associate_degrees", "total_certificates",
          "certificates_under_1yr", "certificates_1_2yr"]
RATES = [
    *[f"pct_associate_{g}" for g in ("hispanic", "black", "white", "men", "women")],
    "graduation_rate_150", "transfer_out_rate", "success_rate",
    *[f"grad_rate_{g}" for g in ("hispanic", "black", "white", "men", "women")],
    "equity_gap_hispanic", "equity_gap_black", "full_time_retention_rate",
    "part_time_retention_rate", "overall_retention_rate",
]

FACT = f"""spine AS (
  SELECT unitid, year FROM completions UNION SELECT unitid, year FROM graduation
  UNION SELECT unitid, year FROM retention),
fact AS (
  SELECT s.unitid, m.institution_name, s.year, {', '.join(COUNTS)}, {dec2(*RATES)},
    cohort_all AS graduation_cohort_size, total_entering_undergrads AS retention_cohort_size
  FROM spine s JOIN members m USING (unitid)
  LEFT JOIN completions c ON c.unitid = s.unitid AND c.year = s.year
  LEFT JOIN graduation g ON g.unitid = s.unitid AND g.year = s.year
  LEFT JOIN retention r ON r.unitid = s.unitid AND r.year = s.year)"""

MARTS = (*LANDED, MEMBERS, COMPLETIONS, GRADUATION, RETENTION, DIM, FACT)

TIERS = ["size_tier", "is_hsi", "pell_tier", "urbanicity"]
MEANS = {
    "peer_avg_grad_rate": ("graduation_rate_150", 1),
    "peer_avg_success_rate": ("success_rate", 1),
    "peer_avg_ft_retention": ("full_time_retention_rate", 1),
    "peer_avg_overall_retention": ("overall_retention_rate", 1),
    "peer_avg_associate_degrees": ("associate_degrees", 0),
    "peer_avg_student_faculty_ratio": ("student_faculty_ratio", 1),
}
PEERS = f"""peer_rows AS (
  SELECT d.*, f.year, f.graduation_rate_150, f.success_rate, f.associate_degrees
  FROM dim d LEFT JOIN fact f USING (unitid)),
means AS (
  SELECT {', '.join(TIERS)}, {', '.join(f'round(avg({c}), {d}) AS {n}' for n, (c, d) in MEANS.items())},
    count(*) AS peer_group_count, count(DISTINCT unitid) AS peer_entity_count
  FROM peer_rows GROUP BY ALL)"""


def severity(gap: str, name: str) -> str:
    return (
        f"CASE WHEN {gap} IS NULL THEN 'Insufficient Data' WHEN {gap} <= 0 THEN 'No Gap / Outperforming' "
        f"WHEN {gap} < 5 THEN 'Small Gap (<5%)' WHEN {gap} < 10 THEN 'Moderate Gap (5-10%)' "
        f"ELSE 'Large Gap (10%+)' END AS {name}"
    )


RACES = ("hispanic", "black", "white")

CHECKED = {
    "dim_unique": ("count(DISTINCT unitid)", "count(unitid) - count(DISTINCT unitid)", "dim"),
    "dim_id_not_null": ("count(*)", "count(*) FILTER (WHERE unitid IS NULL)", "dim"),
    "dim_name_not_null": ("count(*)", "count(*) FILTER (WHERE institution_name IS NULL)", "dim"),
    "fact_id_not_null": ("count(*)", "count(*) FILTER (WHERE unitid IS NULL)", "fact"),
    "fact_in_dim": ("count(*)", "count(*) FILTER (WHERE unitid NOT IN (SELECT unitid FROM dim))", "fact"),
    "fact_graduation_rate": (
        "count(graduation_rate_150)", "count(*) FILTER (WHERE graduation_rate_150 NOT BETWEEN 0 AND 100)", "fact"),
    "fact_key_unique": ("count(DISTINCT (unitid, year))", "count(*) - count(DISTINCT (unitid, year))", "fact"),
    "peers_id_not_null": ("count(*)", "count(*) FILTER (WHERE unitid IS NULL)", "peer_rows"),
    "equity_id_not_null": ("count(*)", "count(*) FILTER (WHERE unitid IS NULL)", "peer_rows"),
}

AUDIT = " UNION ALL ".join(
    f"SELECT '{name}' AS family, y.year, f.n, a.n AS raw FROM years y "
    f"LEFT JOIN (SELECT year, count(*) AS n FROM {name}_all GROUP BY year) a USING (year) "
    f"LEFT JOIN (SELECT year, count(*) AS n FROM {name} GROUP BY year) f USING (year)"
    for name in FAMILIES
)

SQL_TYPES = {"int": "INTEGER", "string": "VARCHAR"}


def staged(name: str) -> str:
    """All staged columns of a family, as text in the order of their names; those its files lack are null."""
    published = set(re.findall(r"AS (\w+)", FAMILIES[name]))
    cells, codes = {"year": "CAST(year AS VARCHAR)"}, {}
    for source, (column, kind) in v.STAGED[name].items():
        codes[column] = source if source in published else "CAST(NULL AS INTEGER)"
        value = source if source in published else "NULL"
        cells[column] = f"CAST(CAST({value} AS {SQL_TYPES.get(kind, kind)}) AS VARCHAR)"
    for label, column in v.STAGED_DECODES[name].items():
        cells[label] = case_of(codes[column], *v.DECODES[label])
    if name == "hd":
        cells["locale_type"] = bucket_of("LOCALE", v.LOCALE_TYPES, v.UNKNOWN)
        cells["locale_size"] = bucket_of("LOCALE", v.LOCALE_SIZES, v.UNKNOWN)
    ordered = [cells[c] for c in sorted(cells)]
    filled = " + ".join(f"({c} IS NOT NULL)::BIGINT" for c in ordered)
    text = ", ".join(f"coalesce({c}, '~')" for c in ordered)
    rows = f"{name} WHERE MAJORNUM = 1" if name == "c_a" else name
    return (f"SELECT UNITID AS unitid, CAST(year AS BIGINT) AS year, '{name}' AS family, "
            f"{filled} AS filled, sha256(concat_ws('|', {text})) AS digest FROM {rows}")


ORACLES: dict[str, str] = {
    "survey_dim": with_ctes(
        *MARTS,
        select=f"""SELECT unitid, institution_name, city, state_code, CAST(NULL AS DOUBLE) AS latitude,
  CAST(NULL AS DOUBLE) AS longitude, CAST(NULL AS VARCHAR) AS website_url, sector_name, control_name,
  size_category_name, locale_type, {doubles('total_enrollment')}, {', '.join(TIERS)},
  {doubles('pct_hispanic', 'pct_black', 'pct_white', 'pct_pell', 'full_time_retention_rate',
           'part_time_retention_rate', 'overall_retention_rate', 'student_faculty_ratio')} FROM dim""",
    ),
    "survey_fact": with_ctes(
        *MARTS,
        select=f"""SELECT unitid, institution_name, CAST(year AS BIGINT) AS year,
  {doubles(*COUNTS, *RATES, 'graduation_cohort_size', 'retention_cohort_size')} FROM fact""",
    ),
    "survey_peers": with_ctes(
        *MARTS,
        PEERS,
        select=f"""SELECT p.unitid, p.institution_name, p.city, {', '.join(f'p.{t}' for t in TIERS)},
  peer_group_count, CAST(p.year AS BIGINT) AS year, peer_entity_count,
  {', '.join(f'CAST(p.{c} AS DOUBLE) AS {c}' for c, _ in MEANS.values())}, {', '.join(MEANS)},
  {', '.join(f'round(p.{MEANS[m][0]} - {m}, 1) AS {n}' for n, m in (
      ('grad_rate_vs_peers', 'peer_avg_grad_rate'), ('success_rate_vs_peers', 'peer_avg_success_rate'),
      ('ft_retention_vs_peers', 'peer_avg_ft_retention'),
      ('overall_retention_vs_peers', 'peer_avg_overall_retention')))},
  CASE WHEN p.graduation_rate_150 >= peer_avg_grad_rate + 5 THEN 'Above Peers'
       WHEN p.graduation_rate_150 <= peer_avg_grad_rate - 5 THEN 'Below Peers'
       ELSE 'At Peer Average' END AS grad_rate_performance
FROM peer_rows p LEFT JOIN means USING ({', '.join(TIERS)})""",
    ),
    "survey_equity": with_ctes(
        *MARTS,
        select=f"""SELECT d.unitid, d.institution_name, CAST(f.year AS BIGINT) AS year, d.city, is_hsi, pell_tier,
  {doubles('total_enrollment', 'pct_hispanic', 'pct_black', 'pct_white', 'pct_pell')},
  CAST(f.graduation_rate_150 AS DOUBLE) AS overall_grad_rate,
  {doubles(*[f'grad_rate_{g}' for g in (*RACES, 'men', 'women')], 'equity_gap_hispanic', 'equity_gap_black')
    .replace('CAST(', 'CAST(f.')},
  {severity('f.equity_gap_hispanic', 'hispanic_gap_severity')},
  {severity('f.equity_gap_black', 'black_gap_severity')},
  {', '.join(f'c.pct_associate_{g} AS pct_associate_{g}' for g in RACES)},
  {', '.join(f'round(c.pct_associate_{g} / nullif(CAST(d.pct_{g} AS DOUBLE), 0), 2) '
             f'AS {g}_completion_equity_index' for g in RACES)},
  CAST(f.pct_associate_men AS DOUBLE) AS pct_associate_men,
  CAST(f.pct_associate_women AS DOUBLE) AS pct_associate_women,
  CAST(d.overall_retention_rate AS DOUBLE) AS overall_retention_rate,
  CAST(f.graduation_cohort_size AS DOUBLE) AS graduation_cohort_size,
  {', '.join(f'CAST(c.associate_{g} AS DOUBLE) AS associate_{g}' for g in RACES)}
FROM dim d LEFT JOIN fact f ON f.unitid = d.unitid
LEFT JOIN completions c ON c.unitid = f.unitid AND c.year = f.year""",
    ),
    "survey_audit": with_ctes(
        *MARTS,
        PEERS,
        "years AS (SELECT unnest(range(min(year), max(year) + 1)) AS year FROM order_rows)",
        select=f"""SELECT family || ' ' || year || ' ' || CASE WHEN raw IS NULL THEN 'not_published'
    WHEN n IS NULL THEN 'empty' ELSE 'ok' END AS check_name, coalesce(n, 0) AS checked, 0::BIGINT AS violations
FROM ({AUDIT})
UNION ALL """
        + " UNION ALL ".join(
            f"SELECT '{name}', {n}, {bad} FROM {relation}" for name, (n, bad, relation) in CHECKED.items()
        ),
    ),
    "survey_grid": with_ctes(
        *MARTS,
        select="""SELECT n.unitid, n.institution_name, CAST(y.year AS BIGINT) AS year,
  CAST(f.graduation_rate_150 AS DOUBLE) AS graduation_rate_150
FROM (SELECT DISTINCT unitid, institution_name FROM fact
      WHERE year IN (SELECT year FROM fact WHERE graduation_rate_150 IS NOT NULL)) n
CROSS JOIN (SELECT DISTINCT year FROM fact WHERE graduation_rate_150 IS NOT NULL) y
LEFT JOIN fact f ON f.unitid = n.unitid AND f.year = y.year""",
    ),
    "survey_staged": with_ctes(*LANDED, select=" UNION ALL ".join(staged(name) for name in FAMILIES)),
}
ORACLES["survey_refresh"] = ORACLES["survey_fact"]
ORACLES["survey_focus"] = with_ctes(
    *MARTS,
    "found AS (SELECT * FROM fact WHERE lower(institution_name) LIKE '%r#00000%')",
    select="""SELECT institution_name, CAST(year AS BIGINT) AS year, CAST(full_time_retention_rate AS DOUBLE) AS full_time_retention_rate,
  CAST(is_focus AS BIGINT) AS is_focus, row_number() OVER (ORDER BY is_focus, institution_name, year) AS place
FROM (SELECT *, (institution_name = (SELECT max(institution_name) FROM found))::INT AS is_focus FROM found)""",
)
