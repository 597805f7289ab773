"""Words of the yearly college survey: file columns, code lists, renames, types.

The operators know none of this; the survey plan passes it in. Column names are
those of the public data dictionary, in upper case as cleaned on reading.
"""

from __future__ import annotations

from cohortbench.functions.rates import COUNT, MONEY_TOTAL

UNKNOWN = "Unknown"

# Families and the years published for each. Completions, enrollment and the
# directory come out about a year before the others.
FAMILY_YEARS = {
    "c_a": range(2020, 2026),
    "ef_d": range(2020, 2025),
    "effy": range(2020, 2026),
    "gr": range(2020, 2025),
    "hd": range(2020, 2026),
    "sfa": range(2020, 2025),
}

# --- code lists (fixed values) ------------------------------------------------

AWARD_LEVELS = {
    1: "Award < 1 year",
    2: "Award 1-2 years",
    3: "Associate degree",
    4: "Award 2-4 years",
    5: "Bachelors degree",
    6: "Postbaccalaureate certificate",
    7: "Masters degree",
    8: "Post-masters certificate",
    9: "Doctors degree - research",
    10: "Doctors degree - professional",
    11: "Doctors degree - other",
    12: "Award 4+ years",
}

STUDENT_LEVELS = {
    1: "All students",
    2: "Undergraduate",
    4: "Graduate",
    21: "Undergrad degree-seeking",
    22: "Undergrad non-degree-seeking",
}

COHORT_TYPES = {
    1: "4-year institutions",
    2: "Adjusted cohort (revised cohort minus exclusions)",
    3: "Completers within 150% of normal time",
    4: "Transfer-out students",
    6: "Bachelor degree-seeking subcohort (4-year)",
    7: "Bachelor subcohort exclusions (4-year)",
    8: "Adjusted cohort (revised cohort minus exclusions)",
    9: "Completers within 150% of normal time total",
    10: "Completers of programs < 2 years (150% time)",
    11: "Completers of programs 2 to <4 years (150% time)",
    12: "Completers of bachelor degrees total (150% time)",
    13: "Completers of bachelor degrees in 4 years or less",
    14: "Completers of bachelor degrees in 5 years",
    15: "Completers of bachelor degrees in 6 years",
    16: "Transfer-out students",
    18: "Other degree-seeking subcohort (4-year)",
    19: "Other degree-seeking subcohort exclusions (4-year)",
    20: "Adjusted cohort (revised cohort minus exclusions)",
    21: "Completers within 150% of normal time total",
    22: "Completers of programs < 2 years (150% time)",
    23: "Completers of programs 2 to <4 years (150% time)",
    24: "Completers of bachelor degrees (150% time)",
    25: "Transfer-out students",
    27: "Degree/certificate-seeking students (2-year)",
    28: "Degree/certificate-seeking exclusions (2-year)",
    29: "Adjusted cohort (revised cohort minus exclusions) [2-YEAR]",
    30: "Completers within 150% of normal time total [2-YEAR]",
    31: "Completers of programs < 2 years (150% time) [2-YEAR]",
    32: "Completers of programs 2 to <4 years (150% time) [2-YEAR]",
    33: "Transfer-out students [2-YEAR]",
    35: "Completers within 100% of normal time total [2-YEAR]",
    36: "Completers of programs < 2 years (100% time) [2-YEAR]",
    37: "Completers of programs 2 to <4 years (100% time) [2-YEAR]",
    40: "Total exclusions 4-year schools",
    41: "Still enrolled",
    42: "No longer enrolled",
    43: "Still enrolled",
    44: "No longer enrolled",
    45: "Still enrolled",
    46: "No longer enrolled",
    47: "Still enrolled [2-YEAR]",
    48: "No longer enrolled [2-YEAR]",
}

COHORT_STATUSES = {
    10: "Revised cohort",
    11: "Exclusions",
    12: "Adjusted cohort (revised cohort minus exclusions)",
    13: "Completers within 150% of normal time",
    14: "Completers of programs < 2 years (150% time)",
    15: "Completers of programs 2 to <4 years (150% time)",
    16: "Completers of bachelor degrees (150% time)",
    17: "Completers of bachelor degrees in 4 years or less",
    18: "Completers of bachelor degrees in 5 years",
    19: "Completers of bachelor degrees in 6 years",
    20: "Transfer-out students",
    22: "Completers within 100% of normal time total",
    23: "Completers of programs < 2 years (100% time)",
    24: "Completers of programs 2 to <4 years (100% time)",
    31: "Still enrolled",
    32: "No longer enrolled",
}

SECTORS = {
    1: "Public 4-year",
    2: "Private nonprofit 4-year",
    3: "Private for-profit 4-year",
    4: "Public 2-year",
    5: "Private nonprofit 2-year",
    6: "Private for-profit 2-year",
    7: "Public less-than-2-year",
    8: "Private nonprofit less-than-2-year",
    9: "Private for-profit less-than-2-year",
}

INSTITUTION_LEVELS = {
    1: "Four or more years",
    2: "At least 2 but less than 4 years",
    3: "Less than 2 years",
}

CONTROLS = {1: "Public", 2: "Private nonprofit", 3: "Private for-profit"}

SIZE_CATEGORIES = {
    1: "Under 1,000",
    2: "1,000 - 4,999",
    3: "5,000 - 9,999",
    4: "10,000 - 19,999",
    5: "20,000 and above",
}

LOCALE_TYPES = {
    "City": [11, 12, 13],
    "Suburb": [21, 22, 23],
    "Town": [31, 32, 33],
    "Rural": [41, 42, 43],
}

LOCALE_SIZES = {
    "Large": [11, 21, 31, 41],
    "Midsize": [12, 22, 32, 42],
    "Small": [13, 23, 33, 43],
}

# Output column: (labels, label of an unlisted or missing code).
DECODES = {
    "award_level_name": (AWARD_LEVELS, UNKNOWN),
    "student_level_name": (STUDENT_LEVELS, "Other"),
    "cohort_type_description": (COHORT_TYPES, "Other cohort type"),
    "cohort_status_description": (COHORT_STATUSES, "Other status"),
    "sector_name": (SECTORS, UNKNOWN),
    "institution_level_name": (INSTITUTION_LEVELS, UNKNOWN),
    "control_name": (CONTROLS, UNKNOWN),
    "size_category_name": (SIZE_CATEGORIES, "Not reported"),
}

# --- count blocks (by rule) ----------------------------------------------------

# Demographic parts of a count column, <prefix><group><sex>.
GROUPS = {
    "AIAN": "amer_indian",
    "ASIA": "asian",
    "BKAA": "black",
    "HISP": "hispanic",
    "NHPI": "native_hawaiian",
    "WHIT": "white",
    "2MOR": "two_or_more",
    "UNKN": "race_unknown",
    "NRAL": "nonresident",
}
SEXES = {"T": "total", "M": "men", "W": "women"}


def count_block(prefix: str, total_part: str, total_name: str) -> dict[str, tuple[str, str]]:
    """File column to (output column, type) for a total and nine groups by sex."""
    block = {
        f"{prefix}{total_part}{sex}": (total_name if sex == "T" else f"{total_name}_{word}", COUNT)
        for sex, word in SEXES.items()
    }
    for part, group in GROUPS.items():
        for sex, word in SEXES.items():
            block[f"{prefix}{part}{sex}"] = (f"{group}_{word}", COUNT)
    return block


# The last letter of an aid column tells what it holds.
AID_MEASURES = {
    "N": ("recipients_count", COUNT),
    "P": ("recipients_percent", "double"),
    "T": ("total_amount", MONEY_TOTAL),
    "A": ("avg_amount", COUNT),
}


def aid_block(prefix: str, name: str, measures: str = "NPTA") -> dict[str, tuple[str, str]]:
    return {
        f"{prefix}{m}": (f"{name}_{AID_MEASURES[m][0]}", AID_MEASURES[m][1]) for m in measures
    }


# --- staged columns (fixed values): file column to (output column, type) --------

HD = {
    "UNITID": ("unitid", "bigint"),
    "OPEID": ("ope_id", "string"),
    "INSTNM": ("institution_name", "string"),
    "IALIAS": ("institution_alias", "string"),
    "ADDR": ("street_address", "string"),
    "CITY": ("city", "string"),
    "STABBR": ("state_code", "string"),
    "ZIP": ("zip", "string"),
    "FIPS": ("fips_state_code", "int"),
    "OBEREG": ("bea_region", "int"),
    "COUNTYCD": ("county_fips_code", "int"),
    "COUNTYNM": ("county_name", "string"),
    "CBSA": ("cbsa_code", "int"),
    "CBSATYPE": ("cbsa_type", "int"),
    "CSA": ("csa_code", "int"),
    "CNGDSTCD": ("congressional_district_id", "int"),
    "LONGITUD": ("longitude", "double"),
    "LATITUDE": ("latitude", "double"),
    "LOCALE": ("locale", "int"),
    "SECTOR": ("sector", "int"),
    "ICLEVEL": ("institution_level", "int"),
    "CONTROL": ("control", "int"),
    "C21BASIC": ("carnegie_basic_2021", "int"),
    "CARNEGIEIC": ("carnegie_institutional_classification_2025", "int"),
    "CARNEGIESAEC": ("carnegie_student_access_earnings_2025", "int"),
    "CARNEGIERSCH": ("carnegie_research_activity_2025", "int"),
    "CARNEGIESIZE": ("carnegie_size_2025", "int"),
    "CARNEGIEALF": ("carnegie_award_level_focus_2025", "int"),
    "CARNEGIEAPM": ("carnegie_undergrad_program_mix_2025", "int"),
    "CARNEGIEGPM": ("carnegie_grad_program_mix_2025", "int"),
    "HLOFFER": ("highest_level_offering", "int"),
    "HDEGOFR1": ("highest_degree_offered", "int"),
    "UGOFFER": ("undergrad_offering", "int"),
    "GROFFER": ("graduate_offering", "int"),
    "DEGGRANT": ("degree_granting_status", "int"),
    "INSTSIZE": ("institution_size_category", "int"),
    "LANDGRNT": ("land_grant_institution", "int"),
    "HBCU": ("historically_black_college", "int"),
    "TRIBAL": ("tribal_college", "int"),
    "HOSPITAL": ("has_hospital", "int"),
    "MEDICAL": ("grants_medical_degree", "int"),
    "F1SYSTYP": ("system_type", "int"),
    "F1SYSNAM": ("system_name", "string"),
    "F1SYSCOD": ("system_id", "string"),
    "ACT": ("institution_status", "string"),
    "CYACTIVE": ("active_current_year", "int"),
    "OPEFLAG": ("ope_title_iv_eligibility", "int"),
    "CLOSEDAT": ("date_closed", "string"),
    "DEATHYR": ("year_deleted_from_ipeds", "int"),
    "POSTSEC": ("primarily_postsecondary", "int"),
    "PSEFLAG": ("postsecondary_institution_flag", "int"),
    "PSET4FLG": ("postsecondary_title_iv_flag", "int"),
    "CHFNM": ("chief_administrator_name", "string"),
    "CHFTITLE": ("chief_administrator_title", "string"),
    "GENTELE": ("general_phone", "string"),
    "EIN": ("employer_id_number", "string"),
    "UEIS": ("unique_entity_identifier", "string"),
    "RPTMTH": ("reporting_method", "int"),
    "INSTCAT": ("institutional_category", "int"),
    "DFRCGID": ("nces_comparison_group_id", "int"),
    "DFRCUSCG": ("custom_comparison_group_submitted", "int"),
    "WEBADDR": ("website_url", "string"),
    "ADMINURL": ("admissions_url", "string"),
    "FAIDURL": ("financial_aid_url", "string"),
    "APPLURL": ("application_url", "string"),
    "NPRICURL": ("net_price_calculator_url", "string"),
    "VETURL": ("veterans_tuition_url", "string"),
    "ATHURL": ("athlete_graduation_rate_url", "string"),
    "DISAURL": ("disability_services_url", "string"),
}

EFFY = {
    "UNITID": ("unitid", "bigint"),
    "EFFYALEV": ("student_level", "int"),
    "EFFYLEV": ("undergrad_or_grad_level", "int"),
    "LSTUDY": ("original_level_of_study", "int"),
    **count_block("EFY", "TOTL", "total_enrollment"),
    "EFYGUUN": ("gender_unknown", COUNT),
    "EFYGUAN": ("another_gender", COUNT),
    "EFYGUTOT": ("gender_unknown_or_another_total", COUNT),
    "EFYGUKN": ("gender_binary_total", COUNT),
}

C_A = {
    "UNITID": ("unitid", "bigint"),
    "CIPCODE": ("cip_code", "string"),
    "AWLEVEL": ("award_level", "int"),
    "MAJORNUM": ("major_number", "int"),
    **count_block("C", "TOTAL", "total_completions"),
}

GR = {
    "UNITID": ("unitid", "bigint"),
    "GRTYPE": ("cohort_type", "int"),
    "CHRTSTAT": ("cohort_status", "int"),
    "SECTION": ("data_section", "int"),
    "COHORT": ("cohort_year", "int"),
    "LINE": ("survey_line", "string"),
    **count_block("GR", "TOTL", "total"),
}

SFA = {
    "UNITID": ("unitid", "bigint"),
    "SCUGRAD": ("undergrad_enrollment_aid", COUNT),
    "SCUGDGSK": ("undergrad_degree_seeking_count", COUNT),
    "SCUGNDGS": ("undergrad_non_degree_seeking_count", COUNT),
    "SCUGFFN": ("ftft_undergrad_count", COUNT),
    "SCUGFFP": ("ftft_undergrad_percent", "double"),
    "SCFA2": ("fall_cohort_total_undergrads", COUNT),
    "SCFA2DG": ("fall_cohort_degree_seeking", COUNT),
    "SCFA2ND": ("fall_cohort_non_degree_seeking", COUNT),
    "SCFA1N": ("fall_cohort_student_count", COUNT),
    "SCFA1P": ("fall_cohort_percent_of_undergrads", "double"),
    "SCFY2": ("full_year_cohort_total_undergrads", COUNT),
    "SCFY2DG": ("full_year_cohort_degree_seeking", COUNT),
    "SCFY2ND": ("full_year_cohort_non_degree_seeking", COUNT),
    "SCFY1N": ("full_year_cohort_student_count", COUNT),
    "SCFY1P": ("full_year_cohort_percent_of_undergrads", "double"),
    **aid_block("UPGRNT", "all_ug_pell"),
    **aid_block("UAGRNT", "all_ug_any_grant"),
    **aid_block("UFLOAN", "all_ug_federal_loan"),
    **aid_block("UDGPGRNT", "degree_seeking_pell"),
    **aid_block("UDGAGRNT", "degree_seeking_any_grant"),
    **aid_block("UDGFLOAN", "degree_seeking_federal_loan"),
    **aid_block("ANYAID", "ftft_any_aid", "NP"),
    **aid_block("AIDFSI", "ftft_loan_or_grant", "NP"),
    **aid_block("AGRNT_", "ftft_any_grant"),
    **aid_block("FGRNT_", "ftft_federal_grant"),
    **aid_block("PGRNT_", "ftft_pell"),
    **aid_block("OFGRT_", "ftft_other_federal_grant"),
    **aid_block("SGRNT_", "ftft_state_local_grant"),
    **aid_block("IGRNT_", "ftft_institutional_grant"),
    **aid_block("LOAN_", "ftft_loan"),
    **aid_block("FLOAN_", "ftft_federal_loan"),
    **aid_block("OLOAN_", "ftft_other_loan"),
}

EF_D = {
    "UNITID": ("unitid", "bigint"),
    "RET_PCF": ("full_time_retention_rate", "double"),
    "RET_PCP": ("part_time_retention_rate", "double"),
    "STUFACR": ("student_faculty_ratio", "double"),
    "UGENTERN": ("total_entering_undergrads", COUNT),
    "RRFTCTA": ("ft_adjusted_cohort", COUNT),
    "RET_NMF": ("ft_students_retained", COUNT),
    "RRPTCTA": ("pt_adjusted_cohort", COUNT),
    "RET_NMP": ("pt_students_retained", COUNT),
    "GRCOHRT": ("grs_cohort_count", COUNT),
    "PGRCOHRT": ("grs_cohort_pct_of_entering", "double"),
}

STAGED = {"hd": HD, "effy": EFFY, "c_a": C_A, "gr": GR, "sfa": SFA, "ef_d": EF_D}

# Decoded columns added to each family: output column to code column.
STAGED_DECODES = {
    "hd": {
        "sector_name": "sector",
        "institution_level_name": "institution_level",
        "control_name": "control",
    },
    "effy": {"student_level_name": "student_level"},
    "c_a": {"award_level_name": "award_level"},
    "gr": {
        "cohort_type_description": "cohort_type",
        "cohort_status_description": "cohort_status",
    },
    "sfa": {},
    "ef_d": {},
}
