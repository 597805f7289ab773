"""The rows behind the five dashboard tabs, over the survey marts.

Each tab is a dict of named DataFrames. Nothing is computed until one is used;
cache the fact when many are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortbench.functions.rates import mean_of
from cohortbench.operators import datasets
from cohortbench.operators.entities import search_names, select_names
from cohortbench.sources.warehouse import latest_value, year_window

KEY = "unitid"
NAME = "institution_name"

# The window shown. It ends with the newest year in which every
# headline metric is published.
FIRST_YEAR = 2020
LAST_YEAR = 2024

# Table headers.
OVERVIEW_HEADERS = {
    NAME: "College",
    "graduation_rate_150": "Graduation Rate",
    "success_rate": "Success Rate",
    "full_time_retention_rate": "Retention Rate",
    "associate_degrees": "Associate Degrees",
    "total_completions": "Total Completions",
}
EQUITY_HEADERS = {
    NAME: "College",
    "grad_rate_hispanic": "Hispanic Rate",
    "grad_rate_black": "Black Rate",
    "grad_rate_white": "White Rate",
    "equity_gap_hispanic": "Hispanic Gap",
    "equity_gap_black": "Black Gap",
}
GROUP_LABELS = {
    "grad_rate_hispanic": "Hispanic",
    "grad_rate_black": "Black",
    "grad_rate_white": "White",
}

OVERVIEW_CARDS = {
    "avg_graduation_rate": ("graduation_rate_150", 2),
    "avg_retention_rate": ("full_time_retention_rate", 2),
}
EQUITY_CARDS = {
    "avg_hispanic_gap": ("equity_gap_hispanic", 2),
    "avg_black_gap": ("equity_gap_black", 2),
}


def means(columns: dict[str, tuple[str, int]]) -> dict[str, Column]:
    return {name: mean_of(F.col(c), scale) for name, (c, scale) in columns.items()}


def shown_rows(
    fact: DataFrame,
    first: int = FIRST_YEAR,
    last: int = LAST_YEAR,
    colleges: list[str] | None = None,
) -> DataFrame:
    """The fact cut to the window and to the chosen colleges."""
    rows = year_window(fact, first, last)
    return rows if colleges is None else select_names(rows, colleges, NAME)


def overview(rows: DataFrame, at: int | Column) -> dict[str, DataFrame]:
    newest = datasets.year_slice(rows, at)
    return {
        "colleges": datasets.cards(rows, {"colleges": F.countDistinct(NAME)}),
        "cards": datasets.cards(
            newest, {**means(OVERVIEW_CARDS), "total_degrees": F.sum("associate_degrees")}
        ),
        "table": datasets.ranked_table(
            datasets.renamed(newest, OVERVIEW_HEADERS), "College", "Graduation Rate"
        ),
        "bars": datasets.ranked_bars(newest, NAME, "graduation_rate_150"),
    }


def found_names(rows: DataFrame, term: str) -> DataFrame:
    """Colleges of the shown rows whose name holds what was typed, any case."""
    return search_names(rows, term, NAME)


def metric_tab(
    rows: DataFrame, metric: str, years: list[int], digits: int, focus: str | Column | None = None
) -> dict[str, DataFrame]:
    """Trend lines, bars by year and the pivot table of one metric.

    Only years in which any shown entity has a value; all of them if none has. With a college in focus
    its lines are marked, and come after all others.
    """
    years = [y for y in datasets.years_with_data(rows, metric) if y in years] or years
    trend = datasets.trend(rows, NAME, [metric])
    if focus is not None:
        trend = datasets.with_focus(trend, NAME, focus, ["year"])
    return {
        "trend": trend,
        "bars": datasets.year_grid(rows, KEY, NAME, metric, years),
        "table": datasets.pivot_with_change(rows, KEY, NAME, metric, years, digits),
    }


def equity(rows: DataFrame, at: int | Column) -> dict[str, DataFrame]:
    newest = datasets.year_slice(rows, at)
    return {
        "cards": datasets.cards(newest, means(EQUITY_CARDS)),
        "rates": datasets.long_by_group(
            newest, NAME, GROUP_LABELS, "Demographic", "Graduation Rate"
        ),
        "gaps": datasets.scatter(newest, NAME, "equity_gap_hispanic", "equity_gap_black"),
        "table": datasets.renamed(newest, EQUITY_HEADERS),
    }


def tabs(
    fact: DataFrame,
    first: int = FIRST_YEAR,
    last: int = LAST_YEAR,
    colleges: list[str] | None = None,
    newest_present: bool = False,
    focus: str | Column | None = None,
    search: str | None = None,
) -> dict[str, dict[str, DataFrame]]:
    """All five tabs. Single-year views show the last year of the window, or with
    newest_present the newest year the window has rows for. A college in focus is
    marked in the trends, and what is searched for narrows every tab to the colleges
    whose name holds it, listed in the overview."""
    rows = shown_rows(fact, first, last, colleges)
    if search is not None:
        rows = rows.where(F.contains(F.lower(NAME), F.lit(search.lower())))
    at = latest_value(year_window(fact, first, last), "year") if newest_present else last
    years = list(range(first, last + 1))
    completions = metric_tab(rows, "associate_degrees", years, 0, focus)
    completions["total_trend"] = datasets.trend(rows, NAME, ["total_completions"])
    first_tab = overview(rows, at)
    if search is not None:
        first_tab["names"] = found_names(rows, search)
    return {
        "overview": first_tab,
        "graduation": metric_tab(rows, "graduation_rate_150", years, 1, focus),
        "retention": metric_tab(rows, "full_time_retention_rate", years, 1, focus),
        "completions": completions,
        "equity": equity(rows, at),
    }


# Measures of a BI model over the star: any of them by any dim or fact column.
def star_measures() -> dict[str, Column]:
    return {
        "colleges": F.countDistinct("unitid"),
        **means(OVERVIEW_CARDS),
        "total_associate_degrees": F.sum("associate_degrees"),
        **means(EQUITY_CARDS),
    }


def by_dimension(dim: DataFrame, fact: DataFrame, by: list[str]) -> DataFrame:
    return datasets.star_measures(dim, fact, "unitid", by, star_measures())
