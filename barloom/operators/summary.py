"""Summaries of bars that can be merged, and what is known from them without reading bars.

A summary has a row per asset, year and span of 16 days: how many rows each day has, and the row
counters of the checks. Its columns are sums. So each class-year has a summary of its own, which is
made again only when its bars change, and a report over all years adds them up: a span that a year's
end cuts becomes whole again, and gaps are measured over spans and years after that.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.functions.coercion import nan_to_null
from barloom.operators.checks import (
    ALL_CHECKS,
    DAY_ROWS,
    OHLC_RULES,
    REPEATED_ROWS,
    SPAN_DAYS,
    Check,
    Settings,
    aggregates_of,
    count_by_asset_of,
    merged_counts,
    row_counters_of,
    span_counts,
)
from barloom.operators.report import verdicts_of
from barloom.schema import ASSET_KEY, BAR_SCHEMA

#: bar_year of bars without a date.
NO_YEAR = 0
YEAR_KEY = [*ASSET_KEY, "bar_year"]

# Row counters don't depend on the clock, so any day does.
_ANY = Settings(as_of=date(1970, 1, 1))


def with_year(bars: DataFrame) -> DataFrame:
    return bars.withColumn("bar_year", F.coalesce(F.year("date"), F.lit(NO_YEAR)))


def summarise(bars: DataFrame, checks: Sequence[Check] = ALL_CHECKS) -> DataFrame:
    """The summary of bars: asset key, bar_year, span, span_rows, DAY_ROWS, the checks' row counters
    and aggregates, and `violations`, the bars that break any price rule."""
    counters = row_counters_of(checks, _ANY, bars.columns)
    rules = " or ".join(f"({r})" for r in OHLC_RULES.values())
    if set(OHLC_RULES) <= set(counters):
        counters = {**counters, "violations": rules}
    extra = aggregates_of(checks, _ANY, bars.columns)
    return span_counts(with_year(nan_to_null(bars)), counters, YEAR_KEY, extra)


def summary_verdicts(
    universe: DataFrame, summary: DataFrame, settings: Settings,
    checks: Sequence[Check] = ALL_CHECKS, columns: Sequence[str] = tuple(BAR_SCHEMA.names),
) -> DataFrame:
    """`asset_verdicts` of the bars that were summarised, which had the given columns.

    Rows of one asset, year and span may lie in several parts of `summary`; they are added up.
    Checks have to be among those it was made with.
    """
    extra = aggregates_of(checks, settings, columns)
    missing = {*row_counters_of(checks, settings, columns), *extra} - set(summary.columns)
    if missing:
        raise ValueError(f"the summary lacks the counters {sorted(missing)}")
    merged = merged_counts(summary, aggregates=extra)
    counted = count_by_asset_of(merged, settings, checks, columns)
    return verdicts_of(universe, counted, settings, checks, columns)


def summary_assets(summary: DataFrame) -> DataFrame:
    """Per asset: last_date and row_count."""
    last = ", ".join(
        f"if({n} > 0, span * {SPAN_DAYS} + {i}, null)" for i, n in reversed([*enumerate(DAY_ROWS)]))
    return summary.groupBy(*ASSET_KEY).agg(
        F.expr(f"date_from_unix_date(max(coalesce({last})))").alias("last_date"),
        F.sum("span_rows").alias("row_count"))


def summary_years(summary: DataFrame) -> DataFrame:
    """Per asset and year: repeated_rows, violations and open_ended, bars without a high or low.

    `summary` has one row per asset, year and span.
    """
    return summary.groupBy(*YEAR_KEY).agg(
        F.sum(F.expr(REPEATED_ROWS)).alias("repeated_rows"),
        F.sum("violations").alias("violations"),
        F.sum(F.expr("null_high + null_low")).alias("open_ended"))
