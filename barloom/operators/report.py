"""Validation report over a universe, and what is derived from it."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.operators.checks import (
    ALL_CHECKS,
    Check,
    Settings,
    count_by_asset,
    skipped_sql,
    verdicts_sql,
)
from barloom.schema import ASSET_KEY

NO_DATA_CHECK = "data_exists"
NO_DATA_MESSAGE = "No data available for validation"
STATUS_COUNTS = {"passed": "PASSED", "warned": "WARNING", "failed": "FAILED"}


def validation_report(
    universe: DataFrame, bars: DataFrame, settings: Settings,
    checks: Sequence[Check] = ALL_CHECKS,
) -> DataFrame:
    """One row per universe asset and check; an asset without bars has one SKIPPED row.

    Both join sides hold one row per asset at most, so no asset is heavy in the join.
    """
    return report_of(asset_verdicts(universe, bars, settings, checks))


def report_of(verdicts: DataFrame) -> DataFrame:
    """One row per check from the rows of `asset_verdicts`."""
    return verdicts.selectExpr("symbol", *ASSET_KEY, "total_rows", "inline(outcomes)")


def asset_verdicts(
    universe: DataFrame, bars: DataFrame, settings: Settings,
    checks: Sequence[Check] = ALL_CHECKS,
) -> DataFrame:
    """One row per universe row, with the array `outcomes` of its check results."""
    counted = count_by_asset(bars, settings, checks)
    return verdicts_of(universe, counted, settings, checks, bars.columns)


def verdicts_of(
    universe: DataFrame, counted: DataFrame, settings: Settings, checks: Sequence[Check],
    columns: Sequence[str],
) -> DataFrame:
    """`asset_verdicts` from the counters of bars with the given columns."""
    no_data = skipped_sql(NO_DATA_CHECK, NO_DATA_MESSAGE)
    outcomes = verdicts_sql(checks, settings, columns)
    return (
        universe.select("symbol", *ASSET_KEY)
        .join(counted, ASSET_KEY, "left")
        .selectExpr(
            "symbol", *ASSET_KEY, "coalesce(total_rows, 0L) as total_rows",
            f"if(total_rows is null, array({no_data}), {outcomes}) as outcomes",
        )
    )


def report_summary(report: DataFrame) -> DataFrame:
    """Per universe row: passed, warned and failed counts, verdict (no FAILED row), summary line.

    Takes the rows of `asset_verdicts`, whose outcomes are counted where they are, or those of a
    report. In a report an asset that is listed m times has every check m times: it gets m rows.
    """
    if "outcomes" in report.columns:
        counted = report.selectExpr("symbol", *ASSET_KEY, "total_rows", *(
            f"cast(size(filter(outcomes, o -> o.status = '{status}')) as bigint) as {name}"
            for name, status in STATUS_COUNTS.items()
        ))
    else:
        listed = "count(1) div size(collect_set(check_name))"
        counted = report.groupBy("symbol", *ASSET_KEY).agg(
            F.expr("max(total_rows) as total_rows"),
            *(F.expr(f"count_if(status = '{status}') div ({listed}) as {name}")
              for name, status in STATUS_COUNTS.items()),
            F.expr(f"{listed} as listed"),
        ).withColumn("listed", F.expr("explode(sequence(1L, listed))")).drop("listed")
    return counted.selectExpr(
        "*",
        "if(failed = 0, 'PASS', 'FAIL') as verdict",
        """format_string('%s: %d passed, %d warnings, %d failed', symbol, passed, warned, failed)
           as summary""",
    )


def batch_summary(report: DataFrame) -> DataFrame:
    """One row: universe rows reported, and those without a FAILED check."""
    return report_summary(report).agg(
        F.count(F.lit(1)).alias("total_assets"),
        F.count_if(F.col("failed") == 0).alias("passed_assets"),
    )


def report_rows(report: DataFrame, validated_at: datetime) -> DataFrame:
    """The rows of the saved report file; the stamp as ISO text."""
    return report.select(
        "symbol", "total_rows", "check_name", "status", "message", "rows_affected",
        F.lit(validated_at.isoformat()).alias("validated_at"),
    )


def validation_log_rows(report: DataFrame) -> DataFrame:
    """The rows logged for a report: the message is the detail; no-data assets are not logged."""
    return report.where(F.col("check_name") != NO_DATA_CHECK).select(
        "symbol", "check_name", "status", F.col("message").alias("details")
    )
