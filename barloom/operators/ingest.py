"""What is still missing, which landed rows fill it, and how an ingest run went."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.functions.naming import storage_path
from barloom.functions.outcomes import download_status, is_throttle_error
from barloom.operators.profile import last_dates
from barloom.schema import ASSET_KEY
from barloom.work import written

# Fixed value: where history starts for an asset without bars.
HISTORY_START = date(1990, 1, 1)


def resume_plan(
    universe: DataFrame, bars: DataFrame, end: date, start: date | None = None
) -> DataFrame:
    """Per universe asset the date range still to fetch, [start_date, end_date), or `skipped`.

    A given `start` holds for every asset and skips none. Otherwise an asset resumes the day after
    its last bar, is skipped if that day reaches `end`, and starts with HISTORY_START if it has none.
    """
    end_date = F.lit(end)
    if start is not None:
        return universe.withColumns({
            "last_date": F.lit(None).cast("date"), "start_date": F.lit(start),
            "end_date": end_date, "skipped": F.lit(False),
        })
    planned = universe.join(last_dates(bars), ASSET_KEY, "left")
    next_day = F.date_add("last_date", 1)
    return planned.withColumns({
        "start_date": F.coalesce(next_day, F.lit(HISTORY_START)),
        "end_date": end_date,
        "skipped": F.coalesce(next_day >= end_date, F.lit(False)),
    })


def select_missing(landed: DataFrame, plan: DataFrame) -> DataFrame:
    """Landed bars inside their asset's planned range; assets planned twice count once."""
    ranges = written(
        plan.where(~F.col("skipped")).groupBy(*ASSET_KEY)
        .agg(F.min("start_date").alias("_from"), F.max("end_date").alias("_to")),
        "ranges",
    )
    return (
        landed.join(ranges, ASSET_KEY)
        .where((F.col("date") >= F.col("_from")) & (F.col("date") < F.col("_to")))
        .drop("_from", "_to")
    )


def ingest_results(plan: DataFrame, fetched: DataFrame) -> DataFrame:
    """One row per planned asset: rows added, no error, and whether it was up to date.

    An asset that is planned twice, as it is listed twice, is fetched once and has one row.
    """
    added = fetched.groupBy(*ASSET_KEY).agg(F.count(F.lit(1)).alias("rows_added"))
    assets = plan.groupBy(*ASSET_KEY).agg(
        F.min("symbol").alias("symbol"), F.bool_and("skipped").alias("skipped"))
    return assets.join(added, ASSET_KEY, "left").select(
        "symbol", *ASSET_KEY,
        F.coalesce("rows_added", F.lit(0)).cast("bigint").alias("rows_added"),
        F.lit(None).cast("string").alias("error"),
        "skipped",
    )


def with_file_sizes(results: DataFrame, files: DataFrame) -> DataFrame:
    """Ingest results with `file_size_bytes`: the asset's share, by rows added, of the bytes of the
    files that were written for its class (asset_type, size_bytes); null without rows added.

    A file holds bars of many assets, so no asset has a size of its own.
    """
    sizes = files.groupBy("asset_type").agg(F.sum("size_bytes").alias("_bytes"))
    rows = results.groupBy("asset_type").agg(F.sum("rows_added").alias("_rows"))
    share = F.round(F.col("_bytes") * F.col("rows_added") / F.col("_rows")).cast("bigint")
    return (
        results.join(sizes.join(rows, "asset_type"), "asset_type", "left")
        .withColumn("file_size_bytes", F.when(F.col("rows_added") > 0, share))
        .drop("_bytes", "_rows")
    )


def download_log_rows(results: DataFrame) -> DataFrame:
    """Ingest results as log rows; only successful ones name a path."""
    status = download_status(F.col("rows_added"), F.col("error"), F.col("skipped"))
    sizes = ["file_size_bytes"] if "file_size_bytes" in results.columns else []
    return results.withColumn("status", status).select(
        "symbol",
        F.col("rows_added").cast("bigint").alias("rows_downloaded"),
        F.when(F.col("status") == "success", storage_path()).otherwise("").alias("file_path"),
        "status",
        F.coalesce("error", F.lit("")).alias("error_message"), *sizes,
    )


def ingest_summary(results: DataFrame) -> DataFrame:
    """One row: successes, skips, failures (an error text is present) and rows added."""
    status = download_status(F.col("rows_added"), F.col("error"), F.col("skipped"))
    return results.agg(
        F.count_if(status == "success").alias("succeeded"),
        F.count_if(F.coalesce("skipped", F.lit(False))).alias("skipped"),
        F.count_if(F.coalesce("error", F.lit("")) != "").alias("failed"),
        F.coalesce(F.sum("rows_added"), F.lit(0)).cast("bigint").alias("total_rows"),
    )


def throttled(log: DataFrame) -> DataFrame:
    """Log rows with `throttle`: whether their error text means the vendor was throttling."""
    return log.withColumn("throttle", is_throttle_error(F.col("error_message")))
