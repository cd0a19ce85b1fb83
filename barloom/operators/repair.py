"""Repair of high and low prices that contradict the other prices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.functions.coercion import nan_to_null
from barloom.operators.checks import OHLC_RULES
from barloom.operators.merge import dedupe_bars
from barloom.schema import ASSET_KEY, PASSED, PRICE_COLUMNS
from barloom.work import written


def is_violation() -> Column:
    """Whether a bar breaks any of the price rules."""
    return F.expr(" or ".join(OHLC_RULES.values()))


def flagged_assets(bars: DataFrame) -> DataFrame:
    """Assets with a violation, as a written table."""
    return written(bars.where(is_violation()).select(*ASSET_KEY).distinct(), "flagged")


def repaired_counts(bars: DataFrame) -> DataFrame:
    """Assets with violations, and how many of their bars are in violation."""
    return (
        nan_to_null(bars).where(is_violation())
        .groupBy(*ASSET_KEY).agg(F.count(F.lit(1)).alias("repaired_rows"))
    )


def repair_ohlc(
    bars: DataFrame, flagged: DataFrame | None = None, has_nan: bool = True
) -> DataFrame:
    """High and low widened to span all four prices, in every asset that has a violation.

    `flagged` (distinct asset keys) says which assets those are, if `bars` is only a part of them.
    Stored bars have no NaN; saying so lets the search for missing bounds skip row groups.

    The rule covers the whole asset, but on a bar that is not itself in violation it changes
    nothing unless high or low is missing. So a bar in violation is repaired on the spot, and only
    bars with a missing high or low need to know whether their asset has a violation elsewhere:
    the bulk of the table is neither shuffled nor joined.
    """
    if not set(PRICE_COLUMNS) <= set(bars.columns):
        return bars
    if has_nan:
        bars = nan_to_null(bars)
    prices = [F.col(c) for c in PRICE_COLUMNS]
    spanned = {"high": F.greatest(*prices), "low": F.least(*prices)}

    open_ended = (F.col("high").isNull() | F.col("low").isNull()) & ~is_violation()
    on_the_spot = bars.where(~open_ended).withColumns({
        c: F.when(is_violation(), spanned[c]).otherwise(F.col(c)) for c in spanned
    })
    if flagged is None:
        flagged = flagged_assets(bars)
    waiting = bars.where(open_ended).join(
        flagged.withColumn("_flagged", F.lit(True)), ASSET_KEY, "left"
    )
    filled = waiting.withColumns({
        c: F.when(F.col("_flagged"), spanned[c]).otherwise(F.col(c)) for c in spanned
    }).drop("_flagged")
    return on_the_spot.unionByName(filled)


def repair_assets(bars: DataFrame, order: str = "seq") -> DataFrame:
    """What the store holds after cleaning: repaired assets also lose repeated dates, keep-last.

    Only the bars of assets with a violation are ranked; all others pass through.
    """
    bars = nan_to_null(bars)
    prices = [F.col(c) for c in PRICE_COLUMNS]
    flagged = flagged_assets(bars)
    hit = bars.join(flagged, ASSET_KEY, "left_semi").withColumns(
        {"high": F.greatest(*prices), "low": F.least(*prices)}
    )
    return dedupe_bars(hit, order).unionByName(bars.join(flagged, ASSET_KEY, "left_anti"))


def repair_summary(bars: DataFrame) -> DataFrame:
    """One row: bars repaired and assets repaired."""
    return repaired_counts(bars).agg(
        F.coalesce(F.sum("repaired_rows"), F.lit(0)).cast("bigint").alias("repaired_rows"),
        F.count(F.lit(1)).alias("repaired_assets"),
    )


def repair_log_rows(bars: DataFrame, universe: DataFrame) -> DataFrame:
    """The validation log rows a cleaning run appends, one per repaired asset of the universe."""
    return repair_log(repaired_counts(bars), universe)


def repair_log(repaired: DataFrame, universe: DataFrame) -> DataFrame:
    """One log row per repaired asset, however often the universe lists it."""
    assets = universe.groupBy(*ASSET_KEY).agg(F.min("symbol").alias("symbol"))
    return (
        assets.join(repaired, ASSET_KEY)
        .select(
            "symbol",
            F.lit("ohlc_consistency").alias("check_name"),
            F.lit(PASSED).alias("status"),
            F.format_string(
                "Repaired %d OHLC consistency violations", "repaired_rows"
            ).alias("details"),
        )
    )
