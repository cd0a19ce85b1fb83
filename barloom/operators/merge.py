"""Keep-last deduplication and the upsert and delete built on it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.schema import ASSET_KEY, BAR_KEY
from barloom.work import written


def keep_last(df: DataFrame, keys: Sequence[str], newest_first: Sequence[Column]) -> DataFrame:
    """One row per key: the first in `newest_first` order.

    Written as row_number() = 1 so that the optimizer cuts each key to one row per map task before
    the shuffle (WindowGroupLimit): a key with very many copies never reaches one task whole.
    """
    ranked = Window.partitionBy(*keys).orderBy(*newest_first)
    return (
        df.withColumn("_rank", F.row_number().over(ranked))
        .where(F.col("_rank") == 1)
        .drop("_rank")
    )


def dedupe_bars(bars: DataFrame, order: str = "seq") -> DataFrame:
    """The latest bar of every asset and date."""
    return keep_last(bars, BAR_KEY, [F.col(order).desc()])


def upsert_bars(
    existing: DataFrame, incoming: DataFrame, dedupe_first_load: bool = False
) -> DataFrame:
    """Existing and incoming bars merged by asset and date; incoming wins, then the larger `seq`.

    Assets that occur on both sides are deduplicated as a whole, old duplicates included. An asset
    new to `existing` keeps its repeated dates unless `dedupe_first_load`; an asset without
    incoming bars is untouched. Only the rows of assets on both sides are shuffled for ranking.
    """
    known = existing.select(*ASSET_KEY).distinct()
    arriving = incoming.select(*ASSET_KEY).distinct()
    touched = arriving if dedupe_first_load else arriving.join(known, ASSET_KEY, "left_semi")
    touched = written(touched, "touched")
    everything = existing.withColumn("_batch", F.lit(0)).unionByName(
        incoming.withColumn("_batch", F.lit(1)), allowMissingColumns=True
    )
    return dedupe_assets(everything, touched, ["_batch", "seq"]).drop("_batch")


def dedupe_assets(bars: DataFrame, assets: DataFrame, order: Sequence[str]) -> DataFrame:
    """Keep-last by date for the given assets (distinct keys); all other rows pass through."""
    latest = keep_last(
        bars.join(assets, ASSET_KEY, "left_semi"), BAR_KEY, [F.col(c).desc() for c in order]
    )
    return latest.unionByName(bars.join(assets, ASSET_KEY, "left_anti"))


def delete_assets(bars: DataFrame, assets: DataFrame) -> DataFrame:
    """Bars without those of the given assets.

    The keys are written first: a join with a bare table is split where an asset is heavy.
    """
    gone = written(assets.select(*ASSET_KEY).distinct(), "gone")
    return bars.join(gone, ASSET_KEY, "left_anti")


def deletion_outcome(bars: DataFrame, assets: DataFrame) -> DataFrame:
    """For each asset to delete, whether it has bars: asset key, existed."""
    stored = bars.select(*ASSET_KEY).distinct().withColumn("existed", F.lit(True))
    wanted = assets.select(*ASSET_KEY).distinct()
    return wanted.join(stored, ASSET_KEY, "left").withColumn(
        "existed", F.coalesce("existed", F.lit(False))
    )
