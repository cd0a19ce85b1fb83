"""Bars laid out for reads of few assets and few days, out of very many."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.operators.select import filter_dates
from barloom.operators.summary import NO_YEAR, with_year
from barloom.schema import BAR_SCHEMA, PARTITION_FIELDS, STORED_SCHEMA
from barloom.sources.class_years import PAIR
from barloom.sources.store import READ_SCHEMA, scoped

#: Bits of the asset's and of the day's place that are interleaved: 256 groups of assets in a class,
#: and stretches of two days in a year.
BITS = 8
#: Row groups are the unit of skipping: small ones skip more, and cost a footer entry each.
ROW_GROUP_BYTES = 8 << 20


def interleaved(key: Column, day: Column) -> Column:
    """A Z-order of asset and day: bits of the key's hash and of the day of the year, in turn.

    Assets are only ever asked for by name, so their hash does, and spreads them evenly.
    """
    group = F.xxhash64(key).bitwiseAND((1 << BITS) - 1).cast("int")
    stretch = F.coalesce(F.shiftright(F.dayofyear(day) - 1, 1), F.lit(0))
    bits = [F.shiftleft(F.getbit(value, F.lit(i)).cast("int"), 2 * i + shift)
            for i in range(BITS) for shift, value in ((0, stretch), (1, group))]
    return sum(bits[1:], bits[0])


def write_interleaved(
    bars: DataFrame, path: str, assets_in_group: int = 100_000,
    row_group_bytes: int = ROW_GROUP_BYTES,
) -> None:
    """Writes bars by class and year, in Z-order of asset and day within, with bloom filters.

    Files and row groups hold a patch of the (asset, day) plane: least and greatest dates skip the
    others' days, and bloom filters of `storage_key` the others' assets, whose least and greatest
    keys say nothing in this order. Ranges are cut by sampled row counts, down to the single bar, so
    an asset or a day with a third of all rows spreads over many. `assets_in_group` sizes the filters
    for the distinct assets that one row group may hold.
    """
    placed = with_year(bars).withColumn("_place", interleaved(F.col("storage_key"), F.col("date")))
    order = [*PAIR, "_place", "storage_key", "date", "seq"]
    (
        placed.repartitionByRange(*order).sortWithinPartitions(*order)
        .select(*STORED_SCHEMA.fieldNames(), *(f.name for f in PARTITION_FIELDS))
        .write.option("parquet.bloom.filter.enabled#storage_key", "true")
        .option("parquet.bloom.filter.expected.ndv#storage_key", str(assets_in_group))
        .option("parquet.bloom.filter.adaptive.enabled", "true")
        .option("parquet.block.size", str(row_group_bytes))
        .partitionBy(*PAIR).parquet(path)
    )


def scan_asset_range(
    spark: SparkSession, path: str, storage_keys: Iterable[str], start: date | None = None,
    end: date | None = None, asset_type: str | None = None,
) -> DataFrame:
    """Bars of some assets between two dates, bounds inclusive; reads the row groups that may have some."""
    bars = spark.read.schema(READ_SCHEMA).parquet(path)
    if start is not None:
        bars = bars.where(F.col("bar_year") >= start.year)
    if end is not None:
        bars = bars.where(F.col("bar_year") <= end.year)
    if start is not None or end is not None:
        bars = bars.where(F.col("bar_year") != NO_YEAR)
    bars = filter_dates(scoped(bars, asset_type, storage_keys), start, end)
    return bars.select(*BAR_SCHEMA.fieldNames(), "seq", "asset_type", "storage_key")
