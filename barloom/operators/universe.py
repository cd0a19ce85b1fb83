"""The asset universe: listings to typed asset rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.functions.naming import storage_key, vendor_ticker
from barloom.schema import ASSET_CLASSES, EXCHANGES, UNIVERSE_DEFAULTS, UNIVERSE_SCHEMA

LISTING_DATE_FORMAT = "d-MMM-yyyy"
BLANKS = " \t\r\n\f\v"


def complete_universe(assets: DataFrame) -> DataFrame:
    """Every universe column in order and typed: absent ones get their default, and an empty
    vendor ticker is derived from symbol, class and exchange."""
    present = set(assets.columns)

    def value(name: str) -> str:
        if name in present:
            return name
        default = UNIVERSE_DEFAULTS[name]
        return "null" if default is None else f"'{default}'"

    typed = assets.selectExpr(*[
        f"cast({value(f.name)} as {f.dataType.simpleString()}) as {f.name}" for f in UNIVERSE_SCHEMA
    ])
    return typed.withColumn("yfinance_ticker", vendor_ticker())


def reject_unknown_values(assets: DataFrame) -> DataFrame:
    """Fails the job on an asset class or exchange outside the closed sets."""

    def checked(name: str, allowed: Sequence[str]) -> Column:
        value = F.col(name)
        bad = F.raise_error(
            F.concat(F.lit(f"unknown {name}: "), F.coalesce(value, F.lit("NULL")))
        ).cast("string")
        return F.when(value.isin(list(allowed)), value).otherwise(bad)

    return assets.withColumns({
        "asset_type": checked("asset_type", tuple(ASSET_CLASSES)),
        "exchange": checked("exchange", EXCHANGES),
    })


def parse_listing(listing: DataFrame) -> DataFrame:
    """Exchange listing rows (all text) to NSE equities.

    Column names may carry blanks around them; fields are trimmed, rows without a symbol dropped,
    and a listing date that is not `day-Mon-year` is NULL.
    """
    by_name = {name.strip(): name for name in listing.columns}

    def cell(name: str) -> Column:
        if name not in by_name:
            return F.lit("")
        return F.btrim(F.coalesce(F.col(f"`{by_name[name]}`"), F.lit("")), F.lit(BLANKS))

    parsed = listing.select(
        cell("SYMBOL").alias("symbol"),
        cell("NAME OF COMPANY").alias("name"),
        cell("ISIN NUMBER").alias("isin"),
        F.lit("NSE").alias("exchange"),
        F.try_to_date(cell("DATE OF LISTING"), LISTING_DATE_FORMAT).alias("listing_date"),
        F.lit("EQUITY").alias("asset_type"),
    ).where(F.col("symbol") != "")
    return complete_universe(parsed)


def index_exchange(name: Column) -> Column:
    """An index belongs to NSE exactly if its name says so."""
    return F.when(name.contains("NSE"), "NSE").otherwise("BSE")


def build_universe(listings: Sequence[DataFrame], order: str | None = None) -> DataFrame:
    """All listings in one universe; assets listed twice stay twice.

    `order` names an extra column that grows along the listings and inside each.
    """
    parts = [complete_universe(one) for one in listings]
    if order is not None:
        parts = [
            one.withColumn(order, F.struct(F.lit(i), F.monotonically_increasing_id()))
            for i, one in enumerate(parts)
        ]
    return reduce(lambda a, b: a.unionByName(b), parts)


def with_asset_key(universe: DataFrame) -> DataFrame:
    return universe.withColumn("storage_key", storage_key())
