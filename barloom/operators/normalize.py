"""Vendor frames to the canonical bar columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.functions.coercion import to_float, to_volume
from barloom.functions.naming import storage_key
from barloom.schema import BAR_SCHEMA, FLOAT_COLUMNS


def normalize_bars(raw: DataFrame, symbol: Column | None = None) -> DataFrame:
    """Vendor column names (`Adj Close`, `Volume`, ...) to bar columns, in bar order.

    Absent dividend and split columns read as 0.0, nulls in present ones stay; columns that are
    not part of a bar are dropped, except the arrival number `seq` and `asset_type`.
    """
    found = {name.lower().replace(" ", "_"): F.col(f"`{name}`") for name in raw.columns}
    if symbol is not None:
        found["symbol"] = symbol
    for action in ("dividends", "stock_splits"):
        found.setdefault(action, F.lit(0.0))
    if "date" in found:
        found["date"] = F.to_date(found["date"])
    wanted = BAR_SCHEMA.fieldNames() + ["seq", "asset_type"]
    return raw.select([found[c].alias(c) for c in wanted if c in found])


def coerce_types(bars: DataFrame) -> DataFrame:
    """Bar columns in their stored types; only the columns that are present."""
    types = {f.name: f.dataType for f in bars.schema}
    typed: dict[str, Column] = {}
    if "date" in types:
        typed["date"] = F.to_date("date")
    for name in FLOAT_COLUMNS:
        if name in types:
            typed[name] = to_float(name, types[name])
    if "volume" in types:
        typed["volume"] = to_volume("volume", types["volume"])
    return bars.withColumns(typed) if typed else bars


def with_storage_key(df: DataFrame) -> DataFrame:
    """Adds the storage key, which with asset_type identifies an asset."""
    return df.withColumn("storage_key", storage_key())
