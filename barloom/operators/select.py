"""Filters over the universe and the bars."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.schema import ASSET_KEY


def parse_symbols(symbols: str) -> list[str]:
    """A comma-separated symbol list as distinct trimmed upper-case names."""
    return sorted({part.strip().upper() for part in symbols.split(",")})


def filter_symbols(assets: DataFrame, symbols: str | None) -> DataFrame:
    """Rows whose symbol, in any letter case, is in a comma-separated list; no list keeps all."""
    if not symbols:
        return assets
    return assets.where(F.upper("symbol").isin(parse_symbols(symbols)))


def filter_asset_type(assets: DataFrame, asset_type: str | None) -> DataFrame:
    """Rows of one asset class (argument in any letter case); no argument keeps all."""
    if not asset_type:
        return assets
    return assets.where(F.col("asset_type") == asset_type.upper())


def filter_dates(bars: DataFrame, start: date | None = None, end: date | None = None) -> DataFrame:
    """Bars within the inclusive bounds; a bound left out does not restrict."""
    if start is not None:
        bars = bars.where(f"date >= date'{start.isoformat()}'")
    if end is not None:
        bars = bars.where(f"date <= date'{end.isoformat()}'")
    return bars


def assets_with_data(universe: DataFrame, bars: DataFrame) -> DataFrame:
    """Universe rows whose asset has at least one bar."""
    return universe.join(bars.select(*ASSET_KEY).distinct(), ASSET_KEY, "left_semi")
