"""Storage names and vendor tickers as columns; arguments are SQL over the frame's columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from barloom.schema import ASSET_CLASSES, OTHER_CLASS_DIR

# Vendor tickers that do not follow from the symbol.
INDEX_TICKERS = {
    "NIFTY 50": "^NSEI",
    "NIFTY NEXT 50": "^NSMIDCP50",
    "NIFTY BANK": "^NSEBANK",
    "NIFTY IT": "^CNXIT",
    "NIFTY MIDCAP 50": "^NSMIDCP50",
    "NIFTY MIDCAP 100": "^NSEMDCP100",
    "INDIA VIX": "^INDIAVIX",
    "SENSEX": "^BSESN",
}
COMMODITY_TICKERS = {
    "GOLD": "GC=F",
    "SILVER": "SI=F",
    "CRUDE OIL": "CL=F",
    "NATURAL GAS": "NG=F",
}
FOREX_TICKERS = {
    "USDINR": "USDINR=X",
    "EURINR": "EURINR=X",
    "GBPINR": "GBPINR=X",
    "JPYINR": "JPYINR=X",
}
# Characters a storage name may not hold, and what replaces them.
UNSAFE_CHARACTERS = {" ": "_", "/": "_", "^": "", "=": "_"}


def lookup_sql(key: str, values: dict[str, str]) -> str:
    """values[key], NULL where absent; a literal map, so no join is needed."""
    entries = ", ".join(f"'{name}', '{value}'" for name, value in values.items())
    return f"try_element_at(map({entries}), {key})"


def storage_key_sql(symbol: str) -> str:
    return reduce(
        lambda name, swap: f"replace({name}, '{swap[0]}', '{swap[1]}')",
        UNSAFE_CHARACTERS.items(),
        symbol,
    )


def class_dir_sql(asset_type: str) -> str:
    return f"coalesce({lookup_sql(asset_type, ASSET_CLASSES)}, '{OTHER_CLASS_DIR}')"


def storage_key(symbol: str = "symbol") -> Column:
    """A file-safe form of the symbol; with the asset class it identifies an asset's bars."""
    return F.expr(storage_key_sql(symbol))


def class_dir(asset_type: str = "asset_type") -> Column:
    """The directory name of an asset class; unknown classes go to `other`."""
    return F.expr(class_dir_sql(asset_type))


def class_dir_strict(asset_type: str) -> str:
    """The directory name for an asset class given in any letter case; unknown raises."""
    name = ASSET_CLASSES.get(asset_type.upper())
    if name is None:
        raise ValueError(f"Unknown asset type: {asset_type}")
    return name


def storage_path(asset_type: str = "asset_type", symbol: str = "symbol") -> Column:
    """`<class directory>/<storage key>`, the logical place of an asset's bars."""
    return F.expr(f"concat({class_dir_sql(asset_type)}, '/', {storage_key_sql(symbol)})")


def vendor_ticker(
    symbol: str = "symbol", asset_type: str = "asset_type", exchange: str = "exchange",
    given: str = "yfinance_ticker",
) -> Column:
    """`given` unless it is empty, else the ticker the class and exchange imply."""

    def known(values: dict[str, str]) -> str:
        return lookup_sql(f"upper({symbol})", values)

    return F.expr(f"""case
        when coalesce({given}, '') <> '' then {given}
        when {asset_type} = 'INDEX' then coalesce({known(INDEX_TICKERS)}, concat('^', {symbol}))
        when {asset_type} = 'COMMODITY' then coalesce({known(COMMODITY_TICKERS)}, {symbol})
        when {asset_type} = 'FOREX' then coalesce({known(FOREX_TICKERS)}, concat({symbol}, '=X'))
        else concat({symbol}, if({exchange} = 'NSE', '.NS', '.BO')) end""")
