"""Table schemas, key columns and the closed value sets they use."""

from __future__ import annotations

from pyspark.sql import types as T

# Asset classes, the directory name each one is stored under, exchanges, outcomes.
ASSET_CLASSES = {
    "EQUITY": "stocks",
    "INDEX": "indices",
    "ETF": "etfs",
    "COMMODITY": "commodities",
    "FOREX": "forex",
}
OTHER_CLASS_DIR = "other"
EXCHANGES = ("NSE", "BSE", "MULTI")
PASSED, WARNING, FAILED, SKIPPED = "PASSED", "WARNING", "FAILED", "SKIPPED"

# One asset's bars share this key: two symbols with the same safe name share storage.
ASSET_KEY = ["asset_type", "storage_key"]
BAR_KEY = ASSET_KEY + ["date"]

PRICE_COLUMNS = ["open", "high", "low", "close"]
FLOAT_COLUMNS = PRICE_COLUMNS + ["adj_close", "dividends", "stock_splits"]

BAR_SCHEMA = T.StructType([
    T.StructField("date", T.DateType()),
    T.StructField("open", T.DoubleType()),
    T.StructField("high", T.DoubleType()),
    T.StructField("low", T.DoubleType()),
    T.StructField("close", T.DoubleType()),
    T.StructField("adj_close", T.DoubleType()),
    T.StructField("volume", T.LongType()),
    T.StructField("dividends", T.DoubleType()),
    T.StructField("stock_splits", T.DoubleType()),
    T.StructField("symbol", T.StringType()),
])

# What the store keeps: a bar, its asset key, and `seq`, the arrival order inside its batch.
STORED_SCHEMA = T.StructType(
    BAR_SCHEMA.fields
    + [T.StructField("seq", T.LongType()),
       T.StructField("storage_key", T.StringType())]
)
PARTITION_FIELDS = [
    T.StructField("asset_type", T.StringType()),
    T.StructField("bar_year", T.IntegerType()),
]

UNIVERSE_SCHEMA = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("isin", T.StringType()),
    T.StructField("exchange", T.StringType()),
    T.StructField("sector", T.StringType()),
    T.StructField("industry", T.StringType()),
    T.StructField("listing_date", T.DateType()),
    T.StructField("asset_type", T.StringType()),
    T.StructField("yfinance_ticker", T.StringType()),
])
# What an absent universe column reads as.
UNIVERSE_DEFAULTS = {
    "name": "", "isin": "", "exchange": "NSE", "sector": "", "industry": "",
    "listing_date": None, "asset_type": "EQUITY", "yfinance_ticker": "",
}

ASSETS_SCHEMA = T.StructType(
    UNIVERSE_SCHEMA.fields
    + [T.StructField("created_at", T.TimestampType()),
       T.StructField("updated_at", T.TimestampType())]
)

DOWNLOAD_LOG_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("symbol", T.StringType()),
    T.StructField("download_time", T.TimestampType()),
    T.StructField("start_date", T.DateType()),
    T.StructField("end_date", T.DateType()),
    T.StructField("rows_downloaded", T.LongType()),
    T.StructField("file_path", T.StringType()),
    T.StructField("file_size_bytes", T.LongType()),
    T.StructField("status", T.StringType()),
    T.StructField("error_message", T.StringType()),
])

VALIDATION_LOG_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("symbol", T.StringType()),
    T.StructField("check_name", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("details", T.StringType()),
    T.StructField("validated_at", T.TimestampType()),
])
