from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from barloom.functions import naming, outcomes
from barloom.operators.normalize import coerce_types, normalize_bars


def values(spark, column, rows, schema):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(column).collect()]


@pytest.mark.parametrize(("symbol", "key"), [
    ("NIFTY 50", "NIFTY_50"), ("USD/INR", "USD_INR"), ("^NSEI", "NSEI"), ("GC=F", "GC_F"),
    ("M&M", "M&M"), ("BAJAJ-AUTO", "BAJAJ-AUTO"),
])
def test_storage_key(spark, symbol, key):
    assert values(spark, naming.storage_key("s"), [(symbol,)], "s string") == [key]


@pytest.mark.parametrize(("symbol", "kind", "exchange", "given", "ticker"), [
    ("RELIANCE", "EQUITY", "NSE", "", "RELIANCE.NS"),
    ("RELIANCE", "EQUITY", "BSE", "", "RELIANCE.BO"),
    ("RELIANCE", "EQUITY", "MULTI", None, "RELIANCE.BO"),
    ("NIFTYBEES", "ETF", "NSE", "", "NIFTYBEES.NS"),
    ("Nifty 50", "INDEX", "NSE", "", "^NSEI"),
    ("NIFTY NEXT 50", "INDEX", "NSE", "", "^NSMIDCP50"),
    ("Some Index", "INDEX", "NSE", "", "^Some Index"),
    ("gold", "COMMODITY", "MULTI", "", "GC=F"),
    ("COPPER", "COMMODITY", "MULTI", "", "COPPER"),
    ("usdinr", "FOREX", "MULTI", "", "USDINR=X"),
    ("AUDINR", "FOREX", "MULTI", "", "AUDINR=X"),
    ("GOLD", "COMMODITY", "MULTI", "XX", "XX"),
])
def test_vendor_ticker(spark, symbol, kind, exchange, given, ticker):
    column = naming.vendor_ticker(*"abcd")
    rows = [(symbol, kind, exchange, given)]
    assert values(spark, column, rows, "a string, b string, c string, d string") == [ticker]


def test_class_directories(spark):
    rows = [("EQUITY",), ("INDEX",), ("ETF",), ("COMMODITY",), ("FOREX",), ("BOND",)]
    assert values(spark, naming.class_dir("t"), rows, "t string") == [
        "stocks", "indices", "etfs", "commodities", "forex", "other"]
    assert naming.class_dir_strict("equity") == "stocks"
    with pytest.raises(ValueError, match="Unknown asset type"):
        naming.class_dir_strict("BOND")


def test_throttle_texts(spark):
    positive = ["status 429", "server said: TOO MANY REQUESTS", "hit the Rate Limit",
                "peer: connection reset", "Connection aborted early", "socket Read Timed Out",
                "there is no data found here"]
    negative = ["disk full", "bad column", "timed out", "", None]
    marks = values(spark, outcomes.is_throttle_error(F.col("m")),
                   [(m,) for m in positive + negative], "m string")
    assert marks == [True] * len(positive) + [False] * len(negative)


def test_download_status(spark):
    rows = [(5, None, False), (5, "boom", False), (0, None, True), (0, None, False),
            (None, None, None), (0, "boom", True)]
    column = outcomes.download_status(F.col("n"), F.col("e"), F.col("s"))
    assert values(spark, column, rows, "n bigint, e string, s boolean") == [
        "success", "error", "skipped", "error", "error", "skipped"]


@pytest.mark.parametrize(("text", "number", "volume"), [
    ("12", 12.0, 12), (" 12 ", 12.0, 12), ("1.9", 1.9, 1), ("-1.9", -1.9, -1),
    ("1e3", 1000.0, 1000), (".5", 0.5, 0), ("5.", 5.0, 5), ("abc", None, 0), ("", None, 0),
    ("1d", None, 0), ("1.5f", None, 0), ("0x10", None, 0), ("NaN", None, 0), (None, None, 0),
    ("Infinity", float("inf"), 0), ("-inf", float("-inf"), 0),
    ("9007199254740993", 9007199254740992.0, 9007199254740993), ("1e30", 1e30, 0),
])
def test_lenient_numbers(spark, text, number, volume):
    df = coerce_types(spark.createDataFrame([(text, text)], "open string, volume string"))
    assert dict(df.dtypes) == {"open": "double", "volume": "bigint"}
    assert tuple(df.first()) == (number, volume)


def test_lenient_numbers_from_doubles(spark):
    rows = [(float("nan"), float("nan")), (None, None), (1.5, -2.5), (2.0, float("inf"))]
    df = coerce_types(spark.createDataFrame(rows, "open double, volume double"))
    assert [tuple(r) for r in df.collect()] == [(None, 0), (None, 0), (1.5, -2), (2.0, 0)]


def test_normalize_renames_fills_and_orders(spark):
    raw = spark.createDataFrame(
        [("2024-01-02", 1.0, 2.0, 0.5, 1.5, 1.4, 10, None, "x")],
        "`Date` string, `Open` double, `High` double, `Low` double, `Close` double, "
        "`Adj Close` double, `Volume` bigint, `Stock Splits` double, `Capital Gains` string",
    )
    bars = normalize_bars(raw, F.lit("TCS"))
    assert bars.columns == ["date", "open", "high", "low", "close", "adj_close", "volume",
                            "dividends", "stock_splits", "symbol"]
    row = bars.first()
    assert (str(row.date), row.dividends, row.stock_splits, row.symbol) == (
        "2024-01-02", 0.0, None, "TCS")
    assert normalize_bars(raw.drop("Volume", "Adj Close"), F.lit("TCS")).columns == [
        "date", "open", "high", "low", "close", "dividends", "stock_splits", "symbol"]
