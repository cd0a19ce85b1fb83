"""Listings: exchange CSV files and the curated lists."""

from __future__ import annotations

import csv
import logging
from pathlib import Path

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.operators.universe import build_universe, complete_universe, index_exchange, parse_listing
from barloom.work import written

log = logging.getLogger(__name__)

# The curated listings, one asset a row.
CURATED = Path(__file__).with_name("curated_listings.csv")
CURATED_SCHEMA = "list string, symbol string, yfinance_ticker string, name string"


def _curated(spark: SparkSession, name: str) -> DataFrame:
    with CURATED.open(encoding="utf-8", newline="") as lines:
        rows = [tuple(row) for row in list(csv.reader(lines))[1:] if row[0] == name]
    return spark.createDataFrame(rows, CURATED_SCHEMA).drop("list")


def _equities(spark: SparkSession, exchange: str) -> DataFrame:
    return complete_universe(
        _curated(spark, exchange).drop("yfinance_ticker")
        .withColumns({"exchange": F.lit(exchange), "asset_type": F.lit("EQUITY")})
    )


def nse_seed(spark: SparkSession) -> DataFrame:
    return _equities(spark, "NSE")


def bse_equities(spark: SparkSession) -> DataFrame:
    return _equities(spark, "BSE")


def indices(spark: SparkSession) -> DataFrame:
    return complete_universe(_curated(spark, "INDEX").withColumns({
        "exchange": index_exchange(F.col("name")), "asset_type": F.lit("INDEX"),
    }))


def etfs(spark: SparkSession) -> DataFrame:
    return complete_universe(
        _curated(spark, "ETF").drop("yfinance_ticker")
        .withColumns({"exchange": F.lit("NSE"), "asset_type": F.lit("ETF")})
    )


def _unlisted(spark: SparkSession, asset_type: str) -> DataFrame:
    return complete_universe(_curated(spark, asset_type).withColumns({
        "exchange": F.lit("MULTI"), "asset_type": F.lit(asset_type),
    }))


def commodities(spark: SparkSession) -> DataFrame:
    return _unlisted(spark, "COMMODITY")


def forex(spark: SparkSession) -> DataFrame:
    return _unlisted(spark, "FOREX")


def read_listing(spark: SparkSession, path: str) -> DataFrame:
    """An exchange listing CSV with a header line, parsed."""
    lines = spark.read.option("header", True).option("escape", '"').option("multiLine", True)
    return parse_listing(lines.csv(path))


def nse_equities(spark: SparkSession, path: str | None) -> DataFrame:
    """The listing file's equities, or the seed list if there is no file that can be read whole.

    The file is read here and now, so that one that can't be decoded is found in time.
    """
    if path is not None:
        try:
            return written(read_listing(spark, path), "listing")
        except (AnalysisException, Py4JJavaError, PySparkException) as problem:
            log.warning("listing %s is not readable, using the seed list: %s", path, problem)
    return nse_seed(spark)


def discover(
    spark: SparkSession, listing_path: str | None = None, order: str | None = None
) -> DataFrame:
    """The full universe: exchange equities and all curated lists."""
    return build_universe(
        [
            nse_equities(spark, listing_path), bse_equities(spark), indices(spark),
            etfs(spark), commodities(spark), forex(spark),
        ],
        order,
    )
