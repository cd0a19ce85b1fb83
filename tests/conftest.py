from __future__ import annotations

import os
import sys
import tempfile
from datetime import date

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from barloom.session import build_session  # noqa: E402
from sample import bar  # noqa: E402

BARS = (
    "date date, open double, high double, low double, close double, adj_close double, "
    "volume bigint, dividends double, stock_splits double, symbol string, asset_type string, "
    "storage_key string, seq bigint"
)


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false",
        spark__driver__memory="8g",
    )
    session.sparkContext.setLogLevel("ERROR")
    if not session.conf.get("spark.checkpoint.dir", None):
        session.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="barloom-"))
    yield session
    session.stop()


@pytest.fixture
def make_bars(spark):
    return lambda rows: spark.createDataFrame(rows, BARS)


@pytest.fixture
def good_bars(make_bars):
    return make_bars([
        bar(date(2024, 1, 2), 41.5, 42.25, 40.75, 41.9, 7300, seq=1),
        bar(date(2024, 1, 3), 41.9, 43.0, 41.6, 42.8, 8150, seq=2),
        bar(date(2024, 1, 4), 42.8, 43.4, 42.1, 42.3, 6900, seq=3),
        bar(date(2024, 1, 5), 42.3, 44.1, 42.0, 43.95, 9400, seq=4),
        bar(date(2024, 1, 8), 43.9, 44.6, 43.2, 44.5, 10200, seq=5),
    ])


@pytest.fixture
def bad_bars(make_bars):
    """A repeated date, a negative volume, a low above the high, an open above the high."""
    return make_bars([
        bar(date(2024, 1, 2), 41.5, 42.25, 40.75, 41.9, 7300, seq=1),
        bar(date(2024, 1, 2), 41.7, 42.6, 41.1, 42.4, -75, seq=2),
        bar(date(2024, 1, 4), 42.7, 42.5, 43.1, 42.9, 6900, seq=3),
        bar(date(2024, 1, 5), 44.9, 44.1, 42.0, 43.95, 9400, seq=4),
        bar(date(2024, 1, 8), 43.9, 44.6, 43.2, 44.5, 10200, seq=5),
    ])


@pytest.fixture
def assets(spark):
    return spark.createDataFrame(
        [("RELIANCE", "EQUITY", "RELIANCE"), ("NIFTY 50", "INDEX", "NIFTY_50")],
        "symbol string, asset_type string, storage_key string",
    )
