"""The interleaved layout: what a read of one asset and one month takes in."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from barloom.sources.layout import interleaved, scan_asset_range, write_interleaved
from test_brute_force import content
from test_plans import plan, whole_text  # noqa: F401

ASSETS = 400


@pytest.fixture(scope="module")
def many(spark):
    """Daily bars of a year for 400 assets, a third of all rows being one asset's."""
    days = spark.range(366).select(F.expr("date_add(date'2024-01-01', cast(id as int))").alias("date"))
    keys = spark.range(ASSETS).select(F.concat(F.lit("S"), "id").alias("symbol")).unionAll(
        spark.range(ASSETS // 2).select(F.lit("S7").alias("symbol")))
    priced = days.crossJoin(keys)
    number = F.xxhash64("symbol", "date")
    cells = {c: (F.pmod(number, F.lit(10_007)) / 7).alias(c)
             for c in ("open", "high", "low", "close", "adj_close")}
    return priced.select(
        "date", *cells.values(), F.pmod(number, F.lit(1 << 40)).alias("volume"),
        F.lit(0.0).alias("dividends"), F.lit(0.0).alias("stock_splits"), "symbol",
        F.lit("EQUITY").alias("asset_type"), F.col("symbol").alias("storage_key"),
        F.monotonically_increasing_id().alias("seq"))


@pytest.fixture(scope="module")
def path(many, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("layout") / "bars")
    write_interleaved(many, folder, assets_in_group=ASSETS, row_group_bytes=32 << 10)
    return folder


def rows_read(df) -> int:
    """How many rows the file scan gave to the filter above it."""
    df.collect()
    executed = df._jdf.queryExecution().executedPlan()
    leaves = executed.collectLeaves()
    scan = leaves.apply(0)
    return scan.metrics().apply("numOutputRows").value()


def test_the_order_keeps_neighbours_together(spark):
    frame = spark.sql("select 'A' as k, explode(sequence(date'2024-01-01', date'2024-12-31')) as d")
    places = [r.z for r in frame.select(interleaved(F.col("k"), F.col("d")).alias("z")).collect()]
    assert len(set(places)) == 183 and places == sorted(places)
    assert 0 <= min(places) and max(places) < 1 << 16
    assert spark.sql("select 'A' as k, cast(null as date) as d").select(
        interleaved(F.col("k"), F.col("d")).isNotNull()).first()[0]


def test_one_asset_and_one_month(spark, many, path):
    start, end = date(2024, 3, 1), date(2024, 3, 31)
    found = scan_asset_range(spark, path, ["S11"], start, end, "EQUITY")
    wanted = many.where("storage_key = 'S11' and month(date) = 3").select(*found.columns)
    assert found.count() == 31 and content(found) == content(wanted)
    total = many.count()
    read = rows_read(scan_asset_range(spark, path, ["S11"], start, end, "EQUITY"))
    assert 31 <= read < 0.05 * total
    text = plan(found)
    assert "PushedFilters: [" in text and "EqualTo(storage_key,S11)" in text
    assert "bar_year#" in text.split("PartitionFilters: [")[1].split("]")[0]


def test_an_asset_that_is_not_there(spark, many, path):
    """Its name lies between others, so least and greatest keys don't tell; the filters do."""
    absent = scan_asset_range(spark, path, ["S11x"])
    assert rows_read(absent) < 0.05 * many.count() and absent.count() == 0


def test_the_heavy_asset_is_whole(spark, many, path):
    found = scan_asset_range(spark, path, ["S7"])
    assert found.count() == 366 * (ASSETS // 2 + 1)
    assert scan_asset_range(spark, path, ["S7", "S8"], date(2024, 2, 1), date(2024, 2, 1)).count() == ASSETS // 2 + 2
