"""What the planner makes of the operators: shuffles, pruning, where rows are combined."""

from __future__ import annotations

import re
from datetime import date

import pytest
from pyspark.sql import functions as F

from barloom.operators.checks import DUPLICATES, OHLC_CONSISTENCY, Settings, run_checks
from barloom.operators.catalog import orphan_log_rows
from barloom.operators.ingest import select_missing
from barloom.operators.merge import dedupe_bars, delete_assets
from barloom.operators.profile import last_dates
from barloom.operators.repair import repair_ohlc
from barloom.operators.report import validation_report
from barloom.sources.store import BarStore
from sample import bar
from workload.bars import QUERIES

SF = "/root/testdata/sf0.001"
SETTINGS = Settings(as_of=date(2024, 6, 30))


@pytest.fixture(autouse=True)
def whole_text(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    yield
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def plan(df) -> str:
    text = df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))
    return text


def shuffles(text: str) -> list[str]:
    return re.findall(r"Exchange (\w+partitioning\([^)]*\)|SinglePartition)", text)


@pytest.fixture
def stored(spark, tmp_path, make_bars):
    rows = [
        bar(date(year, 1, day), 1.0, 2.0, 0.5, 1.5, symbol=s, asset_type=t, seq=day)
        for year in (2022, 2023, 2024) for day in (2, 3)
        for s, t in (("TCS", "EQUITY"), ("NIFTY 50", "INDEX"))
    ]
    store = BarStore(spark, str(tmp_path / "store"))
    store.save(make_bars(rows))
    return store


def test_checks_shuffle_spans_then_assets(stored, assets):
    report = plan(validation_report(assets, stored.load(), SETTINGS))
    keyed = [s for s in shuffles(report) if "storage_key" in s]
    assert len(keyed) == 2
    assert "span#" in keyed[1] and "span#" not in keyed[0]
    # Combined before the first shuffle, in one scan.
    assert report.rindex("Exchange") < report.rindex("partial_count") < report.index("FileScan")
    assert report.count("FileScan") == 1


def test_checks_without_dates_shuffle_once(stored):
    text = plan(run_checks(stored.load(), SETTINGS, [OHLC_CONSISTENCY]))
    assert len(shuffles(text)) == 1
    scanned = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert scanned.startswith("open:double") and "volume" not in scanned


def test_duplicate_check_reads_only_dates_and_keys(stored):
    text = plan(run_checks(stored.load(), SETTINGS, [DUPLICATES]))
    assert "ReadSchema: struct<date:date,storage_key:string>" in text


def test_keep_last_cuts_each_key_before_the_shuffle(stored):
    text = plan(dedupe_bars(stored.load()))
    partial, shuffle = text.index("row_number(), 1, Partial"), text.index("Exchange hashpart")
    assert text.index("row_number(), 1, Final") < shuffle < partial


def test_loads_prune_directories_and_push_filters(stored):
    text = plan(stored.load(date(2023, 1, 1), date(2023, 12, 31), "equity", ["TCS"]))
    assert re.search(r"PartitionFilters: \[.*bar_year.*2023", text)
    assert re.search(r"PartitionFilters: \[.*asset_type.*EQUITY", text)
    assert re.search(r"PushedFilters: \[.*GreaterThanOrEqual\(date,2023-01-01\)", text)
    assert re.search(r"PushedFilters: \[.*storage_key,TCS", text)
    assert "volume" not in plan(last_dates(stored.load())).split("ReadSchema")[1].split("\n")[0]


def test_repair_does_not_shuffle_bars(stored):
    text = plan(repair_ohlc(stored.load()))
    assert not shuffles(text)
    assert text.count("BroadcastHashJoin") == 1


@pytest.mark.parametrize("name", [
    "validation_report", "upsert_keep_last", "repair_ohlc", "repair_assets", "resume_plan",
    "status_summary", "all_assets", "download_history", "select_missing", "date_gaps",
])
def test_no_cross_join_no_python_no_single_partition_window(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert "CartesianProduct" not in text and "NestedLoop" not in text
    assert "Python" not in text and "MapInPandas" not in text
    if name != "status_summary":
        assert "SinglePartition" not in text


def test_repair_of_stored_bars_looks_only_for_missing_bounds(stored):
    bars = stored.load()
    flagged = bars.select("asset_type", "storage_key").distinct()
    text = plan(repair_ohlc(bars, flagged, has_nan=False))
    assert re.search(r"PushedFilters: \[Or\(IsNull\(high\),IsNull\(low\)\)", text)


def test_a_scoped_validation_reads_its_assets_once(stored, spark, assets):
    bars = stored.load(storage_keys=["TCS"])
    text = plan(validation_report(assets, bars, SETTINGS))
    assert text.count("FileScan parquet") == 1
    assert re.search(r"PushedFilters: \[.*EqualTo\(storage_key,TCS\)", text)


@pytest.mark.parametrize("operator", ["delete", "missing", "orphans"])
def test_a_heavy_asset_is_split(spark, make_bars, tmp_path, operator):
    """Broadcasts off, one asset with four fifths of the rows: its join partition is cut up."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10k",
    }
    rows = spark.range(40_000).selectExpr(
        "if(id % 5 > 0, 'HOT', concat('S', id % 400)) as symbol", "'EQUITY' as asset_type",
        "if(id % 5 > 0, 'HOT', concat('S', id % 400)) as storage_key",
        "date_add(date'2000-01-01', cast(id as int)) as date", "rand(1) as open")
    rows.repartition(16).write.parquet(str(tmp_path / "rows"))
    bars = spark.read.parquet(str(tmp_path / "rows"))
    keys = bars.select("symbol", "asset_type", "storage_key").distinct().where("symbol <> 'S5'")
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        if operator == "delete":
            out = delete_assets(bars, keys.where("symbol <> 'HOT'"))
        elif operator == "missing":
            span = {"start_date": F.lit(date(1990, 1, 1)), "end_date": F.lit(date(2200, 1, 1)),
                    "skipped": F.lit(False)}
            out = select_missing(bars, keys.withColumns(span))
        else:
            out = orphan_log_rows(bars, keys.where("symbol <> 'HOT'"))
        out.write.format("noop").mode("overwrite").save()
        out.collect()
        assert "skew=true" in plan(out)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_ordered_results_come_in_order(spark):
    log = [tuple(r) for r in QUERIES["download_history"](spark, SF).select("symbol", "download_time").collect()]
    assert log == sorted(log, key=lambda r: (r[0], -r[1].timestamp()))
    checks = [tuple(r) for r in QUERIES["validation_history"](spark, SF).select("symbol", "validated_at").collect()]
    assert checks == sorted(checks, key=lambda r: (r[0], -r[1].timestamp()))
    symbols = [r.symbol for r in QUERIES["all_assets"](spark, SF).collect()]
    assert symbols == sorted(symbols)
