from __future__ import annotations

from datetime import date

from barloom.operators.ingest import (
    download_log_rows,
    ingest_results,
    ingest_summary,
    resume_plan,
    select_missing,
    throttled,
)
from sample import bar


def plan(assets, bars, *args):
    return {r.symbol: r for r in resume_plan(assets, bars, *args).collect()}


def test_resume_after_the_last_date(assets, good_bars):
    rows = plan(assets, good_bars, date(2024, 2, 1))
    assert rows["RELIANCE"].start_date == date(2024, 1, 9) and not rows["RELIANCE"].skipped
    assert rows["NIFTY 50"].start_date == date(1990, 1, 1) and not rows["NIFTY 50"].skipped
    assert rows["NIFTY 50"].last_date is None


def test_up_to_date_assets_are_skipped(assets, good_bars):
    assert plan(assets, good_bars, date(2024, 1, 9))["RELIANCE"].skipped
    assert not plan(assets, good_bars, date(2024, 1, 10))["RELIANCE"].skipped


def test_an_explicit_start_skips_nothing(assets, good_bars):
    rows = plan(assets, good_bars, date(2024, 1, 5), date(2023, 1, 1))
    assert {r.start_date for r in rows.values()} == {date(2023, 1, 1)}
    assert not any(r.skipped for r in rows.values())


def test_landed_rows_inside_the_plan(assets, good_bars, make_bars):
    landed = make_bars([bar(date(2024, 1, d), 1.0, 1.0, 1.0, 1.0) for d in range(5, 15)])
    planned = resume_plan(assets, good_bars, date(2024, 1, 12))
    days = sorted(r.date.day for r in select_missing(landed, planned).collect())
    assert days == [9, 10, 11]
    # Planned twice, taken once.
    assert select_missing(landed, planned.unionByName(planned)).count() == 3


def test_results_and_log(spark, assets, good_bars, make_bars):
    landed = make_bars([bar(date(2024, 1, 9), 1.0, 1.0, 1.0, 1.0)])
    planned = resume_plan(assets, good_bars, date(2024, 1, 12))
    results = ingest_results(planned, select_missing(landed, planned))
    log = {r.symbol: r for r in download_log_rows(results).collect()}
    assert (log["RELIANCE"].status, log["RELIANCE"].rows_downloaded) == ("success", 1)
    assert log["RELIANCE"].file_path == "stocks/RELIANCE"
    # No rows came: logged as an error without a text, not counted as failed.
    assert (log["NIFTY 50"].status, log["NIFTY 50"].error_message) == ("error", "")
    assert log["NIFTY 50"].file_path == ""
    assert tuple(ingest_summary(results).first()) == (1, 0, 0, 1)


def test_summary_of_nothing(spark):
    empty = spark.createDataFrame([], "rows_added bigint, error string, skipped boolean")
    assert tuple(ingest_summary(empty).first()) == (0, 0, 0, 0)


def test_throttled_log_rows(spark):
    log = spark.createDataFrame([("429",), ("bad",), (None,)], "error_message string")
    assert [r.throttle for r in throttled(log).collect()] == [True, False, False]
