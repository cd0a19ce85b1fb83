"""Checks that ask for aggregates beside counters, in one pass and from merged summaries."""

from __future__ import annotations

from datetime import date, timedelta

import pytest

from barloom.operators import checks as C
from barloom.operators.summary import summarise, summary_verdicts
from barloom.schema import WARNING
from sample import bar
from test_plans import plan, whole_text  # noqa: F401

SETTINGS = C.Settings(as_of=date(2024, 12, 31))
ADDED = [C.MISSING_TRADING_DAYS, C.price_outliers(), C.stale_prices(), C.NULL_VALUES]


def days(n: int, start: date = date(2023, 12, 1)) -> list[date]:
    return [start + timedelta(days=i) for i in range(n)]


@pytest.fixture
def odd_bars(make_bars):
    """Over a year's end: TCS has a spike and a dip, FLAT two closes, EMPTY none."""
    rows = [bar(d, 1.0, 1.0, 1.0, 10.0 + i % 7, symbol="TCS", seq=i) for i, d in enumerate(days(60))]
    rows += [bar(date(2024, 2, 20), 1.0, 1.0, 1.0, 900.0, symbol="TCS", seq=60)]
    rows += [bar(date(2024, 2, 21), 1.0, 1.0, 1.0, 0.5, symbol="TCS", seq=61)]
    rows += [bar(d, 1.0, 1.0, 1.0, 5.0 + i % 2, symbol="FLAT", seq=i) for i, d in enumerate(days(60))]
    rows += [bar(d, 1.0, 1.0, 1.0, c, symbol="EMPTY", seq=i)
             for i, (d, c) in enumerate(zip(days(12), [None, float("nan")] * 6))]
    return make_bars(rows)


def outcomes(results) -> dict:
    return {(r.storage_key, r.check_name): (r.status, r.rows_affected) for r in results.collect()}


def test_extremes_and_sketches(odd_bars):
    found = outcomes(C.run_checks(odd_bars, SETTINGS, ADDED))
    assert found["TCS", "price_outliers"] == (WARNING, 2)
    assert found["FLAT", "price_outliers"] == ("PASSED", 0)
    assert found["FLAT", "stale_prices"] == (WARNING, 60)
    assert found["TCS", "stale_prices"] == ("PASSED", 0)
    # Without a close there is nothing to compare.
    assert found["EMPTY", "price_outliers"] == ("PASSED", 0)
    assert found["EMPTY", "stale_prices"] == ("PASSED", 0)
    assert found["EMPTY", "null_values"] == (WARNING, 12)


def test_aggregates_without_dates(odd_bars):
    """Checks that need no dates go straight to assets, with the same outcomes."""
    alone = outcomes(C.run_checks(odd_bars, SETTINGS, [C.price_outliers(), C.stale_prices()]))
    shared = outcomes(C.run_checks(odd_bars, SETTINGS, ADDED))
    assert alone == {k: v for k, v in shared.items() if k in alone} and len(alone) == 6


def test_summaries_of_parts_give_the_same(odd_bars):
    """Cut by arrival, so that spans and years are cut as well."""
    universe = odd_bars.select("symbol", *C.ASSET_KEY).distinct()
    parts = [summarise(odd_bars.where(f"seq % 3 = {i}"), ADDED) for i in range(3)]
    merged = parts[0].unionByName(parts[1]).unionByName(parts[2])
    verdicts = summary_verdicts(universe, merged, SETTINGS, ADDED, odd_bars.columns)
    found = outcomes(verdicts.selectExpr("storage_key", "inline(outcomes)"))
    assert found == outcomes(C.run_checks(odd_bars, SETTINGS, ADDED))


def test_a_summary_made_without_the_check_is_refused(odd_bars, assets):
    with pytest.raises(ValueError, match="lacks"):
        summary_verdicts(assets, summarise(odd_bars), SETTINGS, ADDED, odd_bars.columns)


def test_checks_without_closes_are_skipped(odd_bars):
    found = outcomes(C.run_checks(odd_bars.drop("close"), SETTINGS, [C.price_outliers()]))
    assert {status for status, _ in found.values()} == {"SKIPPED"}


def test_a_check_with_an_aggregate_of_its_own(odd_bars):
    """Any aggregate that merges will do, such as the last bar's date and close."""
    low = C.Check(
        name="low_last_close",
        aggregates=lambda s, c: {"newest": C.Aggregate("max(struct(date, close))", "max({})")},
        outcomes=lambda s, c: [C.Outcome("newest.close < 1", WARNING, "'low'", "1L")],
        fine=lambda s: "not low", needs=["date", "close"],
    )
    found = outcomes(C.run_checks(odd_bars, SETTINGS, [C.MISSING_TRADING_DAYS, low]))
    assert found["TCS", "low_last_close"] == (WARNING, 1)
    assert found["FLAT", "low_last_close"] == ("PASSED", 0)


def test_one_scan_and_two_shuffles(odd_bars, tmp_path):
    path = str(tmp_path / "bars")
    odd_bars.write.parquet(path)
    text = plan(C.run_checks(odd_bars.sparkSession.read.parquet(path), SETTINGS, ADDED))
    assert text.count("FileScan parquet") == 1
    assert text.count("Exchange hashpartitioning") == 2
