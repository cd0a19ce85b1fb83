from __future__ import annotations

from datetime import date

import pytest

from barloom.operators import checks as C
from sample import bar

SETTINGS = C.Settings(as_of=date(2024, 6, 30))


def outcome(bars, check, settings=SETTINGS, **options):
    rows = C.run_checks(bars, settings, [check], **options).collect()
    assert len(rows) == 1
    return rows[0]


def test_good_bars_pass_every_check(good_bars):
    rows = C.run_checks(good_bars, SETTINGS).collect()
    assert [r.check_name for r in rows] == [c.name for c in C.ALL_CHECKS]
    assert {r.status for r in rows} == {"PASSED"}
    assert {r.rows_affected for r in rows} == {0}
    assert all(r.details is None for r in rows)


def test_duplicates_count_every_row_of_a_repeated_date(bad_bars):
    r = outcome(bad_bars, C.DUPLICATES)
    assert (r.status, r.rows_affected) == ("FAILED", 2)
    assert r.message == "Found 2 duplicate rows by date"


def test_repeated_null_dates_are_duplicates_but_no_gap(make_bars):
    bars = make_bars([
        bar(None, 1.0, 1.0, 1.0, 1.0), bar(None, 1.0, 1.0, 1.0, 1.0),
        bar(date(2024, 1, 2), 1.0, 1.0, 1.0, 1.0),
    ])
    assert outcome(bars, C.DUPLICATES).rows_affected == 2
    assert outcome(bars, C.MISSING_TRADING_DAYS).status == "PASSED"


def test_ohlc_counts_three_rules_independently(bad_bars):
    r = outcome(bad_bars, C.OHLC_CONSISTENCY)
    assert (r.status, r.rows_affected) == ("FAILED", 4)
    assert r.details == {"high_lt_low": 1, "open_out_of_range": 2, "close_out_of_range": 1}


def test_nan_prices_break_no_rule_and_count_as_null(make_bars):
    bars = make_bars([bar(date(2024, 1, 2), 100.0, float("nan"), 99.0, 101.0)])
    assert outcome(bars, C.OHLC_CONSISTENCY).status == "PASSED"
    assert outcome(bars, C.NULL_VALUES).details == {"high": 1}


def test_negative_volume(bad_bars):
    r = outcome(bad_bars, C.NEGATIVE_VOLUME)
    assert (r.status, r.rows_affected) == ("FAILED", 1)


def test_nulls_are_counted_per_cell(make_bars):
    bars = make_bars([
        bar(date(2024, 1, 2), None, 105.0, 99.0, 103.0),
        bar(date(2024, 1, 3), None, 105.0, 99.0, 103.0, volume=None),
    ])
    r = outcome(bars, C.NULL_VALUES)
    assert (r.status, r.rows_affected, r.details) == ("WARNING", 3, {"open": 2, "volume": 1})
    assert r.message == "Found 3 null values across critical columns"


@pytest.mark.parametrize(("second", "message", "details"), [
    (date(2024, 1, 7), None, None),
    (date(2024, 1, 8), "Found 1 gaps > 5 days", {"gap_count": 1}),
    (date(2024, 1, 17), "Found 1 gaps > 5 days", {"gap_count": 1}),
    (date(2024, 2, 1), "Found 1 gaps > 5 days (max gap: 30 days)",
     {"gap_count": 1, "max_gap_days": 30}),
])
def test_gaps_in_calendar_days(make_bars, second, message, details):
    bars = make_bars([bar(d, 1.0, 1.0, 1.0, 1.0) for d in (date(2024, 1, 2), second)])
    r = outcome(bars, C.MISSING_TRADING_DAYS)
    assert r.status == ("WARNING" if message else "PASSED")
    assert r.message == (message or "No gaps larger than 5 days")
    assert r.details == details


def test_gap_limit_above_the_very_large_one(make_bars):
    bars = make_bars([bar(d, 1.0, 1.0, 1.0, 1.0) for d in (date(2024, 1, 2), date(2024, 1, 20))])
    assert outcome(bars, C.MISSING_TRADING_DAYS,
                   C.Settings(SETTINGS.as_of, max_gap_days=18)).status == "PASSED"
    assert "max gap: 18" in outcome(bars, C.MISSING_TRADING_DAYS,
                                    C.Settings(SETTINGS.as_of, max_gap_days=17)).message


def test_dates_before_1970_and_gaps_over_many_spans(make_bars):
    days = [date(1900, 1, 1), date(1969, 12, 31), date(1970, 1, 1), date(1970, 1, 3)]
    gaps = C.date_gaps(make_bars([bar(d, 1.0, 1.0, 1.0, 1.0) for d in days]))
    assert {(r.date, r.gap_days) for r in gaps.collect()} == {
        (days[i], (days[i] - days[i - 1]).days) for i in (1, 2, 3)
    }


def test_future_dates_hide_old_ones(make_bars):
    old = bar(date(1985, 1, 2), 1.0, 1.0, 1.0, 1.0)
    future = bar(date(2024, 7, 1), 1.0, 1.0, 1.0, 1.0)
    r = outcome(make_bars([old, future]), C.DATA_RANGE)
    assert (r.status, r.message) == ("FAILED", "Found 1 rows with future dates")
    r = outcome(make_bars([old]), C.DATA_RANGE)
    assert (r.status, r.message) == ("WARNING", "Found 1 rows before 1990")


def test_missing_columns_are_skipped_with_their_message(good_bars):
    bare = good_bars.select("asset_type", "storage_key", "seq")
    rows = {r.check_name: r for r in C.run_checks(bare, SETTINGS).collect()}
    assert {r.status for r in rows.values()} == {"SKIPPED"}
    assert rows["duplicates"].message == "No 'date' column found"
    assert rows["null_values"].message == "No critical columns found"


def test_assets_without_bars_are_skipped(good_bars, assets):
    rows = C.run_checks(good_bars, SETTINGS, [C.DUPLICATES], assets=assets).collect()
    assert {(r.storage_key, r.status, r.message) for r in rows} == {
        ("RELIANCE", "PASSED", "No duplicate dates found"),
        ("NIFTY_50", "SKIPPED", "Empty DataFrame"),
    }


def test_an_added_check_shares_the_pass(good_bars):
    penny = C.Check(
        name="penny", needs=["close"], on_missing="no close",
        row_counters=lambda s, c: {"pennies": "close < 42"},
        outcomes=lambda s, c: [C.Outcome("pennies > 0", "WARNING", C.found("pennies", "pennies"),
                                         "pennies")],
        fine=lambda s: "fine",
    )
    rows = C.run_checks(good_bars, SETTINGS, [*C.ALL_CHECKS, penny]).collect()
    assert (rows[-1].check_name, rows[-1].message) == ("penny", "Found 1 pennies")


def test_negative_gap_limit_is_refused():
    with pytest.raises(ValueError):
        C.Settings(date(2024, 1, 1), max_gap_days=-1)
