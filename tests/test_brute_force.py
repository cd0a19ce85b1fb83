"""Operators against plain Python over random bars, with one very heavy asset."""

from __future__ import annotations

import random
from collections import defaultdict
from datetime import date, timedelta

import pytest

from barloom.operators import checks as C
from barloom.operators.merge import dedupe_bars, upsert_bars
from barloom.operators.repair import repair_assets, repair_ohlc, repaired_counts
from sample import bar


def random_rows(seed: int, count: int = 600) -> list[tuple]:
    rng = random.Random(seed)
    rows = []
    for seq in range(count):
        # A third of the rows are one asset's; some prices and dates are missing.
        symbol = "HOT" if rng.random() < 0.34 else f"S {rng.randrange(12)}"
        day = None if rng.random() < 0.02 else date(1989, 11, 1) + timedelta(rng.randrange(120))
        prices = [None if rng.random() < 0.05 else float(rng.randrange(1, 9)) for _ in range(4)]
        if rng.random() < 0.6 and None not in prices:
            o, c = prices[0], prices[3]
            prices = [o, max(o, c), min(o, c), c]
        rows.append(bar(day, *prices, volume=rng.choice([-1, 0, 5, None]), symbol=symbol, seq=seq,
                        asset_type="EQUITY" if symbol == "HOT" else "ETF"))
    return rows


def by_asset(rows):
    groups = defaultdict(list)
    for row in rows:
        groups[row[10], row[11]].append(row)
    return groups


def breaks(row) -> list[bool]:
    _, o, h, l, c = row[:5]

    def less(a, b):
        return a is not None and b is not None and a < b

    return [less(h, l), less(h, o) or less(o, l), less(h, c) or less(c, l)]


def spread(rows):
    if not any(any(breaks(r)) for r in rows):
        return rows
    fixed = []
    for r in rows:
        known = [p for p in r[1:5] if p is not None]
        high, low = (max(known), min(known)) if known else (None, None)
        fixed.append((r[0], r[1], high, low, *r[4:]))
    return fixed


def last_by_date(rows, order=lambda r: r[12]):
    latest = {}
    for row in sorted(rows, key=order):
        latest[row[0]] = row
    return list(latest.values())


def content(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_checks(make_bars, seed):
    rows, as_of = random_rows(seed), date(1990, 2, 1)
    actual = {}
    for r in C.run_checks(make_bars(rows), C.Settings(as_of, max_gap_days=1)).collect():
        actual[r.asset_type, r.storage_key, r.check_name] = (r.status, r.rows_affected, r.details)
    for key, group in by_asset(rows).items():
        dates = [r[0] for r in group]
        repeated = sum(1 for d in dates if dates.count(d) > 1)
        days = sorted({d for d in dates if d})
        gaps = [(b - a).days for a, b in zip(days, days[1:])]
        large = [g for g in gaps if g > 1]
        rules = [sum(r) for r in zip(*map(breaks, group))]
        nulls = {c: sum(r[i] is None for r in group)
                 for c, i in zip(C.CRITICAL_COLUMNS, (0, 1, 2, 3, 4, 6))}
        nulls = {c: n for c, n in nulls.items() if n}
        future = sum(d is not None and d > as_of for d in dates)
        old = sum(d is not None and d < date(1990, 1, 1) for d in dates)
        assert actual[*key, "duplicates"][:2] == ("FAILED" if repeated else "PASSED", repeated)
        gap_row = actual[*key, "missing_trading_days"]
        assert gap_row[:2] == ("WARNING" if large else "PASSED", len(large))
        if large and max(gaps) > 15:
            assert gap_row[2]["max_gap_days"] == max(gaps)
        named = {n: k for n, k in zip(C.OHLC_RULES, rules) if k}
        assert actual[*key, "ohlc_consistency"] == (
            "FAILED" if named else "PASSED", sum(rules), named or None)
        negative = sum(r[6] is not None and r[6] < 0 for r in group)
        assert actual[*key, "negative_volume"][1] == negative
        assert actual[*key, "null_values"][1:] == (sum(nulls.values()), nulls or None)
        assert actual[*key, "data_range"][:2] == (
            ("FAILED", future) if future else ("WARNING", old) if old else ("PASSED", 0))


@pytest.mark.parametrize("limit", [0, 1, 3, 5, 14, 15, 16, 20])
def test_gap_limits(make_bars, limit):
    rng = random.Random(limit)
    rows, wanted = [], {}
    for n in range(25):
        steps = [rng.choice([1, 2, 4, 6, limit, limit + 1, 17]) for _ in range(30)]
        days = [date(1969, 6, 1) + timedelta(rng.randrange(30))]
        for step in steps:
            days.append(days[-1] + timedelta(step))
        rows += [bar(d, 1.0, 1.0, 1.0, 1.0, symbol=f"S{n}") for d in days]
        large = [s for s in steps if s > limit]
        wanted[f"S{n}"] = (len(large), max(large) if large and max(large) > 15 else None)
    results = C.run_checks(make_bars(rows), C.Settings(date(2024, 1, 1), limit),
                           [C.MISSING_TRADING_DAYS])
    assert {r.storage_key: (r.rows_affected, (r.details or {}).get("max_gap_days"))
            for r in results.collect()} == wanted


@pytest.mark.parametrize("seed", [4, 5])
def test_gaps_and_repeats(make_bars, seed):
    rows = random_rows(seed)
    wanted_gaps, wanted_repeats = set(), set()
    for key, group in by_asset(rows).items():
        dates = [r[0] for r in group]
        days = sorted({d for d in dates if d})
        wanted_gaps |= {(*key, b, (b - a).days) for a, b in zip(days, days[1:])}
        wanted_repeats |= {(*key, d, dates.count(d)) for d in dates if dates.count(d) > 1}
    bars = make_bars(rows)
    assert {tuple(r) for r in C.date_gaps(bars).collect()} == wanted_gaps
    assert {tuple(r) for r in C.duplicate_rows(bars).collect()} == wanted_repeats


@pytest.mark.parametrize("seed", [6, 7])
def test_repair(make_bars, seed):
    rows = random_rows(seed)
    # One asset without any violation keeps its missing highs.
    rows += [bar(date(1990, 1, d), 2.0, None, 1.0, 2.0, symbol="CALM", seq=9000 + d)
             for d in range(1, 4)]
    groups = by_asset(rows).values()
    bars = make_bars(rows)
    order = bars.columns
    assert content(repair_ohlc(bars).select(order)) == sorted(
        (r for g in groups for r in spread(g)), key=repr)
    kept = [last_by_date(spread(g)) if any(any(breaks(r)) for r in g) else g for g in groups]
    assert content(repair_assets(bars).select(order)) == sorted(
        (r for g in kept for r in g), key=repr)
    counts = {(r.asset_type, r.storage_key): r.repaired_rows
              for r in repaired_counts(bars).collect()}
    assert counts == {k: n for k, g in by_asset(rows).items()
                      if (n := sum(any(breaks(r)) for r in g))}


@pytest.mark.parametrize("seed", [8, 9])
def test_merge(make_bars, seed):
    old = [r for r in random_rows(seed) if r[9] != "S 3"]
    new = [r for r in random_rows(seed + 100, 300) if r[9] != "S 5"]
    bars = make_bars(old)
    order = bars.columns
    assert content(dedupe_bars(bars).select(order)) == sorted(
        (r for g in by_asset(old).values() for r in last_by_date(g)), key=repr)

    stored, arriving = by_asset(old), by_asset(new)
    wanted = []
    for key in {*stored, *arriving}:
        if key in stored and key in arriving:
            ranked = [(0, r) for r in stored[key]] + [(1, r) for r in arriving[key]]
            ranked.sort(key=lambda pair: (pair[0], pair[1][12]))
            wanted += {r[0]: r for _, r in ranked}.values()
        else:
            wanted += stored.get(key, []) + arriving.get(key, [])
    assert content(upsert_bars(bars, make_bars(new)).select(order)) == sorted(wanted, key=repr)
