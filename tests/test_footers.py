"""Counts and newest dates by class from file footers."""

from __future__ import annotations

from datetime import date

import pytest

from barloom.sources import footers as S
from barloom.sources.store import BarStore
from sample import bar
from test_plans import plan, whole_text  # noqa: F401


@pytest.fixture
def path(spark, make_bars, tmp_path):
    store = BarStore(spark, str(tmp_path / "store"))
    store.save(make_bars([
        bar(date(2022, 5, 3), 1.0, 1.0, 1.0, 1.0, seq=1), bar(date(2023, 1, 2), 1.0, 1.0, 1.0, 1.0, seq=2),
        bar(None, 1.0, 1.0, 1.0, 1.0, seq=3),
        bar(date(2021, 1, 1), 1.0, 1.0, 1.0, 1.0, symbol="NIFTY 50", asset_type="INDEX", seq=4),
        bar(None, 1.0, 1.0, 1.0, 1.0, symbol="GOLD", asset_type="COMMODITY", seq=5),
    ]))
    return f"{store.path}/bars"


def test_counts_and_dates(spark, path):
    counts = {r.asset_type: r.row_count for r in S.class_row_counts(spark, path).collect()}
    assert counts == {"EQUITY": 3, "INDEX": 1, "COMMODITY": 1}
    dates = {r.asset_type: r.last_date for r in S.class_last_dates(spark, path).collect()}
    # Bars without a date have no newest one.
    assert dates == {"EQUITY": date(2023, 1, 2), "INDEX": date(2021, 1, 1)}


def test_footers_answer(spark, path):
    with S.from_footers(spark):
        counted = plan(S.class_year_counts(spark, path))
        dated = plan(S.class_year_last_dates(spark, path))
    assert "PushedAggregation: [COUNT(*)]" in counted
    assert "PushedAggregation: [MAX(date)]" in dated
    for text in (counted, dated):
        assert "PushedGroupBy: [asset_type, bar_year]" in text


def test_settings_are_back_afterwards(spark, path):
    before = {name: spark.conf.get(name) for name in S.SETTINGS}
    with pytest.raises(RuntimeError):
        with S.from_footers(spark):
            raise RuntimeError
    S.class_row_counts(spark, path)
    assert {name: spark.conf.get(name) for name in S.SETTINGS} == before
    assert "BatchScan" not in plan(spark.read.parquet(path))
