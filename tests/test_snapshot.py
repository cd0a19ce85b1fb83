"""Snapshots by class and year: what is written, what is left alone, what a dead export leaves."""

from __future__ import annotations

import os
from datetime import date

import pytest
from pyspark.sql import functions as F

from barloom.sources import snapshot as S
from barloom.sources.class_years import ClassYears
from barloom.sources.store import BarStore
from sample import bar
from test_brute_force import content


@pytest.fixture
def bars(make_bars):
    return make_bars([
        bar(date(year, 1, 2), 1.0, 2.0, 0.5, 1.5, symbol=s, asset_type=t, seq=year)
        for year in (2022, 2023, 2024) for s, t in (("TCS", "EQUITY"), ("NIFTY 50", "INDEX"))
    ])


def delta(found) -> set:
    return {(r.asset_type, r.bar_year, r.change) for r in found.collect()}


def written_files(path: str) -> dict:
    return {os.path.join(at, f): os.stat(os.path.join(at, f)).st_mtime_ns
            for at, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def rows(df) -> list:
    return content(df.select(*sorted(df.columns)))


def test_only_class_years_that_differ_are_written(spark, bars, tmp_path):
    path = str(tmp_path / "snapshot")
    assert len(S.export_snapshot(bars, None, path)) == 6
    before = written_files(f"{path}/bars/rows")
    # Another order and other partitions are the same bars.
    assert S.export_snapshot(bars.orderBy(F.desc("seq")).repartition(3), None, path) == []
    assert written_files(f"{path}/bars/rows") == before

    changed = bars.where("not (asset_type = 'INDEX' and year(date) = 2022)").withColumn(
        "open", F.expr("if(asset_type = 'EQUITY' and year(date) = 2023, 7, open)"))
    assert delta(S.snapshot_delta(changed, path)) == {
        ("EQUITY", 2023, "changed"), ("INDEX", 2022, "gone")}
    assert S.export_snapshot(changed, None, path) == [("EQUITY", 2023), ("INDEX", 2022)]
    after = written_files(f"{path}/bars/rows")
    kept = {f for f in before if "EQUITY/bar_year=2023" not in f and "INDEX/bar_year=2022" not in f}
    assert {f: after.get(f) for f in kept} == {f: before[f] for f in kept}
    assert len(after) == 5
    got = S.import_snapshot(spark, path)
    assert rows(got) == rows(changed.select(*got.columns))
    assert S.unlike_fingerprints(spark, path).collect() == []


def test_fingerprints_see_repeats_and_nulls(bars, make_bars):
    def of(df):
        return {tuple(r) for r in S.fingerprints(df).collect()}

    assert of(bars) == of(bars.repartition(5))
    # A bar that is there twice leaves the xor as without it, but not the count and the sum.
    assert of(bars) != of(bars.unionAll(bars.where("symbol = 'TCS'")))
    assert of(bars.unionAll(bars)) != of(bars.limit(0))
    day = date(2024, 1, 2)
    open_null = make_bars([bar(day, None, 3.0, 3.0, 1.0)])
    high_null = make_bars([bar(day, 3.0, None, 3.0, 1.0)])
    assert of(open_null) != of(high_null)
    assert of(bars.limit(0)) == set()


@pytest.mark.parametrize("step", ["stage", "overwrite", "mark"])
def test_an_export_that_dies_is_finished_by_the_next(spark, bars, tmp_path, monkeypatch, step):
    path = str(tmp_path / "snapshot")
    S.export_snapshot(bars, None, path)
    changed = bars.withColumn("open", F.expr("if(year(date) = 2023, 7, open)")).where("year(date) > 2022")
    replace, recover, calls = ClassYears.replace, ClassYears.recover, []

    def dying(self, *args):
        calls.append(self.path)
        at = {"stage": 2, "mark": 3}.get(step)
        if len(calls) == at:
            raise RuntimeError("killed")
        if step == "overwrite" and len(calls) == 2:
            monkeypatch.setattr(ClassYears, "recover", die_when_staged)
        replace(self, *args)

    def die_when_staged(self):
        if os.path.exists(f"{self.path}/complete"):
            raise RuntimeError("killed")

    monkeypatch.setattr(ClassYears, "replace", dying)
    with pytest.raises(RuntimeError, match="killed"):
        S.export_snapshot(changed, None, path)
    monkeypatch.setattr(ClassYears, "replace", replace)
    monkeypatch.setattr(ClassYears, "recover", recover)
    assert S.unlike_fingerprints(spark, path).count() > 0
    # Also if the next one has the old bars again.
    for now in (changed, bars):
        S.export_snapshot(now, None, path)
        got = S.import_snapshot(spark, path)
        assert rows(got) == rows(now.select(*got.columns))
        assert S.unlike_fingerprints(spark, path).collect() == []


def test_bars_of_a_store_are_read_where_they_differ(spark, bars, tmp_path):
    store, path = BarStore(spark, str(tmp_path / "store")), str(tmp_path / "snapshot")
    store.save(bars)
    S.export_snapshot(store.bars(), None, path)
    store.save(bars.where("year(date) = 2024 and asset_type = 'INDEX'").withColumn("open", F.lit(9.0)))
    assert S.export_snapshot(store.bars(), None, path) == [("INDEX", 2024)]
    assert S.unlike_fingerprints(spark, path, ["index"]).collect() == []


def test_lost_files_are_noticed(spark, bars, tmp_path):
    path = str(tmp_path / "snapshot")
    S.export_snapshot(bars, None, path)
    lost = next(f for f in written_files(f"{path}/bars/rows") if "EQUITY/bar_year=2023" in f)
    os.remove(lost)
    assert [tuple(r) for r in S.unlike_fingerprints(spark, path).collect()] == [("EQUITY", 2023)]
    assert S.unlike_fingerprints(spark, path, ["INDEX"]).collect() == []
