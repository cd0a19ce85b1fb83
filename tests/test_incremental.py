"""Summaries that are merged, kept by a stream, and the ledger of landed files."""

from __future__ import annotations

import re
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from barloom.operators.checks import ALL_CHECKS, Settings
from barloom.operators.report import report_of, validation_report
from barloom.operators.summary import summarise, summary_assets, summary_verdicts, with_year
from barloom.plans.sync import Site, run_discover, run_ingest, run_validate
from barloom.sources.class_years import ClassYears
from barloom.sources.ledger import FileLedger, landed_files, paths_of
from barloom.streaming.validation import landed_bars, put, start_validation, summaries
from sample import bar
from test_brute_force import content, random_rows
from test_sync import land, raw

NOW = Settings(as_of=date(2024, 6, 30))


def flat(report):
    details = F.sort_array(F.map_entries("details"))
    return content(report.withColumn("details", details.cast("string")))


@pytest.mark.parametrize("seed", [3, 4])
def test_reports_from_merged_summaries(spark, make_bars, assets, seed):
    """Wherever bars are cut into parts: the same report, as if they were one."""
    rows = random_rows(seed, 300)
    bars = make_bars([(*r[:6], r[6] or 0, *r[7:]) for r in rows])
    universe = bars.select("symbol", "asset_type", "storage_key").distinct().unionByName(assets)
    whole = flat(validation_report(universe, bars, NOW))
    cut = F.pmod(F.col("seq"), F.lit(3))
    parts = [summarise(bars.where(cut == i)) for i in range(3)]
    merged = parts[0].unionByName(parts[1]).unionByName(parts[2])
    assert flat(report_of(summary_verdicts(universe, merged, NOW, columns=bars.columns))) == whole
    assert content(summary_assets(merged)) == content(bars.groupBy("asset_type", "storage_key").agg(
        F.max("date").alias("last_date"), F.count("*").alias("row_count")))


def test_gaps_over_the_end_of_a_year(make_bars, assets):
    """A span that the year's end cuts, one that ends with it, and a gap over a whole year."""
    days = [date(2022, 12, 20), date(2022, 12, 30), date(2023, 1, 2), date(2023, 1, 9),
            date(2025, 1, 6), None, None]
    bars = make_bars([bar(d, 1.0, 1.0, 1.0, 1.0, seq=i) for i, d in enumerate(days)])
    report = report_of(summary_verdicts(assets, summarise(bars), NOW, columns=bars.columns))
    assert flat(report) == flat(validation_report(assets, bars, NOW))
    gaps = report.where("check_name = 'missing_trading_days'").first()
    assert gaps["rows_affected"] == 3 and "728" in gaps["message"]


def test_a_summary_without_a_checks_counters_is_refused(make_bars, assets):
    bars = make_bars([bar(date(2024, 1, 2), 1.0, 1.0, 1.0, 1.0)])
    with pytest.raises(ValueError, match="null_open"):
        summary_verdicts(assets, summarise(bars).drop("null_open"), NOW, ALL_CHECKS, bars.columns)


def test_validation_reads_no_bars(spark, tmp_path, make_bars, monkeypatch):
    site = Site.at(spark, str(tmp_path), datetime(2024, 2, 1))
    run_discover(site)
    site.store.save(make_bars([
        bar(date(2024, 1, 2), 1.0, 1.0, 1.0, 1.0, symbol="NIFTY 50", asset_type="INDEX")]))
    universe = site.catalog.universe()
    verdicts = site.store.verdicts(universe, NOW)
    assert not any("/bars/" in f for f in verdicts.inputFiles())
    pushed = site.store.verdicts(universe, NOW, "INDEX", ["NIFTY_50"])
    text = pushed._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PushedFilters: \[[^\n]*(EqualTo|In)\(storage_key", text)
    assert run_validate(site, "NIFTY 50").count() == 6


def test_class_years_survive_a_writer_that_died(spark, tmp_path, make_bars, monkeypatch):
    bars = make_bars([bar(date(y, 1, 2), 1.0, 1.0, 1.0, 1.0, seq=y) for y in (2022, 2023, 2024)])
    table = ClassYears(spark, str(tmp_path / "t"), with_year(bars).schema)
    assert table.read().count() == 0
    table.replace(with_year(bars))
    changed = with_year(bars.where("seq = 2023").withColumn("open", F.lit(9.0)))
    with monkeypatch.context() as m:
        m.setattr(table, "recover", lambda: None)
        table.replace(changed)  # staged, and no more
    assert {r.open for r in table.read().collect()} == {1.0}
    table.recover()
    assert sorted(r.open for r in table.read().collect()) == [1.0, 1.0, 9.0]


def test_a_replayed_batch_counts_once(spark, tmp_path, make_bars):
    """A batch holds totals: put twice, or after it was put in part, it changes nothing."""
    table = summaries(spark, str(tmp_path / "summaries"))
    landing, checkpoint = str(tmp_path / "landing"), str(tmp_path / "checkpoint")
    everything = []
    for n, rows in enumerate([
            [raw("TCS", "2023-12-28", 1.0, 1), raw("TCS", "2024-01-02", 1.0, 2), raw("INFY", None, 1.0, 3)],
            [raw("TCS", "2024-01-02", 2.0, 4), raw("INFY", "2024-01-03", 1.0, 5)]]):
        land(spark, landing, rows, "parquet")
        everything += rows
        start_validation(spark, landing, table, checkpoint, name=f"v{n}").awaitTermination()
    start_validation(spark, landing, table, checkpoint, name="idle").awaitTermination()
    expected = summarise(landed_bars(spark.read.parquet(landing)))
    assert content(table.read().select(expected.columns)) == content(expected)
    for _ in range(2):
        put(table, expected.where("asset_type = 'EQUITY'"))
    assert content(table.read().select(expected.columns)) == content(expected)


def test_only_new_files_are_read(spark, tmp_path, monkeypatch):
    landing = str(tmp_path / "landing")
    asked = []
    import barloom.plans.sync as sync

    real = sync.read_landed
    monkeypatch.setattr(sync, "read_landed", lambda s, paths, fmt: asked.append(len(paths)) or real(s, paths, fmt))
    site = Site.at(spark, str(tmp_path / "site"), datetime(2024, 2, 1, 12))
    run_discover(site)

    def arrive(*rows):
        land(spark, landing, list(rows), "parquet")

    arrive(raw("NIFTY 50", "2024-01-02", 1.0, 1, kind="INDEX"))
    assert run_ingest(site, landing).first()["total_rows"] == 1
    assert run_ingest(site, landing).first()["total_rows"] == 0
    assert len(asked) == 1  # nothing to read in the second run
    # A bar of a later day: its file is read again once that day has come.
    arrive(raw("NIFTY 50", "2024-01-03", 1.0, 1, kind="INDEX"),
           raw("NIFTY 50", "2024-02-05", 1.0, 2, kind="INDEX"))
    assert run_ingest(site, landing).first()["total_rows"] == 1
    later = Site.at(spark, str(tmp_path / "site"), datetime(2024, 2, 9, 12))
    assert run_ingest(later, landing).first()["total_rows"] == 1
    n = len(asked)
    assert run_ingest(later, landing).first()["total_rows"] == 0 and len(asked) == n
    # Runs for some assets, or from a given day, read everything.
    run_ingest(later, landing, symbols="NIFTY 50")
    run_ingest(later, landing, start=date(2024, 1, 1))
    assert len(asked) == n + 2
    assert site.store.load().count() == 3


def test_ledger(spark, tmp_path):
    folder = str(tmp_path / "landing")
    assert landed_files(spark, folder).count() == 0
    spark.range(3).repartition(2).write.parquet(folder)
    ledger = FileLedger(spark, str(tmp_path / "ledger"))
    listing = landed_files(spark, folder)
    n = listing.count()
    new = ledger.not_taken(listing, "a")
    assert n >= 1 and len(paths_of(new)) == n and spark.read.parquet(*paths_of(new)).count() == 3
    ledger.take(new.limit(1), "a", "run")
    assert ledger.not_taken(listing, "a").count() == n - 1
    assert ledger.not_taken(listing, "b").count() == n
    # Written anew under its old name.
    changed = listing.withColumn("file_size", F.col("file_size") + 1)
    assert ledger.not_taken(changed, "a").count() == n
