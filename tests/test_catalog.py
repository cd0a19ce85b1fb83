from __future__ import annotations

from datetime import date, datetime

import pytest

from barloom.operators import catalog as ops
from barloom.operators.catalog import query
from barloom.operators.checks import Settings
from barloom.operators.report import (
    batch_summary,
    report_rows,
    report_summary,
    validation_log_rows,
    validation_report,
)
from barloom.sources.listings import forex, indices
from barloom.sources.tables import Catalog

T0, T1 = datetime(2024, 1, 1, 9), datetime(2024, 1, 2, 9)


@pytest.fixture
def catalog(spark, tmp_path):
    return Catalog(spark, str(tmp_path / "metadata"))


def test_upsert_keeps_creation_and_updates_the_rest(spark, catalog):
    catalog.upsert_assets(forex(spark), T0)
    renamed = forex(spark).where("symbol = 'USDINR'").selectExpr("* except (name)", "'new' as name")
    catalog.upsert_assets(renamed.unionByName(indices(spark)), T1)
    rows = {r.symbol: r for r in catalog.assets().collect()}
    assert len(rows) == 8 + 29
    assert (rows["USDINR"].name, rows["USDINR"].created_at, rows["USDINR"].updated_at) == (
        "new", T0, T1)
    assert (rows["EURINR"].created_at, rows["EURINR"].updated_at) == (T0, T0)
    assert (rows["SENSEX"].created_at, rows["SENSEX"].updated_at) == (T1, T1)


def test_the_last_listing_of_a_symbol_wins(spark, catalog):
    listed = spark.createDataFrame(
        [("A", "old", 1), ("A", "new", 3), ("A", "mid", 2)], "symbol string, name string, o int")
    from barloom.operators.universe import complete_universe

    full = complete_universe(listed).join(listed, ["symbol", "name"])
    catalog.upsert_assets(full, T0, order="o")
    assert [r.name for r in catalog.assets().collect()] == ["new"]


def test_lookup_order_and_counts(spark, catalog):
    catalog.upsert_assets(forex(spark).unionByName(indices(spark)), T0)
    symbols = [r.symbol for r in ops.all_assets(catalog.assets()).collect()]
    assert symbols == sorted(symbols)
    assert ops.get_asset(catalog.assets(), "SENSEX").count() == 1
    assert ops.get_asset(catalog.assets(), "absent").count() == 0
    assert ops.count_assets(catalog.assets()).first()[0] == 37
    counts = [tuple(r) for r in ops.asset_type_counts(catalog.assets()).collect()]
    assert counts == [("FOREX", 8), ("INDEX", 29), ("TOTAL", 37)]


def downloads(spark, *rows):
    return spark.createDataFrame(
        list(rows), "symbol string, rows_downloaded bigint, status string, error_message string")


def test_download_log_and_status(spark, catalog):
    catalog.upsert_assets(forex(spark), T0)
    catalog.log_downloads(downloads(spark, ("USDINR", 5, "success", ""),
                                    ("EURINR", 0, "error", "429")), "run1", T0)
    catalog.log_downloads(downloads(spark, ("USDINR", 0, "skipped", "")), "run2", T1)
    history = ops.download_history(catalog.download_log(), "USDINR").collect()
    assert [(r.run_id, r.download_time) for r in history] == [("run2", T1), ("run1", T0)]
    # The bound is strict: T0 is exactly 24 hours before T1.
    summary = catalog.status_summary(T1).first().asDict()
    assert summary == {"total_assets": 8, "asset_type_counts": {"FOREX": 8},
                       "recent_downloads_24h": 1, "total_failed_downloads": 1}
    assert catalog.status_summary(datetime(2024, 1, 2, 8)).first().recent_downloads_24h == 3


def test_status_of_an_empty_catalog(catalog):
    assert catalog.status_summary(T0).first().asDict() == {
        "total_assets": 0, "asset_type_counts": {}, "recent_downloads_24h": 0,
        "total_failed_downloads": 0}
    assert catalog.download_log().count() == catalog.validation_log().count() == 0
    with pytest.raises(FileNotFoundError):
        catalog.universe()


def test_log_rows_need_a_known_asset(spark, catalog):
    catalog.upsert_assets(forex(spark), T0)
    with pytest.raises(ValueError, match="unknown assets, such as TCS"):
        catalog.log_downloads(downloads(spark, ("TCS", 5, "success", "")), "run", T0)
    assert catalog.download_log().count() == 0
    assert ops.orphan_log_rows(downloads(spark, ("TCS", 5, "success", "")),
                               catalog.assets()).count() == 1


def test_query_with_parameters(spark, catalog):
    catalog.upsert_assets(forex(spark).unionByName(indices(spark)), T0)
    rows = catalog.query(
        "select symbol from assets where asset_type = ? and name like ?", ["INDEX", "%Bank%"]
    ).collect()
    assert {r.symbol for r in rows} == {"NIFTY BANK", "NIFTY PSU BANK", "NIFTY PVT BANK"}
    assert catalog.query("select count(*) from download_log").first()[0] == 0


def test_universe_file(spark, catalog):
    catalog.write_universe(forex(spark))
    catalog.write_universe(indices(spark))
    assert catalog.universe().count() == 29
    row = catalog.universe().where("symbol = 'NIFTY 50'").first()
    assert (row.storage_key, row.asset_type) == ("NIFTY_50", "INDEX")


def test_report(spark, catalog, bad_bars, assets):
    report = validation_report(assets, bad_bars, Settings(as_of=date(2024, 6, 30)))
    rows = {(r.symbol, r.check_name): r for r in report.collect()}
    assert len(rows) == 7
    none = rows["NIFTY 50", "data_exists"]
    assert (none.status, none.total_rows, none.message) == (
        "SKIPPED", 0, "No data available for validation")
    assert rows["RELIANCE", "duplicates"].total_rows == 5

    lines = {r.symbol: r for r in report_summary(report).collect()}
    assert lines["RELIANCE"].summary == "RELIANCE: 3 passed, 0 warnings, 3 failed"
    assert (lines["RELIANCE"].verdict, lines["NIFTY 50"].verdict) == ("FAIL", "PASS")
    assert tuple(batch_summary(report).first()) == (2, 1)

    assert catalog.write_report(report, T0)
    assert catalog.report().columns == report_rows(report, T0).columns
    assert {r.validated_at for r in catalog.report().collect()} == {"2024-01-01T09:00:00"}
    assert not catalog.write_report(report.where("false"), T1)
    assert catalog.report().count() == 7

    assert validation_log_rows(report).where("symbol = 'NIFTY 50'").count() == 0


def test_validation_history_is_newest_first(spark, catalog):
    catalog.upsert_assets(forex(spark), T0)
    rows = spark.createDataFrame(
        [("USDINR", "duplicates", "FAILED", "m")],
        "symbol string, check_name string, status string, details string")
    catalog.log_validation(rows, "run1", T0)
    catalog.log_validation(rows.selectExpr("* except (status)", "'PASSED' as status"), "run2", T1)
    history = ops.validation_history(catalog.validation_log(), "USDINR").collect()
    assert [r.status for r in history] == ["PASSED", "FAILED"]


@pytest.mark.parametrize("command", [
    "drop view kept", "create table made (a int) using parquet", "insert into kept values (1)",
    "with c as (select 1) insert into kept select * from c", "set spark.sql.ansi.enabled = false",
    "select 1; drop view kept", "cache table kept", "",
])
def test_commands_are_refused_and_change_nothing(spark, command):
    spark.range(3).createOrReplaceTempView("kept")
    before = spark.conf.get("spark.sql.ansi.enabled")
    with pytest.raises(ValueError, match="only reads"):
        query(spark, {"assets": spark.range(1)}, command)
    assert spark.table("kept").count() == 3 and not spark.catalog.tableExists("made")
    assert spark.conf.get("spark.sql.ansi.enabled") == before
    assert "assets" not in {t.name for t in spark.catalog.listTables()}


def test_queries_of_every_form(spark):
    tables = {"t": spark.createDataFrame([(2, "b"), (1, "a"), (3, None)], "n int, s string")}
    assert [tuple(r) for r in query(spark, tables, "select n, n from t order by n desc;").collect()] == [
        (3, 3), (2, 2), (1, 1)]
    assert query(spark, tables, "with x as (table t) select max(n) as m from x -- the end").first()[0] == 3
    assert query(spark, tables, "select s from t where n = :n", {"n": 1}).first()[0] == "a"
    assert query(spark, tables, "select s from t where n = ?", [2]).first()[0] == "b"
    assert query(spark, tables, "values (1), (2)").count() == 2



def test_a_run_tried_again_is_logged_once(spark, tmp_path):
    log = Catalog(spark, str(tmp_path / "metadata"))
    listed = spark.createDataFrame([("A", "EQUITY"), ("B", "EQUITY")], "symbol string, asset_type string")
    log.write_universe(listed)
    log.upsert_assets(log.universe().drop("storage_key"), T0)
    # One asset is listed twice, so its row is there twice, at every try.
    rows = spark.createDataFrame([("A", 1), ("B", 2), ("B", 2)], "symbol string, rows_downloaded bigint")
    log.log_downloads(rows.where("symbol = 'A'"), "r1", T0)
    for run in ("r1", "r1", "r2"):
        log.log_downloads(rows, run, T0)
    found = sorted((r.run_id, r.symbol) for r in log.download_log().collect())
    assert found == [(r, s) for r in ("r1", "r2") for s in ("A", "B", "B")]
    checks = spark.createDataFrame(
        [("A", "gaps", "PASSED", ""), ("A", "range", "PASSED", "")],
        "symbol string, check_name string, status string, details string")
    for part in (checks.where("check_name = 'gaps'"), checks, checks):
        log.log_validation(part, "r1", T0)
    assert sorted(r.check_name for r in log.validation_log().collect()) == ["gaps", "range"]
