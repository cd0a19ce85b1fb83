"""The registered queries: every operator over the given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.functions import naming, outcomes
from barloom.operators import (
    catalog,
    checks,
    ingest,
    merge,
    normalize,
    profile,
    repair,
    report,
    select,
    summary,
    universe,
)
from barloom.plans.sync import Site, run_clean, run_ingest, run_validate
from barloom.session import shared_folder
from barloom.sources import footers, layout, snapshot
from barloom.sources.class_years import ClassYears
from barloom.sources.landing import read_landed
from barloom.sources.listings import nse_equities
from barloom.sources.snapshot import export_snapshot, import_snapshot, sync_status
from barloom.sources.store import BarStore
from barloom.sources.tables import Catalog
from barloom.streaming.ingest import start_ingest
from barloom.streaming.status import newest_panes, start_status
from barloom.streaming.status import status_by_hour as rolling_status
from barloom.streaming.validation import CHECKED, start_validation, summaries
from workload.views import view

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Clock-dependent operators run as of fixed moments.
AS_OF = date(2024, 1, 25)
HISTORY_AS_OF = date(2001, 1, 1)
NOW = datetime(2024, 1, 30, 12, 0)
SPLIT_OLD, SPLIT_NEW = date(2024, 1, 20), date(2024, 1, 15)


def register(query: Query) -> Query:
    QUERIES[query.__name__] = query
    return query


def work_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/barloom/{name}-{uuid.uuid4().hex}"


def old_and_new(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """raw_bars as a stored part and an arriving part that overlap by five days.

    ETFs arrive for the first time, commodities get no new bars; arriving opens differ.
    """
    bars = view(spark, sf, "raw_bars")
    is_etf, is_commodity = F.col("asset_type") == "ETF", F.col("asset_type") == "COMMODITY"
    old = bars.where(((F.col("date") < F.lit(SPLIT_OLD)) & ~is_etf) | is_commodity)
    new = bars.where(((F.col("date") >= F.lit(SPLIT_NEW)) & ~is_commodity) | is_etf)
    return old, new.withColumn("open", F.col("open") * 2)


def stored(spark: SparkSession, sf: str, name: str, *batches: DataFrame) -> BarStore:
    store = BarStore(spark, work_folder(spark, name))
    for batch in batches or (view(spark, sf, "raw_bars"),):
        store.save(batch)
    return store


def settings(as_of: date = AS_OF, max_gap_days: int = checks.DEFAULT_MAX_GAP_DAYS) -> checks.Settings:
    return checks.Settings(as_of=as_of, max_gap_days=max_gap_days)


def flat(results: DataFrame, *details: str) -> DataFrame:
    """Check results with the named details as columns instead of a map."""
    named = {f"detail_{d}": F.try_element_at("details", F.lit(d)) for d in details}
    return results.withColumns(named).drop("details") if named else results.drop("details")


# -- scans -------------------------------------------------------------------------------------

@register
def scan_bars(spark: SparkSession, sf: str) -> DataFrame:
    return stored(spark, sf, "scan_bars").load()


@register
def scan_date_range(spark: SparkSession, sf: str) -> DataFrame:
    return stored(spark, sf, "scan_date_range").load(date(2024, 1, 10), date(2024, 1, 20))


@register
def scan_asset_range(spark: SparkSession, sf: str) -> DataFrame:
    """Bars of two assets in two weeks, out of all bars in Z-order of asset and day."""
    folder = f"{work_folder(spark, 'scan_asset_range')}/bars"
    layout.write_interleaved(view(spark, sf, "raw_bars"), folder)
    return layout.scan_asset_range(
        spark, folder, ["8", "15"], date(2024, 1, 8), date(2024, 1, 21), "EQUITY")


@register
def scan_universe(spark: SparkSession, sf: str) -> DataFrame:
    return universe.complete_universe(
        view(spark, sf, "universe").select("symbol", "name", "asset_type")
    )


@register
def parse_listing(spark: SparkSession, sf: str) -> DataFrame:
    return universe.parse_listing(view(spark, sf, "listing_text"))


@register
def listing_from_file(spark: SparkSession, sf: str) -> DataFrame:
    """The listing as CSV files, read in place of the seed list."""
    folder = work_folder(spark, "listing_from_file")
    spaces = {f"ignore{side}WhiteSpace": False for side in ("Leading", "Trailing")}
    view(spark, sf, "listing_text").write.options(header=True, escape='"', **spaces).csv(folder)
    return nse_equities(spark, folder)


@register
def universe_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Saved, and saved again with other names: the newest one counts."""
    site = Catalog(spark, work_folder(spark, "universe_roundtrip"))
    assets = view(spark, sf, "universe").drop("storage_key")
    site.write_universe(assets.withColumn("name", F.lit("old")))
    site.write_universe(assets)
    return site.universe()


@register
def report_file(spark: SparkSession, sf: str) -> DataFrame:
    """A saved report; one without rows leaves it as it was."""
    site = Catalog(spark, work_folder(spark, "report_file"))
    found = _raw_report(spark, sf)
    site.write_report(found, NOW)
    site.write_report(found.limit(0), NOW)
    return site.report()


@register
def seed_index_exchange(spark: SparkSession, sf: str) -> DataFrame:
    names = view(spark, sf, "odd_symbols")
    return names.select("id", "name", universe.index_exchange(F.col("name")).alias("exchange"))


@register
def snapshot_subset(spark: SparkSession, sf: str) -> DataFrame:
    folder = work_folder(spark, "snapshot_subset")
    export_snapshot(view(spark, sf, "raw_bars"), view(spark, sf, "universe"), folder)
    return import_snapshot(spark, folder, ["index", "FOREX"])


# -- writes ------------------------------------------------------------------------------------

@register
def upsert_keep_last(spark: SparkSession, sf: str) -> DataFrame:
    return merge.upsert_bars(*old_and_new(spark, sf))


@register
def upsert_dedupe_first_load(spark: SparkSession, sf: str) -> DataFrame:
    return merge.upsert_bars(*old_and_new(spark, sf), dedupe_first_load=True)


@register
def store_upsert(spark: SparkSession, sf: str) -> DataFrame:
    return stored(spark, sf, "store_upsert", *old_and_new(spark, sf)).load()


@register
def store_delete(spark: SparkSession, sf: str) -> DataFrame:
    store = stored(spark, sf, "store_delete")
    store.delete(universe.with_asset_key(view(spark, sf, "supplier_assets")))
    return store.load()


@register
def store_clean(spark: SparkSession, sf: str) -> DataFrame:
    store = stored(spark, sf, "store_clean")
    store.clean()
    return store.load()


@register
def stream_ingest(spark: SparkSession, sf: str) -> DataFrame:
    return streamed(spark, "stream_ingest", *old_and_new(spark, sf)).load()


def streamed(spark: SparkSession, name: str, *parts: DataFrame) -> BarStore:
    """A store that took each part from landed files, one run of the stream after the other."""
    folder, stream = work_folder(spark, name), f"landing-{uuid.uuid4().hex}"
    store = BarStore(spark, f"{folder}/store")
    for part in parts:
        landed = part.drop("storage_key").withColumnRenamed("adj_close", "Adj Close")
        landed.write.mode("append").parquet(f"{folder}/landing")
        start_ingest(
            spark, f"{folder}/landing", store, f"{folder}/checkpoint", name=stream,
        ).awaitTermination()
    return store


@register
def ingest_new_files(spark: SparkSession, sf: str) -> DataFrame:
    """Two batch runs over one landing folder: the second reads only the files that came since."""
    folder = work_folder(spark, "ingest_new_files")
    site = Site.at(spark, f"{folder}/site", datetime(2024, 1, 31, 12))
    assets = view(spark, sf, "universe")
    site.catalog.write_universe(assets)
    site.catalog.upsert_assets(assets.withColumn("listed", F.lit(0)), NOW, order="listed")
    for part in old_and_new(spark, sf):
        landed = part.drop("storage_key").withColumnRenamed("adj_close", "Adj Close")
        landed.write.mode("append").parquet(f"{folder}/landing")
        run_ingest(site, f"{folder}/landing")
    return site.store.load()


@register
def runs_replay(spark: SparkSession, sf: str) -> DataFrame:
    """The log of a validation and a clean that were each run twice under one id."""
    folder = work_folder(spark, "runs_replay")
    site = Site.at(spark, folder, datetime(2024, 1, 25, 12))
    assets = view(spark, sf, "universe")
    site.catalog.write_universe(assets)
    site.catalog.upsert_assets(assets.withColumn("listed", F.lit(0)), NOW, order="listed")
    site.store.save(view(spark, sf, "raw_bars"))
    for _ in range(2):
        run_validate(site, run_id="first")
        run_clean(site, run_id="first")
    return site.catalog.validation_log().select(
        "run_id", "symbol", "check_name", "status", "details")


@register
def stream_validation(spark: SparkSession, sf: str) -> DataFrame:
    """The report on all bars that landed, from summaries that a stream kept over two landings."""
    folder = work_folder(spark, "stream_validation")
    table = summaries(spark, f"{folder}/summaries")
    for part in old_and_new(spark, sf):
        landed = part.drop("storage_key").withColumnRenamed("adj_close", "Adj Close")
        landed.write.mode("append").parquet(f"{folder}/landing")
        start_validation(
            spark, f"{folder}/landing", table, f"{folder}/checkpoint",
            name=f"validation-{uuid.uuid4().hex}",
        ).awaitTermination()
    verdicts = summary.summary_verdicts(
        view(spark, sf, "universe"), table.read(), settings(), columns=CHECKED)
    return report.report_of(verdicts).drop("details")


@register
def stream_absent_columns(spark: SparkSession, sf: str) -> DataFrame:
    bars = view(spark, sf, "raw_bars").drop("dividends")
    return streamed(spark, "stream_absent_columns", bars).load()


@register
def store_compact(spark: SparkSession, sf: str) -> DataFrame:
    store = stored(spark, sf, "store_compact", *old_and_new(spark, sf))
    store.compact()
    return store.load()


@register
def snapshot_scoped_sync(spark: SparkSession, sf: str) -> DataFrame:
    """One site exports all classes, another takes over, updates and exports one of them."""
    folder = work_folder(spark, "snapshot_scoped_sync")
    export_snapshot(view(spark, sf, "raw_bars"), view(spark, sf, "universe"), folder)
    store = BarStore(spark, work_folder(spark, "snapshot_scoped_site"))
    store.replace(import_snapshot(spark, folder, ["EQUITY"]))
    _, arriving = old_and_new(spark, sf)
    store.save(arriving.where("asset_type = 'EQUITY'"))
    export_snapshot(store.bars(), None, folder)
    return import_snapshot(spark, folder)


def _years_of_bars(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """history_bars as a snapshot has them, and as a site has them later: indices of 1995 with other
    closes, no ETF of 1990 any more, currencies of 1998 for the first time."""
    bars = view(spark, sf, "history_bars").selectExpr(
        "*", "cast(null as double) as adj_close",
        "cast(0 as double) as dividends", "cast(0 as double) as stock_splits",
        "volume as seq")
    before = bars.where("not (asset_type = 'FOREX' and year(date) = 1998)")
    after = bars.where("not (asset_type = 'ETF' and year(date) = 1990)").withColumn("close", F.expr(
        "if(asset_type = 'INDEX' and year(date) = 1995, close * 2, close)"))
    return before, after


@register
def snapshot_delta(spark: SparkSession, sf: str) -> DataFrame:
    folder = work_folder(spark, "snapshot_delta")
    before, after = _years_of_bars(spark, sf)
    export_snapshot(before, None, folder)
    return snapshot.snapshot_delta(after, folder)


@register
def snapshot_delta_import(spark: SparkSession, sf: str) -> DataFrame:
    """What a second export of the class-years that differ leaves to import."""
    folder = work_folder(spark, "snapshot_delta_import")
    for bars in _years_of_bars(spark, sf):
        export_snapshot(bars, None, folder)
    return import_snapshot(spark, folder)


@register
def landed_csv(spark: SparkSession, sf: str) -> DataFrame:
    """Vendor bars as CSV files with their columns in another order."""
    folder = work_folder(spark, "landed_csv")
    bars = view(spark, sf, "vendor_bars")
    bars.select(*(f"`{c}`" for c in reversed(bars.columns))).write.option("header", True).csv(folder)
    return normalize.coerce_types(normalize.normalize_bars(read_landed(spark, folder, "csv")))


@register
def coerce_types(spark: SparkSession, sf: str) -> DataFrame:
    return normalize.coerce_types(view(spark, sf, "text_bars"))


@register
def delete_assets(spark: SparkSession, sf: str) -> DataFrame:
    gone = universe.with_asset_key(view(spark, sf, "supplier_assets"))
    return merge.delete_assets(view(spark, sf, "raw_bars"), gone)


@register
def deletion_outcome(spark: SparkSession, sf: str) -> DataFrame:
    return merge.deletion_outcome(view(spark, sf, "raw_bars"), view(spark, sf, "universe"))


@register
def upsert_assets(spark: SparkSession, sf: str) -> DataFrame:
    updated = catalog.upsert_assets(
        view(spark, sf, "supplier_assets"), view(spark, sf, "order_assets"), NOW, order="listed"
    )
    stamps = {c: F.col(c).cast("timestamp_ntz") for c in ("created_at", "updated_at")}
    return updated.withColumns(stamps)


@register
def validation_log_rows(spark: SparkSession, sf: str) -> DataFrame:
    return report.validation_log_rows(_raw_report(spark, sf))


@register
def repair_log_rows(spark: SparkSession, sf: str) -> DataFrame:
    return repair.repair_log_rows(view(spark, sf, "raw_bars"), view(spark, sf, "universe"))


# -- projections and filters -------------------------------------------------------------------

@register
def log_replay(spark: SparkSession, sf: str) -> DataFrame:
    """A run that died when it had logged some symbols and was tried again, twice; then another run."""
    log = Catalog(spark, work_folder(spark, "log_replay"))
    log.upsert_assets(view(spark, sf, "universe"), NOW)
    rows = _download_log(spark, sf).join(
        view(spark, sf, "universe").select("symbol"), "symbol", "left_semi"
    ).groupBy("symbol").agg(
        F.sum("rows_downloaded").alias("rows_downloaded"), F.max("status").alias("status"))
    log.log_downloads(rows.where("cast(symbol as int) % 3 = 0"), "first", NOW)
    for run in ("first", "first", "second"):
        log.log_downloads(rows, run, NOW)
    return log.download_log().select("run_id", "symbol", "rows_downloaded", "status")


@register
def normalize_bars(spark: SparkSession, sf: str) -> DataFrame:
    return normalize.normalize_bars(view(spark, sf, "vendor_bars"))


@register
def filter_symbols(spark: SparkSession, sf: str) -> DataFrame:
    wanted = "nifty 50, GOLD ,usd/inr,^Small Ring=f,nothing"
    return select.filter_symbols(view(spark, sf, "odd_symbols"), wanted)


@register
def filter_asset_type(spark: SparkSession, sf: str) -> DataFrame:
    return select.filter_asset_type(view(spark, sf, "raw_bars"), "forex")


def _status() -> Column:
    return outcomes.download_status(F.col("rows_added"), F.col("error"), F.col("skipped"))


@register
def download_status(spark: SparkSession, sf: str) -> DataFrame:
    attempts = view(spark, sf, "download_results")
    return attempts.select(
        "id", _status().alias("status")
    )


@register
def download_log_rows(spark: SparkSession, sf: str) -> DataFrame:
    return ingest.download_log_rows(view(spark, sf, "download_results"))


@register
def throttle_errors(spark: SparkSession, sf: str) -> DataFrame:
    attempts = view(spark, sf, "download_results").withColumnRenamed("error", "error_message")
    return ingest.throttled(attempts).select("id", "error_message", "throttle")


@register
def storage_key(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "odd_symbols").select(
        "id", naming.storage_key().alias("storage_key"), naming.class_dir().alias("class"),
        naming.storage_path().alias("path"),
        naming.class_dir("concat(asset_type, 'S')").alias("unknown_class"),
    )


@register
def derive_ticker(spark: SparkSession, sf: str) -> DataFrame:
    return view(spark, sf, "odd_symbols").select(
        "id", "symbol", "asset_type", naming.vendor_ticker().alias("ticker")
    )


# -- joins -------------------------------------------------------------------------------------

@register
def assets_with_data(spark: SparkSession, sf: str) -> DataFrame:
    return select.assets_with_data(view(spark, sf, "universe"), view(spark, sf, "raw_bars"))


def _plan(spark: SparkSession, sf: str, bars: DataFrame, start: date | None = None) -> DataFrame:
    return ingest.resume_plan(view(spark, sf, "universe"), bars, date(2024, 1, 31), start)


@register
def resume_plan(spark: SparkSession, sf: str) -> DataFrame:
    return _plan(spark, sf, view(spark, sf, "raw_bars")).select(
        "symbol", "asset_type", "last_date", "start_date", "end_date", "skipped"
    )


@register
def resume_plan_from(spark: SparkSession, sf: str) -> DataFrame:
    return _plan(spark, sf, view(spark, sf, "raw_bars"), date(2024, 1, 3)).select(
        "symbol", "asset_type", "start_date", "end_date", "skipped"
    )


@register
def select_missing(spark: SparkSession, sf: str) -> DataFrame:
    old, _ = old_and_new(spark, sf)
    return ingest.select_missing(view(spark, sf, "raw_bars"), _plan(spark, sf, old))


@register
def ingest_results(spark: SparkSession, sf: str) -> DataFrame:
    old, _ = old_and_new(spark, sf)
    plan = _plan(spark, sf, old)
    fetched = ingest.select_missing(view(spark, sf, "raw_bars"), plan)
    return ingest.ingest_results(plan, fetched).drop("error")


@register
def orphan_log_rows(spark: SparkSession, sf: str) -> DataFrame:
    return catalog.orphan_log_rows(
        view(spark, sf, "validation_log"), view(spark, sf, "supplier_assets")
    )


# -- aggregations ------------------------------------------------------------------------------

@register
def last_dates(spark: SparkSession, sf: str) -> DataFrame:
    return profile.last_dates(view(spark, sf, "raw_bars"))


@register
def row_counts(spark: SparkSession, sf: str) -> DataFrame:
    counted = profile.row_counts(view(spark, sf, "universe"), view(spark, sf, "raw_bars"))
    return counted.select("symbol", "asset_type", "row_count")


@register
def store_last_dates(spark: SparkSession, sf: str) -> DataFrame:
    """From the store's index, after two saves."""
    return stored(spark, sf, "store_last_dates", *old_and_new(spark, sf)).last_dates()


@register
def store_row_counts(spark: SparkSession, sf: str) -> DataFrame:
    store = stored(spark, sf, "store_row_counts", *old_and_new(spark, sf))
    return store.row_counts(view(spark, sf, "universe")).select("symbol", "asset_type", "row_count")


@register
def class_row_counts(spark: SparkSession, sf: str) -> DataFrame:
    store = stored(spark, sf, "class_row_counts")
    return footers.class_row_counts(spark, f"{store.path}/bars")


@register
def class_last_dates(spark: SparkSession, sf: str) -> DataFrame:
    store = stored(spark, sf, "class_last_dates")
    return footers.class_last_dates(spark, f"{store.path}/bars")


@register
def class_counts(spark: SparkSession, sf: str) -> DataFrame:
    return profile.class_counts(view(spark, sf, "raw_bars"))


@register
def class_stats(spark: SparkSession, sf: str) -> DataFrame:
    return profile.class_stats(view(spark, sf, "class_sizes"), with_total=True)


@register
def coverage_table(spark: SparkSession, sf: str) -> DataFrame:
    return profile.coverage_table(profile.class_stats(view(spark, sf, "class_sizes")))


@register
def file_sizes(spark: SparkSession, sf: str) -> DataFrame:
    """Which classes have files with contents, of a store that holds no ETFs; sizes are Spark's own."""
    bars = view(spark, sf, "raw_bars").where("asset_type <> 'ETF'")
    stats = stored(spark, sf, "file_sizes", bars).class_stats(
        with_empty_classes=True, with_total=True)
    return stats.select(
        "class", (F.col("files") > 0).alias("has_files"), (F.col("size_bytes") > 0).alias("has_bytes"))


@register
def ingest_log_sizes(spark: SparkSession, sf: str) -> DataFrame:
    """The download log of a run: its assets' shares of the files add up to the files, by class."""
    folder = work_folder(spark, "ingest_log_sizes")
    site = Site.at(spark, f"{folder}/site", datetime(2024, 1, 31, 12))
    assets = view(spark, sf, "universe")
    site.catalog.write_universe(assets)
    site.catalog.upsert_assets(assets.withColumn("listed", F.lit(0)), NOW, order="listed")
    landed = view(spark, sf, "raw_bars").drop("storage_key").withColumnRenamed("adj_close", "Adj Close")
    landed.write.parquet(f"{folder}/landing")
    run_ingest(site, f"{folder}/landing")
    logged = site.catalog.download_log().join(assets.select("symbol", "asset_type"), "symbol").groupBy(
        "asset_type").agg(
        F.count_if(F.col("rows_downloaded") > 0).alias("assets"),
        F.sum("rows_downloaded").alias("rows_downloaded"),
        F.sum("file_size_bytes").alias("logged"))
    held = site.store.live_files().groupBy("asset_type").agg(F.sum("size_bytes").alias("held"))
    # A share is rounded to a byte.
    return logged.join(held, "asset_type").select(
        "asset_type", "assets", "rows_downloaded",
        (F.abs(F.col("logged") - F.col("held")) <= F.col("assets")).alias("sizes_add_up"))


@register
def sync_document(spark: SparkSession, sf: str) -> DataFrame:
    stats = profile.class_stats(view(spark, sf, "class_sizes"))
    return sync_status(stats, "someone/bars", NOW)


@register
def asset_type_counts(spark: SparkSession, sf: str) -> DataFrame:
    return catalog.asset_type_counts(view(spark, sf, "universe"))


@register
def count_assets(spark: SparkSession, sf: str) -> DataFrame:
    return catalog.count_assets(view(spark, sf, "universe"))


def _download_log(spark: SparkSession, sf: str) -> DataFrame:
    attempts = view(spark, sf, "download_results")
    return attempts.select(
        "id", "symbol", "download_time", F.col("rows_added").alias("rows_downloaded"),
        _status().alias("status"), F.coalesce("error", F.lit("")).alias("error_message"),
    )


@register
def status_summary(spark: SparkSession, sf: str) -> DataFrame:
    summary = catalog.status_summary(view(spark, sf, "universe"), _download_log(spark, sf), NOW)
    classes = {
        f"n_{c.lower()}": F.try_element_at("asset_type_counts", F.lit(c))
        for c in ("EQUITY", "INDEX", "ETF", "COMMODITY", "FOREX")
    }
    return summary.withColumns(classes).drop("asset_type_counts")


@register
def status_by_hour(spark: SparkSession, sf: str) -> DataFrame:
    """The log lands in two parts; the second brings a tenth of the older rows late."""
    folder = work_folder(spark, "status_by_hour")
    log = _download_log(spark, sf)
    first = (F.col("download_time") < F.lit(datetime(2024, 1, 20))) & (F.col("id") % 10 != 0)
    for part in (log.where(first), log.where(~first)):
        part.write.mode("append").parquet(f"{folder}/log")
        start_status(
            spark, f"{folder}/log", log.schema, f"{folder}/panes", f"{folder}/checkpoint",
            name=f"status-{uuid.uuid4().hex}",
        ).awaitTermination()
    return rolling_status(newest_panes(spark, f"{folder}/panes"))


def _raw_report(spark: SparkSession, sf: str) -> DataFrame:
    return report.validation_report(
        view(spark, sf, "universe"), view(spark, sf, "raw_bars"), settings()
    )


@register
def validation_report(spark: SparkSession, sf: str) -> DataFrame:
    return _raw_report(spark, sf).drop("details")


@register
def validation_report_history(spark: SparkSession, sf: str) -> DataFrame:
    return report.validation_report(
        view(spark, sf, "universe"), view(spark, sf, "history_bars"), settings(HISTORY_AS_OF)
    ).drop("details")


@register
def validation_report_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """The years up to 1995 are summarised first; later ones are added without reading them again."""
    bars = summary.with_year(view(spark, sf, "history_bars"))
    kept = ClassYears(
        spark, work_folder(spark, "validation_report_incremental"), summary.summarise(bars).schema)
    for years in ("bar_year < 1996", "bar_year >= 1996"):
        kept.replace(summary.summarise(bars.where(years)))
    verdicts = summary.summary_verdicts(
        view(spark, sf, "universe"), kept.read(), settings(HISTORY_AS_OF), columns=bars.columns)
    return report.report_of(verdicts).drop("details")


@register
def report_summary(spark: SparkSession, sf: str) -> DataFrame:
    return report.report_summary(_verdicts(spark, sf, view(spark, sf, "universe")))


def _verdicts(spark: SparkSession, sf: str, assets: DataFrame) -> DataFrame:
    return report.asset_verdicts(assets, view(spark, sf, "raw_bars"), settings())


def _listed_twice(spark: SparkSession, sf: str) -> DataFrame:
    """A universe of two exchanges: every supplier's symbol is a customer's as well."""
    columns = ["symbol", "asset_type", "storage_key"]
    other = universe.with_asset_key(view(spark, sf, "supplier_assets"))
    return view(spark, sf, "universe").select(columns).unionAll(other.select(columns))


@register
def report_summary_listed_twice(spark: SparkSession, sf: str) -> DataFrame:
    return report.report_summary(_verdicts(spark, sf, _listed_twice(spark, sf)))


@register
def batch_summary_listed_twice(spark: SparkSession, sf: str) -> DataFrame:
    """From the report, which has every check of such an asset twice."""
    rows = report.report_of(_verdicts(spark, sf, _listed_twice(spark, sf)))
    return report.batch_summary(rows)


@register
def repair_log_listed_twice(spark: SparkSession, sf: str) -> DataFrame:
    return repair.repair_log_rows(view(spark, sf, "raw_bars"), _listed_twice(spark, sf))


#: Symbols a user asks for.
SCOPE = "1,2,3,5,8,13,21,34"


@register
def validation_report_scoped(spark: SparkSession, sf: str) -> DataFrame:
    site_bars = stored(spark, sf, "validation_report_scoped")
    wanted = select.filter_symbols(view(spark, sf, "universe"), SCOPE)
    bars = site_bars.load(storage_keys=SCOPE.split(","))
    return report.validation_report(wanted, bars, settings()).drop("details")


@register
def batch_summary(spark: SparkSession, sf: str) -> DataFrame:
    return report.batch_summary(_verdicts(spark, sf, view(spark, sf, "universe")))


@register
def ingest_summary(spark: SparkSession, sf: str) -> DataFrame:
    return ingest.ingest_summary(view(spark, sf, "download_results"))


@register
def repair_summary(spark: SparkSession, sf: str) -> DataFrame:
    return repair.repair_summary(view(spark, sf, "raw_bars"))


@register
def repaired_counts(spark: SparkSession, sf: str) -> DataFrame:
    return repair.repaired_counts(view(spark, sf, "raw_bars"))


# -- windows -----------------------------------------------------------------------------------

@register
def dedupe_keep_last(spark: SparkSession, sf: str) -> DataFrame:
    return merge.dedupe_bars(view(spark, sf, "raw_bars"))


@register
def duplicate_rows(spark: SparkSession, sf: str) -> DataFrame:
    return checks.duplicate_rows(view(spark, sf, "raw_bars"))


@register
def date_gaps(spark: SparkSession, sf: str) -> DataFrame:
    return checks.date_gaps(view(spark, sf, "history_bars"))


# -- ordered listings and unions ---------------------------------------------------------------

@register
def all_assets(spark: SparkSession, sf: str) -> DataFrame:
    return catalog.all_assets(view(spark, sf, "universe"))


@register
def all_assets_ranked(spark: SparkSession, sf: str) -> DataFrame:
    return catalog.all_assets_ranked(view(spark, sf, "universe"))


@register
def stored_assets_ranked(spark: SparkSession, sf: str) -> DataFrame:
    return profile.stored_assets_ranked(view(spark, sf, "raw_bars"))


@register
def download_history_ranked(spark: SparkSession, sf: str) -> DataFrame:
    return catalog.history_ranked(_download_log(spark, sf), "download_time", "id")


@register
def asset_lookup(spark: SparkSession, sf: str) -> DataFrame:
    return catalog.get_asset(view(spark, sf, "universe"), "7")


@register
def download_history_of(spark: SparkSession, sf: str) -> DataFrame:
    return catalog.download_history(_download_log(spark, sf), "7")


@register
def download_history(spark: SparkSession, sf: str) -> DataFrame:
    return catalog.download_history(_download_log(spark, sf))


@register
def validation_history(spark: SparkSession, sf: str) -> DataFrame:
    return catalog.validation_history(view(spark, sf, "validation_log"))


@register
def stored_assets(spark: SparkSession, sf: str) -> DataFrame:
    return profile.stored_assets(view(spark, sf, "raw_bars"))


@register
def build_universe(spark: SparkSession, sf: str) -> DataFrame:
    return universe.build_universe([
        universe.parse_listing(view(spark, sf, "listing_text")),
        view(spark, sf, "universe"),
        view(spark, sf, "supplier_assets"),
        view(spark, sf, "odd_symbols"),
    ])


# -- checks ------------------------------------------------------------------------------------

def _check(spark: SparkSession, sf: str, bars: str, check: checks.Check, as_of: date = AS_OF):
    return checks.run_checks(view(spark, sf, bars), settings(as_of), [check])


@register
def check_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    return flat(_check(spark, sf, "raw_bars", checks.DUPLICATES))


@register
def check_gaps(spark: SparkSession, sf: str) -> DataFrame:
    results = _check(spark, sf, "history_bars", checks.MISSING_TRADING_DAYS)
    return flat(results, "max_gap_days", "gap_count")


@register
def check_gaps_wide(spark: SparkSession, sf: str) -> DataFrame:
    results = checks.run_checks(
        view(spark, sf, "history_bars"), settings(max_gap_days=12), [checks.MISSING_TRADING_DAYS]
    )
    return flat(results, "max_gap_days", "gap_count")


@register
def check_ohlc(spark: SparkSession, sf: str) -> DataFrame:
    results = _check(spark, sf, "raw_bars", checks.OHLC_CONSISTENCY)
    return flat(results, "high_lt_low", "open_out_of_range", "close_out_of_range")


@register
def check_volume(spark: SparkSession, sf: str) -> DataFrame:
    return flat(_check(spark, sf, "raw_bars", checks.NEGATIVE_VOLUME))


@register
def check_nulls(spark: SparkSession, sf: str) -> DataFrame:
    return flat(_check(spark, sf, "raw_bars", checks.NULL_VALUES), *checks.CRITICAL_COLUMNS)


@register
def check_range(spark: SparkSession, sf: str) -> DataFrame:
    return flat(_check(spark, sf, "history_bars", checks.DATA_RANGE, HISTORY_AS_OF))


@register
def check_price_outliers(spark: SparkSession, sf: str) -> DataFrame:
    """In one pass with the gap check; closes of some days are off by a factor of a hundred."""
    bars = view(spark, sf, "history_bars").withColumn("close", F.expr("""
        case when cast(symbol as int) % 5 = 0 and day(date) = 1 then close * 200
             when cast(symbol as int) % 5 in (0, 1) and day(date) = 2 then close / 1000
             else close end"""))
    results = checks.run_checks(
        bars, settings(), [checks.MISSING_TRADING_DAYS, checks.price_outliers(50)])
    return flat(results.where("check_name = 'price_outliers'"))


@register
def check_stale_prices(spark: SparkSession, sf: str) -> DataFrame:
    """Closes of a third of the assets take two values; summaries by year are merged first."""
    bars = view(spark, sf, "history_bars").withColumn("close", F.expr("""
        case when cast(symbol as int) % 3 = 0 then 100 + month(date) % 2 else close end"""))
    wanted = [checks.stale_prices()]
    found = summary.summarise(bars, wanted)
    merged = checks.merged_counts(found, aggregates=checks.aggregates_of(wanted, settings(), bars.columns))
    counted = checks.count_by_asset_of(merged, settings(), wanted, bars.columns)
    outcomes = checks.verdicts_sql(wanted, settings(), bars.columns)
    return flat(counted.selectExpr(*checks.ASSET_KEY, f"inline({outcomes})"), "distinct_closes")


@register
def checks_without_columns(spark: SparkSession, sf: str) -> DataFrame:
    bars = view(spark, sf, "raw_bars").drop("high", "low", "volume", "date")
    return flat(checks.run_checks(bars, settings()))


@register
def checks_without_bars(spark: SparkSession, sf: str) -> DataFrame:
    return flat(checks.run_checks(
        view(spark, sf, "raw_bars"), settings(), [checks.DUPLICATES, checks.OHLC_CONSISTENCY],
        assets=view(spark, sf, "universe"),
    ))


# -- repair ------------------------------------------------------------------------------------

@register
def repair_ohlc(spark: SparkSession, sf: str) -> DataFrame:
    return repair.repair_ohlc(view(spark, sf, "raw_bars"))


@register
def repair_assets(spark: SparkSession, sf: str) -> DataFrame:
    return repair.repair_assets(view(spark, sf, "raw_bars"))


# -- SQL ---------------------------------------------------------------------------------------

PARAM_SQL = """
    select a.asset_type, l.status, count(*) as n, sum(l.rows_downloaded) as row_total
    from download_log l join assets a on l.symbol = a.symbol
    where l.rows_downloaded >= ? and a.exchange <> ?
    group by a.asset_type, l.status"""


@register
def param_query(spark: SparkSession, sf: str) -> DataFrame:
    tables = {"assets": view(spark, sf, "universe"), "download_log": _download_log(spark, sf)}
    return catalog.query(spark, tables, PARAM_SQL, [0, "BSE"])


NAMED_SQL = """
    with wanted as (select * from assets where exchange <> :exchange)
    select a.asset_type, l.status, count(*) as n, sum(l.rows_downloaded) as row_total
    from download_log l join wanted a on l.symbol = a.symbol
    where l.rows_downloaded >= :least
    group by a.asset_type, l.status;"""


@register
def param_query_named(spark: SparkSession, sf: str) -> DataFrame:
    tables = {"assets": view(spark, sf, "universe"), "download_log": _download_log(spark, sf)}
    return catalog.query(spark, tables, NAMED_SQL, {"least": 1, "exchange": "NSE"})
