"""The runs a user starts: discover, ingest, validate, clean, and all of them as one sync."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from datetime import date, datetime
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.operators.checks import Settings
from barloom.operators.ingest import (
    download_log_rows,
    ingest_results,
    ingest_summary,
    resume_plan,
    select_missing,
    with_file_sizes,
)
from barloom.operators.normalize import normalize_bars, with_storage_key
from barloom.operators.repair import repair_log
from barloom.operators.report import batch_summary, report_of, validation_log_rows
from barloom.operators.select import filter_asset_type, filter_symbols
from barloom.sources import files
from barloom.sources.landing import RAW_BAR_SCHEMA, read_landed
from barloom.sources.ledger import FileLedger, landed_files, paths_of, read_whole_by, scope_of
from barloom.sources.listings import discover
from barloom.sources.snapshot import (
    export_snapshot,
    import_snapshot,
    import_universe,
    sync_status,
    unlike_fingerprints,
    write_sync_status,
)
from barloom.sources.store import BarStore
from barloom.sources.tables import Catalog
from barloom.work import no_rows, written


@dataclass(frozen=True)
class Site:
    """A store and its catalog, and the moment a run counts as "now"."""

    spark: SparkSession
    store: BarStore
    catalog: Catalog
    now: datetime

    @classmethod
    def at(cls, spark: SparkSession, path: str, now: datetime | None = None) -> Site:
        return cls(
            spark, BarStore(spark, f"{path}/data"), Catalog(spark, f"{path}/metadata"),
            now or datetime.now(),
        )


def run_discover(site: Site, listing_path: str | None = None) -> DataFrame:
    """Saves the universe, updates the catalog, returns the universe."""
    listed = discover(site.spark, listing_path, order="_listed")
    site.catalog.write_universe(listed.drop("_listed"))
    # The universe keeps a symbol listed twice; the catalog keeps its last listing.
    site.catalog.upsert_assets(listed, site.now, order="_listed")
    return site.catalog.universe()


def run_ingest(
    site: Site, landing: str, fmt: str = "parquet", symbols: str | None = None,
    asset_type: str | None = None, start: date | None = None, end: date | None = None,
    run_id: str | None = None,
) -> DataFrame:
    """Takes from the landed files what the selected assets still miss; returns the summary.

    A run for all assets, resuming where they are, reads only files that no such run has taken; see
    `FileLedger`. Other runs read the whole folder. A run that was given an id and died may be started
    again with it: it goes on from what it had fetched, and stores and logs nothing twice.
    """
    spark, named = site.spark, run_id is not None
    run_id = run_id or uuid.uuid4().hex
    whole = symbols is None and asset_type is None and start is None
    ledger = FileLedger(spark, f"{site.catalog.path}/taken_files")
    wanted = filter_asset_type(filter_symbols(site.catalog.universe(), symbols), asset_type)
    until = end or site.now.date()

    # The plan and the chosen rows are needed after the store has changed: fix them first.
    work = f"{site.catalog.path}/runs/{quote(run_id, '')}"
    if not files.exists(spark, f"{work}/fetched"):
        scope = scope_of(wanted) if whole else ""
        arrived = landed_files(spark, landing)
        if whole:
            arrived = ledger.not_taken(arrived, scope)
        paths = paths_of(arrived)
        raw = read_landed(spark, paths, fmt) if paths else no_rows(spark, RAW_BAR_SCHEMA)
        known = site.store.last_dates().withColumnRenamed("last_date", "date")
        plan = resume_plan(wanted, known, until, start)
        plan.write.mode("overwrite").parquet(f"{work}/plan")
        plan = spark.read.parquet(f"{work}/plan")
        landed = with_storage_key(normalize_bars(raw))
        select_missing(landed, plan).write.mode("overwrite").parquet(f"{work}/rows")
        if whole and paths:
            done = read_whole_by(raw, arrived, until)
            done.write.mode("overwrite").parquet(f"{work}/taken")
        begun = {"at": site.now.isoformat(), "scope": scope, "files": bool(whole and paths)}
        files.create_text(spark, f"{work}/fetched", json.dumps(begun))
    begun = json.loads(files.read_text(spark, f"{work}/fetched"))
    plan, fetched = spark.read.parquet(f"{work}/plan"), spark.read.parquet(f"{work}/rows")

    mark = {"stream": f"run-{run_id}", "batch": 0} if named else {}
    touched = site.store.save(fetched, **mark) or site.store.pairs_of(fetched)
    results = with_file_sizes(ingest_results(plan, fetched), site.store.live_files(touched))
    results = written(results, "results")
    if begun["files"]:
        ledger.take(spark.read.parquet(f"{work}/taken"), begun["scope"], run_id)
    at = datetime.fromisoformat(begun["at"])
    site.catalog.log_downloads(download_log_rows(results), run_id, at)
    files.remove(spark, work)
    return ingest_summary(results)


def chosen_keys(wanted: DataFrame, symbols: str | None) -> set[str] | None:
    """The storage keys of the assets that a user listed by symbol, so there are few; else None."""
    if symbols is None:
        return None
    return {r["storage_key"] for r in wanted.select("storage_key").distinct().collect()}


def _fixed(
    site: Site, run_id: str | None, kind: str, rows: Callable[[], DataFrame],
) -> tuple[DataFrame, datetime]:
    """What a run works on, and its time: those of its first try, if it was given an id."""
    if run_id is None:
        return written(rows(), kind), site.now
    spark, work = site.spark, _work(site, run_id, kind)
    if not files.exists(spark, f"{work}/begun"):
        rows().write.mode("overwrite").parquet(f"{work}/rows")
        files.create_text(spark, f"{work}/begun", site.now.isoformat())
    at = datetime.fromisoformat(files.read_text(spark, f"{work}/begun"))
    return written(spark.read.parquet(f"{work}/rows"), kind), at


def _work(site: Site, run_id: str, kind: str) -> str:
    return f"{site.catalog.path}/runs/{kind}-{quote(run_id, '')}"


def run_validate(
    site: Site, symbols: str | None = None, asset_type: str | None = None,
    save_report: bool = True, run_id: str | None = None,
) -> DataFrame:
    """Validates the selected assets that have bars, logs the results, returns the report.

    The stored summaries tell which assets have bars and how they fare; no bars are read. A run that
    was given an id and died may be started again with it: it logs the rest of what it had found.
    """
    def found() -> DataFrame:
        wanted = filter_asset_type(filter_symbols(site.catalog.universe(), symbols), asset_type)
        return report_of(site.store.verdicts(
            wanted, Settings(as_of=site.now.date()), asset_type, chosen_keys(wanted, symbols)
        ).where("total_rows > 0"))

    report, at = _fixed(site, run_id, "report", found)
    site.catalog.log_validation(validation_log_rows(report), run_id or uuid.uuid4().hex, at)
    if save_report:
        site.catalog.write_report(report, at)
    if run_id is not None:
        files.remove(site.spark, _work(site, run_id, "report"))
    return report


def run_clean(site: Site, symbols: str | None = None, run_id: str | None = None) -> DataFrame:
    """Repairs the selected universe assets, logs each repair, returns one summary row.

    A run that was given an id and died may be started again with it: it repairs the assets it had
    found and logs them once, as run `<id>/clean`, whether or not the bars had been repaired by
    then. Assets that became damaged meanwhile are for the next run.
    """
    wanted = filter_symbols(site.catalog.universe(), symbols)
    if run_id is None:
        repaired, at = site.store.clean(wanted), site.now
    else:
        repaired, at = _fixed(site, run_id, "repairs", lambda: site.store.repairs(wanted))
        site.store.clean(repaired)
    logged_as = uuid.uuid4().hex if run_id is None else f"{run_id}/clean"
    site.catalog.log_validation(repair_log(repaired, wanted), logged_as, at)
    if run_id is not None:
        files.remove(site.spark, _work(site, run_id, "repairs"))
    return repaired.agg(
        F.coalesce(F.sum("repaired_rows"), F.lit(0)).cast("bigint").alias("repaired_rows"),
        F.count(F.lit(1)).alias("repaired_assets"),
    )


def run_import(site: Site, path: str, asset_type: str | None = None) -> None:
    """Takes over a snapshot: its assets replace stored ones, its universe the saved one.

    The bars are first held against the snapshot's fingerprints. A run that dies leaves the old bars,
    or the next run finishes its work.
    """
    classes = [asset_type] if asset_type else None
    if unlike := unlike_fingerprints(site.spark, path, classes).collect():
        raise ValueError(f"snapshot {path} is incomplete or at work: {unlike[0]}")
    site.store.replace(import_snapshot(site.spark, path, classes))
    universe = import_universe(site.spark, path)
    if universe is not None:
        site.catalog.write_universe(universe)


def run_export(site: Site, path: str, repo_id: str) -> None:
    """Writes a snapshot of the bars and the universe with its status document."""
    export_snapshot(site.store.bars(), site.catalog.universe().drop("storage_key"), path)
    stats = site.store.class_stats()
    write_sync_status(sync_status(stats, repo_id, site.now), path)


def run_sync(
    site: Site, landing: str, snapshot: str | None = None, repo_id: str = "",
    listing_path: str | None = None, asset_type: str | None = None, fmt: str = "parquet",
    skip_discover: bool = False, skip_validate: bool = False,
) -> dict[str, DataFrame]:
    """Import the snapshot, discover, ingest, validate, export; without `snapshot` the first and
    last step are left out. Returns the summaries of the steps that ran."""
    done: dict[str, DataFrame] = {}
    if snapshot is not None:
        run_import(site, snapshot, asset_type)
    if not skip_discover:
        run_discover(site, listing_path)
    done["ingest"] = run_ingest(site, landing, fmt, asset_type=asset_type)
    if not skip_validate:
        report = run_validate(site, asset_type=asset_type, save_report=False)
        done["validate"] = batch_summary(report)
    if snapshot is not None:
        run_export(site, snapshot, repo_id)
    return done
