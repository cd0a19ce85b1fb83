"""The bar store: plain Parquet by asset class and year, and a summary of every class-year.

`bars/asset_type=/bar_year=` holds the bars, `summary/asset_type=/bar_year=` their mergeable
summaries (see `operators.summary`). A change writes the class-years it touches to a folder of its
own first; only when that is complete does it overwrite these class-years and their summaries, with
Spark's dynamic partition overwrite. A writer that dies before has changed nothing; if it dies
later, the next one finishes its work from that folder. Class-years that a change doesn't touch are
neither read nor written, and which ones it touches is known from the summaries, not from bars.

Bars are deduplicated keep-last by asset and date when an already stored asset receives bars.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterable
from datetime import date
from functools import cached_property, reduce
from urllib.parse import quote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.operators import profile
from barloom.operators.checks import Settings
from barloom.operators.merge import dedupe_assets, delete_assets
from barloom.operators.normalize import coerce_types, with_storage_key
from barloom.operators.repair import repair_ohlc
from barloom.operators.select import filter_dates
from barloom.operators.summary import (
    NO_YEAR,
    summarise,
    summary_assets,
    summary_verdicts,
    summary_years,
)
from barloom.schema import ASSET_KEY, BAR_SCHEMA, PARTITION_FIELDS, STORED_SCHEMA
from barloom.sources import files
from barloom.sources.class_years import PAIR, together
from barloom.work import no_rows, written

READ_SCHEMA = T.StructType(STORED_SCHEMA.fields + PARTITION_FIELDS)
FILE_ORDER = [*PAIR, "storage_key", "date"]
FILES_SCHEMA = T.StructType([
    T.StructField("asset_type", T.StringType()),
    T.StructField("file_path", T.StringType()),
    T.StructField("size_bytes", T.LongType()),
])

Pair = tuple[str, int]


class BarStore:
    """Bars of all assets under one folder.

    One writer at a time. Files of a class-year go when it is rewritten: what was read from it has
    to be read again.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark = spark
        self.path = path.rstrip("/")

    # -- reading -------------------------------------------------------------------------------

    def load(
        self, start: date | None = None, end: date | None = None,
        asset_type: str | None = None, storage_keys: Iterable[str] | None = None,
    ) -> DataFrame:
        """Stored bars with asset key and `seq`; bounds inclusive. An empty store gives no rows.

        Class and date bounds prune directories, storage keys and dates prune row groups.
        """
        bars = self._bars()
        if start is not None:
            bars = bars.where(F.col("bar_year") >= start.year)
        if end is not None:
            bars = bars.where(F.col("bar_year") <= end.year)
        if start is not None or end is not None:
            bars = bars.where(F.col("bar_year") != NO_YEAR)
        bars = filter_dates(scoped(bars, asset_type, storage_keys), start, end)
        return bars.select(*BAR_SCHEMA.fieldNames(), "seq", *ASSET_KEY)

    def bars(self) -> DataFrame:
        """All stored bars with `bar_year`, by which readers can prune directories."""
        return self._bars()

    def summary(
        self, asset_type: str | None = None, storage_keys: Iterable[str] | None = None,
    ) -> DataFrame:
        """The summaries of stored bars, a row per asset, year and span; no bars are read."""
        return scoped(self._table("summary", self._summary_schema), asset_type, storage_keys)

    @cached_property
    def _summary_schema(self) -> T.StructType:
        return summarise(no_rows(self.spark, READ_SCHEMA)).schema

    def verdicts(
        self, universe: DataFrame, settings: Settings, asset_type: str | None = None,
        storage_keys: Iterable[str] | None = None,
    ) -> DataFrame:
        """`asset_verdicts` of the stored bars of some assets or all, from the summaries."""
        return summary_verdicts(universe, self.summary(asset_type, storage_keys), settings)

    def exists(self, asset_type: str, storage_key: str) -> bool:
        return not self.summary(asset_type, [storage_key]).isEmpty()

    def assets(self) -> DataFrame:
        """One row per stored asset: asset key, last_date and row_count; reads no bars."""
        return summary_assets(self.summary())

    def last_dates(self) -> DataFrame:
        return self.assets().select(*ASSET_KEY, "last_date")

    def row_counts(self, universe: DataFrame) -> DataFrame:
        counted = self.assets().select(*ASSET_KEY, "row_count")
        return universe.join(counted, ASSET_KEY, "left").withColumn(
            "row_count", F.coalesce("row_count", F.lit(0).cast("bigint")))

    def stored_assets(self) -> DataFrame:
        return profile.stored_assets(self.assets())

    def live_files(self, pairs: Iterable[Pair] | None = None) -> DataFrame:
        """One row per data file: asset_type, file_path, size_bytes (contents not read).

        Of all class-years, or of some.
        """
        reader = self.spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
        try:
            found = reader.load(f"{self.path}/bars")
        except AnalysisException as failed:
            if failed.getCondition() != "PATH_NOT_FOUND":
                raise
            return no_rows(self.spark, FILES_SCHEMA)
        if "asset_type" not in found.columns:  # every class-year is gone
            return no_rows(self.spark, FILES_SCHEMA)
        if pairs is not None:
            found = found.where(among(pairs))
        return found.select(
            "asset_type", F.col("path").alias("file_path"), F.col("length").alias("size_bytes"))

    def class_stats(self, **options: bool) -> DataFrame:
        return profile.class_stats(self.live_files(), **options)

    # -- writing -------------------------------------------------------------------------------

    def save(
        self, bars: DataFrame, dedupe_first_load: bool = False,
        stream: str | None = None, batch: int | None = None,
    ) -> list[Pair]:
        """Upserts bars (with symbol, asset_type and `seq`); the class-years that were rewritten.

        A stream names itself and numbers its batches: a batch already taken is not taken again.
        """
        self.recover()
        if stream is not None and self._last_batch(stream) >= batch:
            return []
        mark = None if stream is None else [stream, batch]
        fresh = written(keyed(bars), "arriving")
        pairs = self._pairs_of(fresh)
        if not pairs:
            if mark:
                self._mark(*mark)
            return []
        arriving = fresh.select(*ASSET_KEY).distinct()
        known, hit = None, pairs
        if files.exists(self.spark, f"{self.path}/summary"):
            known = self._known(arriving, {kind for kind, _ in pairs})
            # An asset's old repeats go too, in whatever year they are.
            hit = pairs | self._pairs_of(known.where("repeated_rows > 0"))
        everything = self._bars(hit).withColumn("_batch", F.lit(0)).unionByName(
            fresh.withColumn("_batch", F.lit(1)))
        if dedupe_first_load:
            everything = dedupe_assets(everything, written(arriving, "touched"), ["_batch", "seq"])
        elif known is not None and not known.isEmpty():
            everything = dedupe_assets(everything, known.select(*ASSET_KEY), ["_batch", "seq"])
        self._change(hit, everything.drop("_batch"), mark)
        return sorted(hit)

    def replace(self, bars: DataFrame) -> list[Pair]:
        """Puts the bars of their assets in place of all those stored."""
        self.recover()
        fresh = written(keyed(bars), "arriving")
        pairs = self._pairs_of(fresh)
        if pairs:
            gone = written(fresh.select(*ASSET_KEY).distinct(), "replaced")
            hit = pairs | self._pairs_of(self._known(gone, {kind for kind, _ in pairs}))
            self._change(hit, delete_assets(self._bars(hit), gone).unionByName(fresh))
        return sorted(pairs)

    def delete(self, assets: DataFrame) -> DataFrame:
        """Removes the assets' bars; returns each asset key with whether it had any.

        Read are the summaries, and bars of the class-years in which these assets have some.
        """
        self.recover()
        wanted = written(assets.select(*ASSET_KEY).distinct(), "wanted")
        known = self._known(wanted)
        existing = known.select(*ASSET_KEY).distinct().withColumn("existed", F.lit(True))
        outcome = written(
            wanted.join(existing, ASSET_KEY, "left").withColumn(
                "existed", F.coalesce("existed", F.lit(False))), "deleted")
        if hit := self._pairs_of(known):
            self._change(hit, delete_assets(self._bars(hit), outcome.where("existed")))
        return outcome

    def clean(self, assets: DataFrame | None = None) -> DataFrame:
        """Repairs prices in assets with violations, which also drops their repeated dates.

        Of all assets, or of the given ones; returns those repaired with their number of repaired
        bars. The summaries tell which assets and class-years these are: bars are read only of
        class-years that have something to repair, to fill or to drop.
        """
        self.recover()
        years = self._damage(assets)
        repaired = written(_to_repair(years), "repaired")
        flagged = repaired.select(*ASSET_KEY)
        affected = years.join(flagged, ASSET_KEY, "left_semi")
        repeats = affected.where("repeated_rows > 0").select(*ASSET_KEY).distinct()
        if hit := self._pairs_of(affected.where("violations + open_ended + repeated_rows > 0")):
            cleaned = repair_ohlc(self._bars(hit), flagged, has_nan=False)
            if not repeats.isEmpty():
                cleaned = dedupe_assets(cleaned, written(repeats, "repeats"), ["seq"])
            self._change(hit, cleaned)
        return repaired

    def repairs(self, assets: DataFrame | None = None) -> DataFrame:
        """The assets that `clean` would repair now, with their number of bars to repair."""
        self.recover()
        return _to_repair(self._damage(assets))

    def _damage(self, assets: DataFrame | None) -> DataFrame:
        """What is wrong with the class-years of all assets, or of the given ones."""
        summary = self.summary()
        if assets is not None:
            scope = written(assets.select(*ASSET_KEY).distinct(), "scope")
            summary = summary.join(scope, ASSET_KEY, "left_semi")
        return written(summary_years(summary), "years")

    def compact(self, at_least: int = 2) -> int:
        """Lays out anew every class-year that has `at_least` files or more; how many."""
        self.recover()
        crowded = self.live_files().groupBy(
            "asset_type",
            F.regexp_extract("file_path", r"bar_year=(\d+)/", 1).cast("int").alias("bar_year"),
        ).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= at_least)
        if hit := self._pairs_of(crowded):
            self._change(hit, self._bars(hit))
        return len(hit)

    # -- changes -------------------------------------------------------------------------------

    def _change(self, pairs: set[Pair], bars: DataFrame, mark: list | None = None) -> None:
        """Makes `bars` the contents of the class-years `pairs`."""
        stage = f"{self.path}/staged/{uuid.uuid4().hex}"
        rows = laid_out(bars.select(*STORED_SCHEMA.fieldNames(), *PAIR))
        rows.write.partitionBy(*PAIR).parquet(f"{stage}/bars")
        plan = json.dumps({"pairs": sorted(pairs), "mark": mark})
        files.create_text(self.spark, f"{stage}/plan.json", plan)
        self._apply(stage)

    def _apply(self, stage: str) -> None:
        """Overwrites class-years by what was staged for them. Doing it again does no harm."""
        plan = json.loads(files.read_text(self.spark, f"{stage}/plan.json"))
        bars = self.spark.read.schema(READ_SCHEMA).parquet(f"{stage}/bars")
        self._overwrite("bars", bars.sortWithinPartitions(*FILE_ORDER))
        summary = together(summarise(bars.drop("bar_year")))
        self._overwrite("summary", summary.sortWithinPartitions(*PAIR, "storage_key", "span"))
        left = {
            (m.group(1), int(m.group(2))) for p in files.matching(
                self.spark, f"{stage}/bars/asset_type=*/bar_year=*")
            if (m := re.search(r"asset_type=([^/]+)/bar_year=(\d+)$", p))}
        for kind, year in {(t, y) for t, y in plan["pairs"]} - left:
            for name in ("bars", "summary"):
                files.remove(self.spark, f"{self.path}/{name}/asset_type={kind}/bar_year={year}")
        if plan["mark"]:
            self._mark(*plan["mark"])
        files.remove(self.spark, stage)

    def _overwrite(self, name: str, rows: DataFrame) -> None:
        """Replaces the class-years that `rows` has, and no others."""
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
            *PAIR).parquet(f"{self.path}/{name}")

    def recover(self) -> None:
        """Finishes what a writer that died had begun to overwrite, and discards what it had not."""
        for stage in files.matching(self.spark, f"{self.path}/staged/*"):
            if files.exists(self.spark, f"{stage}/plan.json"):
                self._apply(stage)
            else:
                files.remove(self.spark, stage)

    def _last_batch(self, stream: str) -> int:
        taken = files.matching(self.spark, f"{self.path}/streams/{quote(stream, '')}/*")
        return int(taken[-1].rsplit("/", 1)[1]) if taken else -1

    def _mark(self, stream: str, batch: int) -> None:
        place = f"{self.path}/streams/{quote(stream, '')}/{batch:010d}"
        if not files.exists(self.spark, place):
            files.create_text(self.spark, place, "")

    # -- tables --------------------------------------------------------------------------------

    def _table(self, name: str, schema: T.StructType) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(f"{self.path}/{name}")
        except AnalysisException as failed:
            if failed.getCondition() != "PATH_NOT_FOUND":
                raise
            return no_rows(self.spark, schema)

    def _bars(self, pairs: Iterable[Pair] | None = None) -> DataFrame:
        bars = self._table("bars", READ_SCHEMA)
        return bars if pairs is None else bars.where(among(pairs))

    def _known(self, assets: DataFrame, classes: set[str] | None = None) -> DataFrame:
        """Years (see `summary_years`) of those of the assets that have bars, written."""
        summary = self.summary()
        if classes is not None:
            summary = summary.where(F.col("asset_type").isin(sorted(classes)))
        return written(summary_years(summary.join(assets, ASSET_KEY, "left_semi")), "known")

    def pairs_of(self, bars: DataFrame) -> list[Pair]:
        """The class-years that bars to save belong to."""
        return sorted(self._pairs_of(keyed(bars)))

    @staticmethod
    def _pairs_of(rows: DataFrame) -> set[Pair]:
        """Distinct (asset class, year): at most classes times calendar years."""
        pairs = {(r["asset_type"], r["bar_year"]) for r in rows.select(*PAIR).distinct().collect()}
        if any(kind is None or not re.fullmatch("[A-Za-z0-9_-]+", kind) for kind, _ in pairs):
            raise ValueError("bars to save need plain names as asset_type")
        return pairs


def _to_repair(years: DataFrame) -> DataFrame:
    return years.groupBy(*ASSET_KEY).agg(F.sum("violations").alias("repaired_rows")).where(
        "repaired_rows > 0")


def scoped(
    rows: DataFrame, asset_type: str | None, storage_keys: Iterable[str] | None
) -> DataFrame:
    """The rows of one asset class and of the given storage keys, where these are given."""
    if asset_type is not None:
        rows = rows.where(F.col("asset_type") == asset_type.upper())
    if storage_keys is not None:
        rows = rows.where(F.col("storage_key").isin(sorted(storage_keys)))
    return rows


def among(pairs: Iterable[Pair]) -> Column:
    """Whether a row's class-year is one of `pairs`: a filter that prunes directories."""
    years: dict[str, list[int]] = {}
    for kind, year in sorted(pairs):
        years.setdefault(kind, []).append(year)
    tests = [(F.col("asset_type") == t) & F.col("bar_year").isin(y) for t, y in years.items()]
    return reduce(Column.__or__, tests, F.lit(False))


def laid_out(bars: DataFrame) -> DataFrame:
    """Bars in file order: each task writes one range of (class, year, asset, date).

    Ranges are cut by sampled row counts, so a heavy year or asset spreads over many files, a
    light one shares a task, and an asset's bars sit together: row groups can be skipped on asset
    and date, and per-asset aggregations combine before they shuffle.
    """
    return bars.repartitionByRange(*FILE_ORDER, "seq").sortWithinPartitions(*FILE_ORDER)


def keyed(bars: DataFrame) -> DataFrame:
    """Bars as stored: typed columns, asset key, year; columns a vendor left out are NULL."""
    missing = {"symbol", "asset_type", "seq", "date"} - set(bars.columns)
    if missing:
        raise ValueError(f"bars to save need the columns {sorted(missing)}")
    typed = coerce_types(bars)
    absent = {
        f.name: F.lit(None).cast(f.dataType)
        for f in STORED_SCHEMA if f.name not in typed.columns and f.name != "storage_key"
    }
    full = with_storage_key(typed.withColumns(absent) if absent else typed)
    year = F.coalesce(F.year("date"), F.lit(NO_YEAR))
    return full.select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in STORED_SCHEMA],
        "asset_type", year.alias("bar_year"),
    )
