"""Snapshots of bars and universe, for exchange between sites, and their status document."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.functions.naming import class_dir_strict
from barloom.operators.summary import with_year
from barloom.schema import PARTITION_FIELDS, STORED_SCHEMA, UNIVERSE_SCHEMA
from barloom.sources import files
from barloom.sources.class_years import PAIR, ClassYears
from barloom.sources.store import among
from barloom.work import written

SNAPSHOT_SCHEMA = T.StructType(STORED_SCHEMA.fields + PARTITION_FIELDS)
#: What identifies a class-year's bars whatever their order: sums over bars, of their hashes too.
FINGERPRINT = ["n_bars", "hash_xor", "hash_sum"]
MARKS_SCHEMA = T.StructType([
    *PARTITION_FIELDS,
    T.StructField("n_bars", T.LongType()),
    T.StructField("hash_xor", T.LongType()),
    T.StructField("hash_sum", T.DecimalType(38, 0)),
])


def fingerprints(bars: DataFrame) -> DataFrame:
    """One row per class-year: number of bars, and the xor and sum of their hashes.

    Equal sets of bars have equal fingerprints in whatever order and files they are, and repeated bars
    count as often as they are there. Combined map-side: a row per task and class-year is shuffled.
    """
    # Null and absent cells hash alike wherever they are, so each cell's null is hashed too.
    cells = [c for n in STORED_SCHEMA.fieldNames() for c in (F.col(n), F.col(n).isNull())]
    return _dated(bars).withColumn("_hash", F.xxhash64(*cells)).groupBy(*PAIR).agg(
        F.count(F.lit(1)).alias("n_bars"), F.bit_xor("_hash").alias("hash_xor"),
        F.sum(F.col("_hash").cast("decimal(20,0)")).cast("decimal(38,0)").alias("hash_sum"))


def snapshot_delta(bars: DataFrame, path: str) -> DataFrame:
    """The class-years in which `bars` differ from the snapshot: class, year, `change`.

    `change` is "new", "changed" or "gone"; years are gone only from classes that have bars among
    `bars`. The snapshot's side are the fingerprints stored with it, so its bars are not read.
    """
    ours = written(fingerprints(bars), "fingerprints")
    classes = ours.select("asset_type").distinct()
    theirs = _marks(bars.sparkSession, path).read().join(classes, "asset_type", "left_semi")
    same = [ours[c].eqNullSafe(theirs[c]) for c in [*PAIR, *FINGERPRINT]]
    return (
        ours.join(theirs, [ours[c] == theirs[c] for c in PAIR], "full")
        .where(~reduce(Column.__and__, same))
        .select(
            *(F.coalesce(ours[c], theirs[c]).alias(c) for c in PAIR),
            F.when(theirs["asset_type"].isNull(), "new")
            .when(ours["asset_type"].isNull(), "gone").otherwise("changed").alias("change"))
    )


def export_snapshot(
    bars: DataFrame, universe: DataFrame | None, path: str
) -> list[tuple[str, int]]:
    """Brings the snapshot to these bars, and to the universe if one is given.

    Only class-years that differ are written; these and the ones that went are returned. Asset
    classes without a bar among `bars` stay as they are: a site that holds one class updates that
    one. Bars are staged before any are overwritten, so a job that dies until then leaves the snapshot
    as it was, and one that dies later leaves the next export all it takes to finish. Readers may
    have to read again meanwhile; `unlike_fingerprints` tells whether they have the whole. Bars that
    come with their `bar_year`, as those of a store, are read of class-years to write alone.
    """
    spark = bars.sparkSession
    rows, marks = _rows(spark, path), _marks(spark, path)
    rows.recover()
    marks.recover()
    delta = {(r["asset_type"], r["bar_year"]): r["change"]
             for r in snapshot_delta(bars, path).collect()}  # at most classes times calendar years
    gone = {pair for pair, change in delta.items() if change == "gone"}
    if delta:
        hit = among(delta.keys() - gone)
        # Until the new bars are in place, these class-years are like no others.
        open_marks = [(*pair, None, None, None) for pair in sorted(delta)]
        marks.replace(spark.createDataFrame(open_marks, MARKS_SCHEMA))
        rows.replace(_dated(bars).where(hit), gone)
        # Of what lies there now: bars that changed meanwhile differ from it at the next export.
        marks.replace(fingerprints(rows.read().where(hit)), gone)
    if universe is not None:
        _write_universe(universe, path)
    return sorted(delta)


def _rows(spark: SparkSession, path: str) -> ClassYears:
    return ClassYears(spark, f"{path}/bars", SNAPSHOT_SCHEMA, ["storage_key", "date"])


def _marks(spark: SparkSession, path: str) -> ClassYears:
    return ClassYears(spark, f"{path}/fingerprints", MARKS_SCHEMA, [])


def _dated(bars: DataFrame) -> DataFrame:
    dated = bars if "bar_year" in bars.columns else with_year(bars)
    return dated.select(*SNAPSHOT_SCHEMA.fieldNames())


def import_snapshot(
    spark: SparkSession, path: str, asset_types: Sequence[str] | None = None
) -> DataFrame:
    """A snapshot's bars, of some asset classes or all; only their directories are read."""
    return _of_classes(_rows(spark, path).read(), asset_types).drop("bar_year")


def unlike_fingerprints(
    spark: SparkSession, path: str, asset_types: Sequence[str] | None = None
) -> DataFrame:
    """The class-years whose bars are not those that the snapshot's fingerprints tell of.

    There are none, but while an export is at work or where files were lost or added.
    """
    held = fingerprints(_of_classes(_rows(spark, path).read(), asset_types))
    told = _of_classes(_marks(spark, path).read(), asset_types)
    same = [held[c].eqNullSafe(told[c]) for c in [*PAIR, *FINGERPRINT]]
    return held.join(told, [held[c] == told[c] for c in PAIR], "full").where(
        ~reduce(Column.__and__, same)).select(*(F.coalesce(held[c], told[c]).alias(c) for c in PAIR))


def _of_classes(rows: DataFrame, asset_types: Sequence[str] | None) -> DataFrame:
    if not asset_types:
        return rows
    wanted = sorted({t.upper() for t in asset_types})
    for t in wanted:
        class_dir_strict(t)
    return rows.where(F.col("asset_type").isin(wanted))


def _write_universe(universe: DataFrame, path: str) -> None:
    """Beside the one there is, which goes with the next: a reader may still have it open."""
    spark = universe.sparkSession
    older = files.matching(spark, f"{path}/universe/*")
    number = int(older[-1].rsplit("/", 1)[1]) + 1 if older else 1
    universe.write.parquet(f"{path}/universe/{number:010d}")
    for folder in older[:-1]:
        files.remove(spark, folder)


def import_universe(spark: SparkSession, path: str) -> DataFrame | None:
    found = files.matching(spark, f"{path}/universe/*/_SUCCESS")
    if not found:
        return None
    return spark.read.schema(UNIVERSE_SCHEMA).parquet(found[-1].rsplit("/", 1)[0])


def sync_status(stats: DataFrame, repo_id: str, at: datetime | Column) -> DataFrame:
    """One row `document`: the status JSON for class_stats (one row per class, no total)."""
    stamp = at if isinstance(at, Column) else F.lit(at.isoformat())
    per_class = F.map_from_entries(
        F.sort_array(F.collect_list(F.struct("class", F.struct("files", "size_bytes"))))
    )
    totals = stats.agg(
        F.coalesce(F.sum("files"), F.lit(0)).cast("bigint").alias("total_files"),
        F.coalesce(F.sum("size_bytes"), F.lit(0)).cast("bigint").alias("total_size_bytes"),
        per_class.alias("asset_types"),
    )
    return totals.select(
        F.to_json(F.struct(
            stamp.alias("last_sync_utc"),
            F.lit(repo_id).alias("repo_id"),
            F.struct("total_files", "total_size_bytes", "asset_types").alias("stats"),
        )).alias("document")
    )


def write_sync_status(status: DataFrame, path: str) -> None:
    status.coalesce(1).write.mode("overwrite").text(f"{path}/sync_status")
