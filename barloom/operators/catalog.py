"""Catalog of assets, ingest runs and validation results."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from typing import Any

from pyspark.errors import ParseException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.operators.merge import keep_last
from barloom.operators.ranking import ranked
from barloom.schema import ASSETS_SCHEMA
from barloom.work import written


def upsert_assets(
    existing: DataFrame, incoming: DataFrame, now: datetime, order: str | None = None
) -> DataFrame:
    """Assets by symbol: incoming values win, created_at of a known symbol stays.

    Among incoming rows of one symbol the one with the largest `order` wins.
    """
    stamp = F.lit(now).cast("timestamp")
    if order is None:
        order, incoming = "_order", incoming.withColumn("_order", F.lit(0))
    arriving = keep_last(incoming, ["symbol"], [F.col(order).desc()]).drop(order)
    created = existing.select("symbol", "created_at")
    updated = (
        arriving.drop("created_at", "updated_at").join(created, "symbol", "left")
        .withColumns({"created_at": F.coalesce("created_at", stamp), "updated_at": stamp})
    )
    untouched = existing.join(arriving.select("symbol"), "symbol", "left_anti")
    columns = ASSETS_SCHEMA.fieldNames()
    return updated.select(columns).unionByName(untouched.select(columns))


def all_assets(assets: DataFrame) -> DataFrame:
    return assets.orderBy("symbol")


def all_assets_ranked(assets: DataFrame) -> DataFrame:
    """The assets with their position in `all_assets`."""
    return ranked(assets, "symbol")


def get_asset(assets: DataFrame, symbol: str) -> DataFrame:
    """The asset's row, or no row."""
    return assets.where(F.col("symbol") == symbol)


def count_assets(assets: DataFrame) -> DataFrame:
    return assets.agg(F.count(F.lit(1)).alias("total_assets"))


def asset_type_counts(assets: DataFrame) -> DataFrame:
    """Assets per class in class order, then the TOTAL row."""
    return (
        assets.rollup("asset_type")
        .agg(F.grouping("asset_type").alias("_total"), F.count(F.lit(1)).alias("asset_count"))
        .select(
            F.when(F.col("_total") == 1, "TOTAL").otherwise(F.col("asset_type"))
            .alias("asset_type"),
            "asset_count", "_total",
        )
        .orderBy("_total", "asset_type")
        .drop("_total")
    )


def status_summary(assets: DataFrame, download_log: DataFrame, as_of: datetime) -> DataFrame:
    """One row: assets, assets per class, downloads of the last 24 hours, failed downloads."""
    since = f"timestamp'{as_of.isoformat(' ')}' - interval 24 hours"
    per_class = assets.groupBy("asset_type").agg(F.expr("count(1) as n")).selectExpr(
        "asset_type", "n", "0L as recent", "0L as failed"
    )
    downloads = download_log.agg(
        F.expr(f"count_if(download_time > {since}) as recent"),
        F.expr("count_if(status = 'error') as failed"),
    ).selectExpr("cast(null as string) as asset_type", "0L as n", "recent", "failed")
    return per_class.unionByName(downloads).agg(
        F.expr("sum(n) as total_assets"),
        F.expr("""map_from_entries(sort_array(collect_list(
            if(asset_type is null, null, struct(asset_type, n))))) as asset_type_counts"""),
        F.expr("sum(recent) as recent_downloads_24h"),
        F.expr("sum(failed) as total_failed_downloads"),
    )


def download_history(log: DataFrame, symbol: str | None = None) -> DataFrame:
    """Ingest log newest first, of one symbol or by symbol for all."""
    return _history(log, symbol, "download_time")


def validation_history(log: DataFrame, symbol: str | None = None) -> DataFrame:
    """Validation log newest first, of one symbol or by symbol for all."""
    return _history(log, symbol, "validated_at")


def _history(log: DataFrame, symbol: str | None, stamp: str) -> DataFrame:
    if symbol is not None:
        log = log.where(F.col("symbol") == symbol)
    return log.orderBy("symbol", F.col(stamp).desc())


def history_ranked(log: DataFrame, stamp: str, *ties: str) -> DataFrame:
    """A log with each row's position in its history by symbol; `ties` order rows of one moment."""
    return ranked(log, "symbol", F.col(stamp).desc(), *ties)


def absent_rows(rows: DataFrame, log: DataFrame, key: Sequence[str]) -> DataFrame:
    """The rows whose key the log has not got; keys that `rows` itself repeats stay repeated."""
    return rows.join(log.select(*key).distinct(), list(key), "left_anti").select(*rows.columns)


def orphan_log_rows(log: DataFrame, assets: DataFrame) -> DataFrame:
    """Log rows whose symbol is not in the catalog."""
    known = written(assets.select("symbol").distinct(), "symbols")
    return log.join(known, "symbol", "left_anti")


def query(
    spark: SparkSession, tables: dict[str, DataFrame], sql: str,
    params: Sequence[Any] | Mapping[str, Any] | None = None,
) -> DataFrame:
    """SQL over the named tables; `params` fills `?` placeholders in order, or `:name` ones by name.

    The statement has to be one query that only reads. It is put where only a query can stand, so
    that a command fails to parse before any of it is run. The caller's own temporary views of those
    names are back afterwards.
    """
    text = f"select * from (\n{sql.strip().rstrip(';')}\n)"
    args = dict(params) if isinstance(params, Mapping) else list(params or []) or None
    views = {t.name for t in spark.catalog.listTables() if t.isTemporary}
    own = {name: spark.table(name) for name in tables if name in views}
    try:
        for name, table in tables.items():
            table.createOrReplaceTempView(name)
        return spark.sql(text, args=args) if args else spark.sql(text)
    except ParseException as failed:
        raise ValueError(f"not one query that only reads: {sql}") from failed
    finally:
        for name in tables:
            spark.catalog.dropTempView(name)
        for name, table in own.items():
            table.createOrReplaceTempView(name)
