"""Small catalog tables on disk: whole-table rewrites for state, logs by day."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.operators import catalog
from barloom.operators.report import report_rows
from barloom.operators.universe import (
    complete_universe,
    reject_unknown_values,
    with_asset_key,
)
from barloom.schema import (
    ASSETS_SCHEMA,
    DOWNLOAD_LOG_SCHEMA,
    UNIVERSE_SCHEMA,
    VALIDATION_LOG_SCHEMA,
)
from barloom.sources import files
from barloom.work import no_rows


#: Versions of a state table that are left beside the newest, for readers that opened them.
KEPT_VERSIONS = 2


class Catalog:
    """Universe, assets, download log and validation log under one folder; one writer at a time."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark = spark
        self.path = path.rstrip("/")

    # -- state tables: every write is a new version, readable once its _SUCCESS file exists ------

    def _newest(self, name: str) -> str | None:
        done = files.matching(self.spark, f"{self.path}/{name}/version=*/_SUCCESS")
        return done[-1].rsplit("/", 1)[0] if done else None

    def _replace(self, name: str, content: DataFrame) -> None:
        begun = files.matching(self.spark, f"{self.path}/{name}/version=*")
        number = int(begun[-1].rsplit("=", 1)[1]) + 1 if begun else 1
        content.write.parquet(f"{self.path}/{name}/version={number:010d}")
        for old in begun[:-KEPT_VERSIONS]:
            files.remove(self.spark, old)

    def _state(self, name: str, schema: T.StructType) -> DataFrame:
        folder = self._newest(name)
        if folder is None:
            return no_rows(self.spark, schema)
        return self.spark.read.schema(schema).parquet(folder)

    def write_universe(self, universe: DataFrame) -> None:
        self._replace("universe", complete_universe(universe))

    def universe(self) -> DataFrame:
        """The saved universe with storage keys; missing if it was never discovered."""
        if self._newest("universe") is None:
            raise FileNotFoundError(f"no asset universe under {self.path}; discover assets first")
        return read_universe(self.spark, self._newest("universe"))

    def assets(self) -> DataFrame:
        return self._state("assets", ASSETS_SCHEMA)

    def upsert_assets(
        self, universe: DataFrame, now: datetime, order: str | None = None
    ) -> None:
        self._replace("assets", catalog.upsert_assets(self.assets(), universe, now, order))

    def write_report(self, report: DataFrame, validated_at: datetime) -> bool:
        """Saves a validation report; a report without rows is not written."""
        if report.isEmpty():
            return False
        self._replace("report", report_rows(report, validated_at))
        return True

    def report(self) -> DataFrame | None:
        folder = self._newest("report")
        return None if folder is None else self.spark.read.parquet(folder)

    # -- logs ----------------------------------------------------------------------------------

    def _append(
        self, name: str, rows: DataFrame, schema: T.StructType, key: Sequence[str], run_id: str,
        at: datetime, known_only: bool,
    ) -> None:
        """Appends the rows of a run that its day of the log has not got yet.

        So a run that is tried again, with its id and its time, logs what it had not logged before.
        """
        present = set(rows.columns)
        shaped = rows.select([
            (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema
        ])
        if known_only:
            orphans = catalog.orphan_log_rows(shaped, self.assets())
            unknown = orphans.agg(F.count(F.lit(1)).alias("n"), F.min("symbol").alias("one")).first()
            if unknown["n"]:
                raise ValueError(
                    f"{unknown['n']} {name} rows name unknown assets, such as {unknown['one']}"
                )
        day = F.lit(at.date())
        logged = self._days(name, schema).where((F.col("log_day") == day) & (F.col("run_id") == run_id))
        catalog.absent_rows(shaped, logged, key).withColumn("log_day", day).write.mode(
            "append").partitionBy("log_day").parquet(f"{self.path}/{name}")

    def _days(self, name: str, schema: T.StructType) -> DataFrame:
        """A log with the day that each row is filed under."""
        filed = T.StructType([*schema.fields, T.StructField("log_day", T.DateType())])
        folder = f"{self.path}/{name}"
        if not files.exists(self.spark, folder):
            return no_rows(self.spark, filed)
        return self.spark.read.schema(filed).parquet(folder)

    def _log(self, name: str, schema: T.StructType) -> DataFrame:
        return self._days(name, schema).drop("log_day")

    def log_downloads(self, rows: DataFrame, run_id: str, at: datetime) -> None:
        """Adds a run's ingest rows, once; run and symbol together identify a row."""
        stamped = rows.withColumns({"run_id": F.lit(run_id), "download_time": F.lit(at)})
        self._append(
            "download_log", stamped, DOWNLOAD_LOG_SCHEMA, ["run_id", "symbol"], run_id, at,
            known_only=True)

    def log_validation(self, rows: DataFrame, run_id: str, at: datetime) -> None:
        """Adds a run's validation rows, once; run, symbol and check together identify a row."""
        stamped = rows.withColumns({"run_id": F.lit(run_id), "validated_at": F.lit(at)})
        self._append(
            "validation_log", stamped, VALIDATION_LOG_SCHEMA, ["run_id", "symbol", "check_name"],
            run_id, at, known_only=True)

    def download_log(self) -> DataFrame:
        return self._log("download_log", DOWNLOAD_LOG_SCHEMA)

    def validation_log(self) -> DataFrame:
        return self._log("validation_log", VALIDATION_LOG_SCHEMA)

    # -- queries -------------------------------------------------------------------------------

    def status_summary(self, as_of: datetime) -> DataFrame:
        return catalog.status_summary(self.assets(), self.download_log(), as_of)

    def query(
        self, sql: str, params: Sequence[Any] | Mapping[str, Any] | None = None
    ) -> DataFrame:
        """A query over the tables assets, download_log and validation_log; commands are refused."""
        tables = {
            "assets": self.assets(),
            "download_log": self.download_log(),
            "validation_log": self.validation_log(),
        }
        return catalog.query(self.spark, tables, sql, params)


def read_universe(spark: SparkSession, path: str) -> DataFrame:
    """A universe file as typed asset rows; absent columns read as their defaults."""
    wanted = set(UNIVERSE_SCHEMA.fieldNames())
    found = spark.read.parquet(path)
    typed = complete_universe(found.select([c for c in found.columns if c in wanted]))
    return with_asset_key(reject_unknown_values(typed))
