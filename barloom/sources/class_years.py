"""A Parquet table by asset class and year whose class-years are replaced as a whole."""

from __future__ import annotations

import json
from collections.abc import Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from barloom.sources import files
from barloom.work import no_rows

PAIR = ["asset_type", "bar_year"]


class ClassYears:
    """Rows under `path/asset_type=/bar_year=`; one writer at a time.

    What replaces class-years is written beside the table first. Only when that is complete are they
    overwritten, with dynamic partition overwrite; a writer that dies meanwhile leaves the next one
    all it takes to finish.
    """

    def __init__(
        self, spark: SparkSession, path: str, schema: T.StructType,
        order: Sequence[str] = ("storage_key",),
    ) -> None:
        self.spark = spark
        self.path = path.rstrip("/")
        self.schema = schema
        self.order = [*PAIR, *order]

    def read(self) -> DataFrame:
        try:
            return self.spark.read.schema(self.schema).parquet(f"{self.path}/rows")
        except AnalysisException as failed:
            if failed.getCondition() != "PATH_NOT_FOUND":
                raise
            return no_rows(self.spark, self.schema)

    def replace(self, rows: DataFrame, gone: Iterable[tuple[str, int]] = ()) -> None:
        """Puts `rows` in place of all rows of the class-years they have, and removes those `gone`."""
        self.recover()
        ordered = together(rows.select(*self.schema.names)).sortWithinPartitions(*self.order)
        ordered.write.mode("overwrite").partitionBy(*PAIR).parquet(f"{self.path}/staged")
        files.create_text(self.spark, f"{self.path}/complete", json.dumps(sorted(gone)))
        self.recover()

    def recover(self) -> None:
        """Finishes a replacement that was staged completely."""
        if not files.exists(self.spark, f"{self.path}/complete"):
            return
        gone = json.loads(files.read_text(self.spark, f"{self.path}/complete"))
        staged = self.spark.read.schema(self.schema).parquet(f"{self.path}/staged")
        staged.sortWithinPartitions(*self.order).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic").partitionBy(*PAIR).parquet(f"{self.path}/rows")
        for kind, year in gone:
            files.remove(self.spark, f"{self.path}/rows/asset_type={kind}/bar_year={year}")
        files.remove(self.spark, f"{self.path}/complete")


def together(rows: DataFrame) -> DataFrame:
    """Rows dealt by class-year, so that each has few files; small ones share a task and large ones
    are split, by the sizes that adaptive execution measures."""
    return rows.hint("rebalance", *PAIR)
