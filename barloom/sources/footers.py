"""Figures of a store's bars from the footers of its Parquet files: no row is read."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.operators.summary import NO_YEAR
from barloom.sources.class_years import PAIR
from barloom.sources.store import READ_SCHEMA
from barloom.work import written

# Only the DataSource V2 reader of Parquet answers aggregates from footers.
SETTINGS = {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}


@contextmanager
def from_footers(spark: SparkSession) -> Iterator[None]:
    """While it lasts, counts and extremes by partition columns are planned as footer reads."""
    before = {name: spark.conf.get(name, None) for name in SETTINGS}
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def class_year_counts(spark: SparkSession, path: str) -> DataFrame:
    """asset_type, bar_year and row_count; to be planned and run under `from_footers`.

    It has to group by all partition columns, or Spark reads rows.
    """
    bars = spark.read.schema(READ_SCHEMA).parquet(path)
    return bars.groupBy(*PAIR).agg(F.count(F.lit(1)).alias("row_count"))


def class_year_last_dates(spark: SparkSession, path: str) -> DataFrame:
    """asset_type, bar_year and last_date of dated bars, in the same way.

    Bars without a date have a folder of their own, whose footers hold no greatest date.
    """
    bars = spark.read.schema(READ_SCHEMA).parquet(path).where(F.col("bar_year") != NO_YEAR)
    return bars.groupBy(*PAIR).agg(F.max("date").alias("last_date"))


def class_row_counts(spark: SparkSession, path: str) -> DataFrame:
    """Bars of each class under `path`, a folder by class and year."""
    with from_footers(spark):
        counted = written(class_year_counts(spark, path), "counted")
    return counted.groupBy("asset_type").agg(F.sum("row_count").alias("row_count"))


def class_last_dates(spark: SparkSession, path: str) -> DataFrame:
    """The newest date of each class under `path` that has dated bars."""
    with from_footers(spark):
        found = written(class_year_last_dates(spark, path), "found")
    return found.groupBy("asset_type").agg(F.max("last_date").alias("last_date"))
