"""Validation of landed bars as they arrive: summaries kept up to date by a streaming aggregation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from barloom.operators.normalize import coerce_types, normalize_bars, with_storage_key
from barloom.operators.summary import YEAR_KEY, summarise
from barloom.sources.class_years import ClassYears
from barloom.sources.landing import CSV_OPTIONS, RAW_BAR_SCHEMA, landed_schema
from barloom.work import no_rows, written

#: The columns of landed bars that the checks look at.
CHECKED = ["date", "open", "high", "low", "close", "volume"]


def landed_bars(raw: DataFrame) -> DataFrame:
    """Typed bars with their asset key from raw vendor rows, streamed or not."""
    return with_storage_key(coerce_types(normalize_bars(raw)))


def summaries(spark: SparkSession, path: str) -> ClassYears:
    """The table that `start_validation` keeps: a row per asset, year and span of all landed bars."""
    return ClassYears(spark, path, summarise(landed_bars(no_rows(spark, RAW_BAR_SCHEMA))).schema)


def put(table: ClassYears, rows: DataFrame) -> None:
    """Puts summary rows in place of those of the same asset, year and span.

    Rows are totals, not differences, so putting them again changes nothing. Of the table only the
    class-years of `rows` are read and written.
    """
    table.recover()
    rows = written(rows, "summed")
    years = {(r["asset_type"], r["bar_year"]) for r in
             rows.select("asset_type", "bar_year").distinct().collect()}  # classes by years
    if not years:
        return
    kinds, numbers = {k for k, _ in years}, {y for _, y in years}
    old = table.read().where(
        F.col("asset_type").isin(sorted(kinds)) & F.col("bar_year").isin(sorted(numbers)))
    old = old.join(rows.select("asset_type", "bar_year").distinct(), ["asset_type", "bar_year"], "left_semi")
    same = [old[k] == rows[k] for k in YEAR_KEY] + [old["span"].eqNullSafe(rows["span"])]
    table.replace(old.join(rows, same, "left_anti").unionByName(rows.select(old.columns)))


def start_validation(
    spark: SparkSession, landing: str, table: ClassYears, checkpoint: str,
    name: str = "validation", fmt: str = "parquet", schema: T.StructType | None = None,
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Brings the summaries up to date with every landed file not taken yet, then stops.

    The stream's state has a row per asset, year and span: as many as 16-day spans with bars, however
    many bars. It takes late corrections of any age, so there is no watermark, and what has landed
    twice counts twice, which the check for repeated dates then tells. Each micro-batch gives the
    totals so far of the spans it added to, which replace the stored ones: a batch that is replayed
    after a failure gives the same totals again and counts once. With a new checkpoint all files
    count anew, and need a new table.
    """
    reader = spark.readStream.format(fmt).schema(schema or landed_schema(spark, landing, fmt))
    if fmt == "csv":
        reader = reader.options(**CSV_OPTIONS)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    totals = summarise(landed_bars(reader.load(landing)))
    return (
        totals.writeStream.outputMode("update").foreachBatch(lambda rows, _: put(table, rows))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).queryName(name).start()
    )
