"""Rolling status of downloads: what the last 24 hours brought, as of every hour."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

PANES = T.StructType([
    T.StructField("pane_end", T.TimestampType()),
    T.StructField("downloads", T.LongType()),
    T.StructField("failed", T.LongType()),
])


def panes_of(log: DataFrame, delay: str) -> DataFrame:
    """Downloads and failed ones by hour; rows count until the hour is `delay` behind the newest.

    Days that overlap are put together from hours when they are read, so a row counts once here and
    the state has a row an hour, not one for each of the 24 days that a row belongs to.
    """
    timed = log.select(F.col("download_time").cast("timestamp").alias("at"), "status")
    return (
        timed.withWatermark("at", delay).groupBy(F.window("at", "1 hour").alias("pane"))
        .agg(F.count(F.lit(1)).alias("downloads"), F.expr("count_if(status = 'error') as failed"))
        .select(F.col("pane.end").alias("pane_end"), "downloads", "failed")
    )


def start_status(
    spark: SparkSession, log: str, schema: T.StructType, panes: str, checkpoint: str,
    delay: str = "3 days", name: str = "status",
) -> StreamingQuery:
    """Takes the log's Parquet files that were not taken yet into the hourly panes, then stops.

    A micro-batch writes the totals so far of the hours it added to, in a folder of its own that a
    replay overwrites; the newest totals of an hour count.
    """
    counted = panes_of(spark.readStream.schema(schema).parquet(log), delay)

    def put(rows: DataFrame, batch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{panes}/batch={batch}")

    return (
        counted.writeStream.outputMode("update").foreachBatch(put)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).queryName(name).start()
    )


def newest_panes(spark: SparkSession, panes: str) -> DataFrame:
    """One row an hour from what `start_status` wrote."""
    totals = T.StructType([*PANES.fields, T.StructField("batch", T.LongType())])
    found = spark.read.schema(totals).parquet(panes)
    newest = F.max_by(F.struct("downloads", "failed"), "batch").alias("_newest")
    return found.groupBy("pane_end").agg(newest).select("pane_end", "_newest.*")


def status_by_hour(panes: DataFrame) -> DataFrame:
    """Downloads and failed ones of the 24 hours before each full hour that has some."""
    ends = "explode(sequence(pane_end, pane_end + interval 23 hours, interval 1 hour)) as window_end"
    return panes.selectExpr(ends, "downloads", "failed").groupBy("window_end").agg(
        F.sum("downloads").alias("downloads"), F.sum("failed").alias("failed"))
