"""Landed bar files into the store, as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from barloom.operators.normalize import normalize_bars
from barloom.sources.landing import CSV_OPTIONS, landed_schema
from barloom.sources.store import BarStore


def start_ingest(
    spark: SparkSession, landing: str, store: BarStore, checkpoint: str,
    name: str = "landing", fmt: str = "parquet", schema: T.StructType | None = None,
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Upserts every landed file not taken yet, then stops (run again for later files).

    Late corrections must win, so there is no watermark and no streaming deduplication: each
    micro-batch goes through the store's keep-last upsert. The store records the last batch it
    took under `name`, in the same commit as the bars, so a batch replayed after a failure has no
    effect. A replaced checkpoint restarts batch numbers and needs a new name. Without a `schema`
    the landed files' own columns are read, so what a vendor leaves out counts as absent.
    """
    reader = spark.readStream.format(fmt).schema(schema or landed_schema(spark, landing, fmt))
    if fmt == "csv":
        reader = reader.options(**CSV_OPTIONS)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)

    def take(raw: DataFrame, batch: int) -> None:
        store.save(normalize_bars(raw), stream=name, batch=batch)

    return (
        reader.load(landing).writeStream.foreachBatch(take)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).queryName(name).start()
    )
