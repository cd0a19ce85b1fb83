"""Session settings the jobs are written for."""

from __future__ import annotations

import atexit
import shutil
import tempfile
from functools import cache

from pyspark.sql import SparkSession

# Runtime re-planning does the sizing: it starts with many shuffle partitions (see build_session),
# coalesces small ones, splits skewed join partitions, and chooses broadcast joins from measured
# (not guessed) sizes.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(
    app: str = "barloom", master: str | None = None, initial_partitions: int | None = None,
    **overrides: str,
) -> SparkSession:
    """A session with SETTINGS; `overrides` use `__` for dots in setting names.

    `initial_partitions` is the number of shuffle partitions before small ones are merged: bytes
    shuffled over 128 MB, so about 800,000 for a shuffle of 100 TB. Spark's default is 200.
    """
    builder = SparkSession.builder.appName(app)
    if initial_partitions:
        builder = builder.config(
            "spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(initial_partitions))
    if master:
        builder = builder.master(master)
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    for name, value in overrides.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


@cache
def _local_folder() -> str:
    """Where one process is all there is: a folder that goes with it."""
    folder = tempfile.mkdtemp(prefix="barloom-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in spark.checkpoint.dir."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    master = spark.sparkContext.master
    if master == "local" or master.startswith("local["):
        return _local_folder()
    raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
