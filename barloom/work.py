"""Intermediate tables in the folder all executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from barloom.session import shared_folder
from barloom.sources import files


def no_rows(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """An empty table the planner knows to be empty."""
    columns = ", ".join(f"cast(null as {f.dataType.simpleString()}) as `{f.name}`" for f in schema)
    return spark.sql(f"select {columns} where false")


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows of `df` as a table on shared storage, written now.

    For derived key sets that decide how a whole table is joined: the planner knows the written
    size, so it broadcasts the keys exactly if they are below spark.sql.autoBroadcastJoinThreshold
    and otherwise plans a shuffle join (whose skewed partitions AQE splits). An estimate would be
    the size of the table the keys come from, and would always shuffle that table. The rows also
    outlive the executors that computed them.
    """
    folder = f"{work_root(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def work_root(spark: SparkSession) -> str:
    """This application's folder for intermediate tables."""
    return f"{shared_folder(spark)}/barloom/work/{spark.sparkContext.applicationId}"


def discard_work(spark: SparkSession) -> None:
    """Deletes all intermediate tables of this application.

    To be called once the results that were built on them have been written or collected.
    """
    files.remove(spark, work_root(spark))
