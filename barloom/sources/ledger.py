"""A ledger of landed files that batch runs have taken, so that a run reads only the others."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.schema import ASSET_KEY
from barloom.work import no_rows, written

FILE_KEY = ["file_path", "file_size", "modified_at"]
LEDGER = "file_path string, file_size bigint, modified_at timestamp, scope string, run_id string"
LISTING = "path string, file_path string, file_size bigint, modified_at timestamp"


def scope_of(universe: DataFrame) -> str:
    """A fingerprint of a universe's assets, whatever their order and however often listed.

    A file's bars are looked at for the assets there are; with other assets it has to be read again.
    """
    key = F.xxhash64(*ASSET_KEY)
    found = universe.select(*ASSET_KEY).distinct().agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor(key).alias("x"),
        F.sum(F.pmod(key, F.lit(1 << 31))).alias("s")).first()
    return f"{found['n']}-{found['x']}-{found['s']}"


def landed_files(spark: SparkSession, folder: str) -> DataFrame:
    """(path, file_path, file_size, modified_at) of the folder's files; contents are not read.

    A folder that isn't there has no files. Names that begin with _ or a dot don't count.
    """
    try:
        found = spark.read.format("binaryFile").load(folder)
    except AnalysisException as failed:
        if failed.getCondition() != "PATH_NOT_FOUND":
            raise
        return no_rows(spark, spark.createDataFrame([], LISTING).schema)
    return found.select(
        "path", "_metadata.file_path", "_metadata.file_size",
        F.col("_metadata.file_modification_time").alias("modified_at"))


class FileLedger:
    """Files by path, length and modification time, under one folder."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark = spark
        self.path = path.rstrip("/")

    def taken(self, scope: str) -> DataFrame:
        try:
            found = self.spark.read.schema(LEDGER).parquet(self.path)
        except AnalysisException as failed:
            if failed.getCondition() != "PATH_NOT_FOUND":
                raise
            return no_rows(self.spark, self.spark.createDataFrame([], LEDGER).schema)
        return found.where(F.col("scope") == scope)

    def not_taken(self, listing: DataFrame, scope: str) -> DataFrame:
        """The listed files that no run with this scope has taken as they are now, written.

        A file that was written anew under its old name has another length or time, and counts.
        """
        return written(
            listing.join(self.taken(scope).select(*FILE_KEY), FILE_KEY, "left_anti"), "untaken")

    def take(self, listing: DataFrame, scope: str, run_id: str) -> None:
        """To be called when the files' bars are stored: a run that dies before reads them again.

        Files that are there already, from a run that died meanwhile, are not added again.
        """
        listing.join(self.taken(scope).select(*FILE_KEY), FILE_KEY, "left_anti").select(
            *FILE_KEY, F.lit(scope).alias("scope"), F.lit(run_id).alias("run_id")).write.mode(
            "append").parquet(self.path)


def read_whole_by(raw: DataFrame, listing: DataFrame, end: date) -> DataFrame:
    """The listed files whose bars are all dated before `end`; later bars are for a later run."""
    day = next((c for c in raw.columns if c.lower() == "date"), None)
    if day is None:
        return listing
    later = raw.select("_metadata.file_path", F.to_date(F.col(f"`{day}`")).alias("day")).where(
        F.col("day") >= F.lit(end)).select("file_path").distinct()
    return listing.join(written(later, "later"), "file_path", "left_anti")


def paths_of(listing: DataFrame) -> Sequence[str]:
    """The files' paths for a reader; as many as Spark's own listing of them holds."""
    return [r["path"] for r in listing.select("path").collect()]
