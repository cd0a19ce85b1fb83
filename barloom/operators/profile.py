"""Per-asset and per-class figures over the bars."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.functions.naming import class_dir
from barloom.operators.ranking import ranked
from barloom.schema import ASSET_CLASSES, ASSET_KEY


def last_dates(bars: DataFrame) -> DataFrame:
    """The newest bar date of every asset."""
    return bars.groupBy(*ASSET_KEY).agg(F.max("date").alias("last_date"))


def row_counts(universe: DataFrame, bars: DataFrame) -> DataFrame:
    """Universe rows with the number of bars stored for each; 0 without bars."""
    counted = bars.groupBy(*ASSET_KEY).agg(F.count(F.lit(1)).alias("row_count"))
    return universe.join(counted, ASSET_KEY, "left").withColumn(
        "row_count", F.coalesce("row_count", F.lit(0).cast("bigint"))
    )


def stored_assets(bars: DataFrame) -> DataFrame:
    """Every asset that has bars, ordered by storage key; one name can occur in two classes."""
    return bars.select(*ASSET_KEY).distinct().orderBy("storage_key", "asset_type")


def stored_assets_ranked(bars: DataFrame) -> DataFrame:
    """The assets that have bars with their position in `stored_assets`."""
    return ranked(bars.select(*ASSET_KEY).distinct(), "storage_key", "asset_type")


def class_counts(bars: DataFrame) -> DataFrame:
    """Rows and assets per asset class."""
    return bars.groupBy("asset_type").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_distinct("storage_key").alias("asset_count"),
    )


def class_stats(
    files: DataFrame, with_empty_classes: bool = False, with_total: bool = False
) -> DataFrame:
    """File count and bytes per class directory from rows (asset_type, size_bytes), one per file.

    Classes without files are left out unless `with_empty_classes`; the total row has class NULL.
    """
    measures = [
        F.count("size_bytes").alias("files"),
        F.coalesce(F.sum("size_bytes"), F.lit(0)).cast("bigint").alias("size_bytes"),
    ]
    named = files.select(class_dir().alias("class"), "size_bytes")
    if with_empty_classes:
        spark = files.sparkSession
        names = ", ".join(f"'{c}'" for c in ASSET_CLASSES.values())
        classes = spark.sql(f"select explode(array({names})) as class")
        named = named.unionByName(classes, allowMissingColumns=True)
    grouped = named.rollup("class") if with_total else named.groupBy("class")
    return grouped.agg(*measures)


def size_label(size_bytes: Column) -> Column:
    """Bytes as mebibytes with one decimal, ties to even: `12.3 MB`."""
    return F.format_string("%.1f MB", F.bround(size_bytes.cast("double") / 1048576, 1))


def coverage_table(stats: DataFrame) -> DataFrame:
    """Display rows of class_stats: title-case class, file count, size label."""
    return stats.select(
        F.initcap("class").alias("class"), "files", size_label(F.col("size_bytes")).alias("size")
    )
