"""Landed raw vendor files: one frame over all assets, vendor column names."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Read as text and coerced later, so that one bad cell does not fail a file.
RAW_BAR_SCHEMA = T.StructType([
    T.StructField("Date", T.StringType()),
    T.StructField("Open", T.StringType()),
    T.StructField("High", T.StringType()),
    T.StructField("Low", T.StringType()),
    T.StructField("Close", T.StringType()),
    T.StructField("Adj Close", T.StringType()),
    T.StructField("Volume", T.StringType()),
    T.StructField("Dividends", T.StringType()),
    T.StructField("Stock Splits", T.StringType()),
    T.StructField("Symbol", T.StringType()),
    T.StructField("asset_type", T.StringType()),
    T.StructField("seq", T.LongType()),
])


OPTIONAL = {"Dividends", "Stock Splits"}

# Columns go by name: a CSV file whose header isn't the schema's names in order is an error.
CSV_OPTIONS = {"header": "true", "enforceSchema": "false"}


# What an optional column reads as in a Parquet file without it; nulls in files with it stay.
ABSENT = {T.DoubleType(): "0.0D", T.FloatType(): "0.0F", T.LongType(): "0L", T.IntegerType(): "0",
          T.StringType(): "'0.0'"}


def landed_schema(
    spark: SparkSession, path: str | Sequence[str], fmt: str = "parquet"
) -> T.StructType:
    """The columns that landed files have, CSV cells as text.

    CSV files of one folder have one header. Parquet files may differ: the columns are those of all
    footers, and in rows of a file without Dividends or Stock Splits these are 0.0, other columns
    null. Footers that disagree on a column's type are an error. Before the first file arrives the
    columns are the vendor's usual ones without the optional ones.
    """
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True)
    elif fmt == "parquet":
        reader = reader.option("mergeSchema", True)
    try:
        found = reader.load(path).schema
    except AnalysisException as failed:
        if failed.getCondition() not in ("UNABLE_TO_INFER_SCHEMA", "PATH_NOT_FOUND"):
            raise
        found = T.StructType()
    if not found.fields:
        return T.StructType([f for f in RAW_BAR_SCHEMA.fields if f.name not in OPTIONAL])
    return T.StructType([with_default(f) for f in found.fields]) if fmt == "parquet" else found


def with_default(field: T.StructField) -> T.StructField:
    """The field, and if it is optional the value that Spark gives to rows of files without it."""
    if field.name.lower().replace(" ", "_") not in ("dividends", "stock_splits"):
        return field
    if field.dataType not in ABSENT:
        raise ValueError(f"{field.name} is {field.dataType.simpleString()} in landed files")
    value = ABSENT[field.dataType]
    return T.StructField(field.name, field.dataType, True, {
        **field.metadata, "CURRENT_DEFAULT": value, "EXISTS_DEFAULT": value})


def read_landed(
    spark: SparkSession, path: str | Sequence[str], fmt: str = "parquet",
    schema: T.StructType | None = None,
) -> DataFrame:
    """Landed files of one format (parquet, csv with header, json), columns by name.

    `path` is a folder, a file, or several files.

    Without a `schema` the columns of Parquet and CSV files are those of `landed_schema`.
    """
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.options(**CSV_OPTIONS).schema(schema or landed_schema(spark, path, fmt))
    elif schema is not None or fmt == "parquet":
        reader = reader.schema(schema or landed_schema(spark, path, fmt))
    return reader.load(path)
