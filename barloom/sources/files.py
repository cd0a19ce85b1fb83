"""Small file-system helpers on Hadoop's FileSystem, so any Spark-readable location works."""

from __future__ import annotations

from py4j.java_gateway import JavaObject
from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _open(spark, path)
    return fs.exists(target)


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Full paths that match a glob pattern, sorted."""
    fs, target = _open(spark, pattern)
    found = fs.globStatus(target)
    return sorted(status.getPath().toString() for status in found) if found else []


def remove(spark: SparkSession, path: str) -> None:
    fs, target = _open(spark, path)
    fs.delete(target, True)


def read_text(spark: SparkSession, path: str) -> str:
    fs, target = _open(spark, path)
    stream = fs.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_text(spark: SparkSession, path: str, content: str) -> None:
    """Writes a new file that appears complete or not at all; an existing path is an error."""
    fs, target = _open(spark, path)
    draft = spark._jvm.org.apache.hadoop.fs.Path(path + ".draft")
    stream = fs.create(draft, True)
    try:
        stream.write(bytearray(content, "utf-8"))
    finally:
        stream.close()
    if fs.exists(target) or not fs.rename(draft, target):
        raise FileExistsError(path)
