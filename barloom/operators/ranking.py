"""Positions in an order that no single task ever holds whole."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.work import written

# monotonically_increasing_id() is the partition, shifted by 33 bits, and the place in it.
_PLACE_BITS = 33


def ranked(rows: DataFrame, *order: Column | str, name: str = "position") -> DataFrame:
    """`rows` with their position, from 1, in the given order, written in that order.

    Rows are dealt by sampled ranges of the order and sorted within them; a position is the place in
    the range and the rows of the ranges before. Only these counts, a row a range, meet in one task.
    Nulls come first, as in `orderBy`. Rows that tie come in any order: give an order that is total.
    """
    columns = [F.col(c) if isinstance(c, str) else c for c in order]
    placed = written(
        rows.repartitionByRange(*columns).sortWithinPartitions(*columns)
        .withColumn("_place", F.monotonically_increasing_id()), "ranked")
    held = placed.groupBy(F.shiftright("_place", _PLACE_BITS).alias("_range")).agg(
        F.count(F.lit(1)).alias("_held"))
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = held.select("_range", F.coalesce(F.sum("_held").over(earlier), F.lit(0)).alias("_start"))
    place = F.col("_place").bitwiseAND((1 << _PLACE_BITS) - 1)
    # A row a range, so at most as many as shuffle partitions: small enough for every task.
    return (
        placed.withColumn("_range", F.shiftright("_place", _PLACE_BITS))
        .join(F.broadcast(starts), "_range")
        .withColumn(name, F.col("_start") + place + 1)
        .drop("_range", "_start", "_place")
    )
