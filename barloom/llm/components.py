"""Connected components of an edge list that no machine has to hold."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.work import written


def _state(edges: DataFrame) -> tuple:
    """A summary that tells whether two edge sets are the same."""
    return tuple(edges.agg(
        F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")),
        F.bit_xor(F.xxhash64("v", "u"))).first())


def _least(pairs: DataFrame) -> DataFrame:
    """(u, m): the least neighbour of each u, or u itself; combined on the map side."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m"))
    return written(least.select("u", F.least("u", "m").alias("m")), "least")


def components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """(node, root): the smallest node that each node of `edges` (u, v: long) can reach.

    Alternating large-star and small-star steps: in turn, every node hands its larger neighbours,
    then its smaller ones, to the least of them, until only stars remain, after a number of rounds
    that grows with the logarithm of the longest path at most squared. Every round's edges are
    written; least neighbours are looked up by a join of two written tables, whose heavy keys
    adaptive execution splits, so the centre of a large star is no single task's. Nodes without an
    edge don't occur; self-loops and repeated edges are allowed.
    """
    now = written(edges.where("u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before = None
    for _ in range(max_rounds):
        state = _state(now)
        if state == before:
            break
        before = state
        both = written(now.unionAll(now.select(F.col("v").alias("u"), F.col("u").alias("v"))), "both")
        large = both.where("v > u").join(_least(both), "u").select(
            F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = written(large, "large")  # u > v: each node and a smaller one it is linked to
        least = _least(large)
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where(
            "u <> v").unionAll(least.select("u", F.col("m").alias("v")).where("u <> v"))
        now = written(small.distinct(), "edges")
    else:
        raise RuntimeError(f"no stars after {max_rounds} rounds")
    # Stars: every node but the roots stands once, beside its root.
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
