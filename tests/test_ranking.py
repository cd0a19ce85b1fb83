"""Positions in an order, against Python's sort."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from barloom.operators.catalog import absent_rows, history_ranked
from barloom.operators.ranking import ranked
from test_plans import plan, whole_text  # noqa: F401


def test_positions_of_random_rows(spark):
    dice = random.Random(3)
    # One value holds a third of the rows.
    rows = [(dice.choice([None, 7, 7, dice.randrange(1000)]), i) for i in range(5000)]
    found = ranked(spark.createDataFrame(rows, "a int, id int"), F.col("a").asc(), "id").collect()
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    assert [(r.a, r.id) for r in sorted(found, key=lambda r: r.position)] == order
    assert sorted(r.position for r in found) == list(range(1, 5001))


def test_no_rows_and_descending(spark):
    none = spark.createDataFrame([], "symbol string, at int")
    assert ranked(none, "symbol").collect() == []
    rows = spark.createDataFrame([("b", 1), ("a", 1), ("b", 3), ("b", 3)], "symbol string, at int")
    found = sorted((r.position, r.symbol, r.at) for r in history_ranked(rows, "at").collect())
    assert found == [(1, "a", 1), (2, "b", 3), (3, "b", 3), (4, "b", 1)]


def test_only_counts_meet_in_one_task(spark, tmp_path):
    path = str(tmp_path / "rows")
    spark.range(1000).write.parquet(path)
    text = plan(ranked(spark.read.parquet(path), "id"))
    # The window is over one row a range; rows themselves are neither gathered nor shuffled again.
    assert text.count("Exchange SinglePartition") == 1
    assert "SortMergeJoin" not in text and "BroadcastHashJoin" in text
    single = text.index("Exchange SinglePartition")
    assert "HashAggregate" in text[single:]


def test_rows_the_log_lacks(spark):
    schema = "run string, symbol string, n int"
    rows = spark.createDataFrame([("r", "a", 1), ("r", "b", 1), ("r", "b", 2)], schema)
    log = spark.createDataFrame([("r", "a", 9), ("s", "b", 9)], schema)
    left = absent_rows(rows, log, ["run", "symbol"]).collect()
    assert sorted((r.symbol, r.n) for r in left) == [("b", 1), ("b", 2)]
