"""The rolling status of the download log: late rows, replays, hours that overlap."""

from __future__ import annotations

import os
import shutil
from collections import Counter
from datetime import datetime, timedelta

import pytest

from barloom.streaming.status import newest_panes, start_status, status_by_hour

SCHEMA = "download_time timestamp, status string"


@pytest.fixture
def log(spark, tmp_path):
    """Lands rows and runs the stream over them; gives the status by hour."""
    folder = str(tmp_path)
    schema = spark.createDataFrame([], SCHEMA).schema

    def take(rows):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{folder}/log")
        start_status(
            spark, f"{folder}/log", schema, f"{folder}/panes", f"{folder}/checkpoint", "2 hours",
            name=f"status-{tmp_path.name}",
        ).awaitTermination()
        found = status_by_hour(newest_panes(spark, f"{folder}/panes")).collect()
        return {r.window_end: (r.downloads, r.failed) for r in found}

    take.folder = folder
    return take


def expected(rows) -> dict:
    downloads, failed = Counter(), Counter()
    for at, status in rows:
        hour = at.replace(minute=0, second=0, microsecond=0)
        for k in range(1, 25):
            downloads[hour + timedelta(hours=k)] += 1
            failed[hour + timedelta(hours=k)] += status == "error"
    return {end: (downloads[end], failed[end]) for end in downloads}


T0 = datetime(2024, 1, 5, 10, 30)


def test_late_rows(log):
    first = [(T0, "success"), (T0 + timedelta(hours=5), "error")]
    assert log(first) == expected(first)
    # The newest row is of 15:30, so hours that end until 13:30 are closed.
    inside = [(datetime(2024, 1, 5, 13, 10), "error"), (datetime(2024, 1, 6, 9, 0), "success")]
    outside = [(datetime(2024, 1, 5, 12, 59), "error"), (datetime(2024, 1, 3), "success")]
    assert log(inside + outside) == expected(first + inside)
    # A row on the full hour belongs to the hour it begins, and no row without a time counts.
    more = [(datetime(2024, 1, 6, 9, 0), "error")]
    assert log([*more, (None, "error")]) == expected(first + inside + more)


def numbers(folder: str) -> set[int]:
    return {int(name) for name in os.listdir(folder) if name.isdigit()}


def forget(folder: str, kind: str, number: int) -> None:
    for name in (str(number), f".{number}.crc"):
        if os.path.exists(f"{folder}/checkpoint/{kind}/{name}"):
            shutil.move(f"{folder}/checkpoint/{kind}/{name}", f"{folder}/{kind}-{name}")


def test_a_batch_that_is_replayed_counts_once(log):
    first = [(T0, "success")]
    log(first)
    before = numbers(f"{log.folder}/checkpoint/commits")
    second = [(T0 + timedelta(minutes=5), "error"), (T0 + timedelta(minutes=70), "success")]
    once = log(second)
    # As after a failure between the batch's output and its commit.
    new = numbers(f"{log.folder}/checkpoint/commits") - before
    for number in new:
        forget(log.folder, "commits", number)
    for number in numbers(f"{log.folder}/checkpoint/offsets"):
        if number > min(new):
            forget(log.folder, "offsets", number)
    third = [(T0 + timedelta(minutes=75), "error")]
    assert once == expected(first + second)
    assert log(third) == expected(first + second + third)
