"""Packing: length buckets that minimise padding, and token-budget batches inside each.

Documents longer than a sequence are cut into pieces, so lengths are bounded, and so is the global
histogram of lengths that Spark counts. Dynamic programming over the histogram chooses at most
`buckets` boundaries of the least total padding. A bucket's pieces are numbered in a fixed order
by a distributed ranking, and each run of as many as fit the token budget, padded, is a batch.
"""

from __future__ import annotations

from bisect import bisect_left
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import ranked, word_count
from barloom.work import written


@dataclass(frozen=True)
class Settings:
    #: Longest sequence, in tokens; longer documents are cut.
    max_tokens: int = 2048
    buckets: int = 8
    #: Padded tokens of a batch, at most.
    batch_tokens: int = 16_384


SETTINGS = Settings()


def boundaries(histogram: dict[int, int], buckets: int) -> list[int]:
    """The lengths, ascending, of at most `buckets` buckets with the least padding in total.

    A piece goes to the shortest bucket that is long enough. `histogram` counts positive lengths.
    Of equally good choices, the last boundaries are the shortest possible. Empty without lengths.
    """
    lengths = sorted(histogram)
    if not lengths:
        return []
    size = np.array(lengths, np.int64)
    count = np.concatenate(([0], np.cumsum([histogram[n] for n in lengths], dtype=np.int64)))
    tokens = np.concatenate(([0], np.cumsum([n * histogram[n] for n in lengths], dtype=np.int64)))
    n = len(lengths)
    # cost[j]: least padding of the j shortest lengths in the buckets so far; came[k][j]: where the
    # last of them begins.
    cost = np.concatenate(([0], np.full(n, np.iinfo(np.int64).max // 4)))
    came = []
    for _ in range(min(buckets, n)):
        best, start = cost.copy(), np.arange(n + 1)
        for j in range(1, n + 1):
            padding = size[j - 1] * (count[j] - count[:j]) - (tokens[j] - tokens[:j])
            total = cost[:j] + padding
            i = int(np.argmin(total))
            if total[i] < best[j]:
                best[j], start[j] = total[i], i
        came.append(start)
        cost = best
    chosen, j = [], n
    for start in reversed(came):
        if start[j] < j:
            chosen.append(lengths[j - 1])
            j = int(start[j])
    return chosen[::-1]


def pieces(docs: DataFrame, tokens: Column, max_tokens: int) -> DataFrame:
    """(doc_id, piece, start, n_tokens): each row's tokens, cut every `max_tokens`.

    A document without tokens has one piece of length 0.
    """
    counted = docs.select("doc_id", tokens.alias("_tokens"))
    last = F.greatest(F.ceil(F.col("_tokens") / max_tokens) - 1, F.lit(0))
    return counted.select(
        "doc_id", "_tokens", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("piece")
    ).select(
        "doc_id", "piece", (F.col("piece") * max_tokens).alias("start"),
        F.least(F.col("_tokens") - F.col("piece") * max_tokens, F.lit(max_tokens).cast("long")).alias(
            "n_tokens"))


def packed(docs: DataFrame, settings: Settings = SETTINGS, tokens: Column | None = None) -> DataFrame:
    """Where each piece of each row of `docs` goes.

    doc_id, piece, start and n_tokens tell the piece (in tokens; words of `text` unless `tokens`
    counts otherwise); bucket and padded_to its bucket, from 0, and the length it is padded to;
    batch its batch in the bucket, from 0, and slot its place there. A batch has
    batch_tokens // padded_to slots, one at least. Pieces without tokens need no place: their
    bucket, padded_to, batch and slot are null. Pieces of a bucket come in the order of a hash of
    doc_id, so sources mix; repeated rows are packed one by one. An empty table gives an empty
    result. Nothing else of `docs` is read.
    """
    cut = written(
        pieces(docs, word_count("text") if tokens is None else tokens, settings.max_tokens), "pieces")
    histogram = {
        r["n_tokens"]: r["n"] for r in  # max_tokens rows at most
        cut.where("n_tokens > 0").groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n")).collect()
    }
    bounds = boundaries(histogram, settings.buckets)
    sizes = [0] * len(bounds)
    for length, n in histogram.items():
        sizes[bisect_left(bounds, length)] += n

    def by_bucket(values: list[int]) -> Column:
        chosen = F.lit(None).cast("long")
        for bound, value in reversed(list(zip(bounds, values, strict=True))):
            chosen = F.when(F.col("n_tokens") <= bound, F.lit(value).cast("long")).otherwise(chosen)
        return F.when(F.col("n_tokens") > 0, chosen)

    placed = ranked(
        cut.withColumn("bucket", by_bucket(list(range(len(bounds))))),
        F.col("bucket").asc_nulls_last(), F.xxhash64(F.lit(7), "doc_id", "piece"), F.col("doc_id"),
        F.col("piece"), F.col("n_tokens"))
    first = np.concatenate(([0], np.cumsum(sizes)))[:-1].tolist() if bounds else []
    slots = by_bucket([max(1, settings.batch_tokens // b) for b in bounds])
    place = F.col("rank") - by_bucket(first)
    return placed.select(
        "doc_id", "piece", "start", "n_tokens", "bucket", by_bucket(bounds).alias("padded_to"),
        F.floor(place / slots).alias("batch"), (place % slots).alias("slot"))
