"""Exact deduplication against immutable snapshots that static filters screen.

Documents arrive in batches. Each batch is grouped by itself; its distinct digests are screened by
the binary-fuse filters of every earlier snapshot, and only what a filter lets through is joined to
that snapshot's exact buckets, where whole normalised texts are compared. A batch then becomes a
snapshot itself: its distinct texts by digest, and its filters.

Copies are combined on the map side before any shuffle, so a text that a third of the rows share
arrives as one row a task. Joins with whole texts are merge joins at every size, and their key sides
bare tables, so heavy keys are split. Filters are built and asked for one shard of the digests at a time, and
their number grows with the snapshot; a batch that is larger than the snapshot asks in pieces.

`screen` holds a new batch against snapshots that `save` left in folders, in whatever session.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm.binary_fuse import build, may_contain
from barloom.llm.common import SPACE, free_names, matching_rows, whole
from barloom.sources import files
from barloom.work import written

Digest = Callable[[Column], Column]

#: Digests in one filter, on average.
SHARD_KEYS = 16_384
KEY = ["digest", "check"]


@dataclass(frozen=True)
class Snapshot:
    """Distinct texts (digest, check, body), and one filter (shard, filter) for each shard."""

    texts: DataFrame
    filters: DataFrame
    shards: int


def sha256(body: Column) -> Column:
    return F.sha2(body, 256)


def normalised(text: Column | str = "text") -> Column:
    return F.regexp_replace(whole(text), SPACE + "+", "")


def with_digests(docs: DataFrame, digest: Digest = sha256) -> DataFrame:
    """doc_id, body, its digest, a second hash of it, and the length of the original text."""
    return (
        docs.select("doc_id", normalised().alias("body"),
                    F.length(whole("text")).cast("long").alias("n_chars"))
        .withColumn("digest", digest(F.col("body")))
        .withColumn("check", F.xxhash64("body"))
    )


def distinct_texts(rows: DataFrame, name: str) -> DataFrame:
    """(digest, check, body) of each distinct text, written. Grouping is by the bytes themselves."""
    texts = written(rows.select(*KEY, "body").distinct(), name)
    clash = texts.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    if not clash.isEmpty():
        raise ValueError("two texts share both digests; choose another digest")
    return texts


def _shard(shards: int) -> Column:
    return F.pmod(F.xxhash64("digest"), F.lit(shards)).cast("int")


def seal(texts: DataFrame) -> Snapshot:
    """The snapshot of written distinct texts, with its filters built and written."""
    digests = texts.select("digest")
    shards = max(1, -(-digests.count() // SHARD_KEYS))

    def one(shard: tuple, keys: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"shard": [shard[0]], "filter": [build(keys["key"].to_numpy())]})

    keyed = digests.select(_shard(shards).alias("shard"), F.xxhash64(F.lit(1), "digest").alias("key"))
    filters = keyed.groupBy("shard").applyInPandas(one, "shard int, filter binary")
    return Snapshot(texts, written(filters, "filters"), shards)


def save(snapshot: Snapshot, folder: str) -> None:
    """Keeps a snapshot in `folder`. Snapshots don't change: one that is complete is an error."""
    spark = snapshot.texts.sparkSession
    if files.exists(spark, f"{folder}/filters/_SUCCESS"):
        raise FileExistsError(folder)
    snapshot.texts.write.mode("overwrite").parquet(f"{folder}/texts")
    # The filters come last: a folder without them is one that a writer left when it died.
    snapshot.filters.withColumn("shards", F.lit(snapshot.shards)).write.mode("overwrite").parquet(
        f"{folder}/filters")


def load(spark: SparkSession, folder: str) -> Snapshot:
    """The snapshot that `save` left in `folder`."""
    if not files.exists(spark, f"{folder}/filters/_SUCCESS"):
        raise FileNotFoundError(f"no complete snapshot in {folder}")
    filters = spark.read.parquet(f"{folder}/filters")
    one = filters.select("shards").first()
    return Snapshot(
        spark.read.parquet(f"{folder}/texts"), filters.drop("shards"), one["shards"] if one else 1)


def screened(digests: DataFrame, snapshot: Snapshot) -> DataFrame:
    """The rows of distinct, written `digests` that the snapshot's filters can't rule out."""
    columns = digests.columns
    pieces = max(1, round(digests.count() / (snapshot.shards * SHARD_KEYS)))

    def one(rows: pd.DataFrame, filters: pd.DataFrame) -> pd.DataFrame:
        if rows.empty or filters.empty:
            return rows[columns].iloc[:0]
        found = may_contain(filters["filter"].iloc[0], rows["_key"].to_numpy())
        return rows.loc[found, columns]

    keyed = digests.select(
        "*", _shard(snapshot.shards).alias("shard"), F.xxhash64(F.lit(1), "digest").alias("_key"))
    by, filters = ["shard"], snapshot.filters
    if pieces > 1:
        # The digests of a shard are more than a group should hold; each piece gets the filter.
        by = ["shard", "_piece"]
        keyed = keyed.withColumn("_piece", F.pmod(F.xxhash64(F.lit(2), "digest"), F.lit(pieces)))
        filters = filters.withColumn(
            "_piece", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(pieces - 1).cast("long"))))
    return keyed.groupBy(*by).cogroup(filters.groupBy(*by)).applyInPandas(one, digests.schema)


def _verified(texts: DataFrame, hits: DataFrame, snapshot: Snapshot) -> DataFrame:
    """The keys of those distinct `texts` among the `hits` that are byte for byte in the snapshot."""
    positive = texts.join(hits, KEY, "left_semi").alias("positive")
    bucket = snapshot.texts.hint("merge").alias("bucket")
    same = positive.join(bucket, F.col("positive.digest") == F.col("bucket.digest")).where(
        F.col("positive.body") == F.col("bucket.body"))
    return written(same.select("positive.digest", "positive.check"), "matched")


def screen(
    docs: DataFrame, snapshots: list[Snapshot], digest: Digest = sha256,
) -> tuple[DataFrame, Snapshot]:
    """A new batch against stored snapshots, and the snapshot of the texts that only it has.

    One row for each row of `docs`: doc_id, digest, n_chars, group_size (its copies within the
    batch, itself included), seen (a snapshot has the text) and kept (not seen, and the best row of
    its group; see `decisions`). The snapshots must have been made with the same digest. Null texts
    count as empty; an empty batch gives no rows and a snapshot without texts.
    """
    docs = docs.select("doc_id", "text")
    rows = written(
        with_digests(docs, digest).drop("body").withColumn("row", F.monotonically_increasing_id()),
        "digests")
    groups = written(_groups(rows), "groups")
    texts = distinct_texts(with_digests(docs, digest), "texts")
    keys = groups.select(*KEY)
    matched = [
        _verified(texts, written(screened(keys, s), "hits"), s) for s in snapshots]
    none = keys.where(F.lit(False))
    seen = written(reduce(DataFrame.unionAll, matched, none).distinct(), "seen")
    fresh = written(texts.join(seen.hint("merge"), KEY, "left_anti"), "fresh")
    marked = groups.join(seen.withColumn("seen", F.lit(True)), KEY, "left")
    found = rows.join(marked, KEY).select(
        "doc_id", "digest", "n_chars", F.col("size").alias("group_size"),
        F.coalesce("seen", F.lit(False)).alias("seen"),
        (F.col("seen").isNull() & (F.col("row") == F.col("best.row"))).alias("kept"),
    )
    return found, seal(fresh)


def _groups(rows: DataFrame) -> DataFrame:
    """Size and best row of each digest: most code points, then smallest id, then first read."""
    return rows.groupBy(*KEY).agg(
        F.count(F.lit(1)).alias("size"),
        F.min(F.struct((-F.col("n_chars")).alias("less"), F.col("doc_id").isNull().alias("null_id"),
                       "doc_id", "row")).alias("best"))


def decisions(docs: DataFrame, batches: int = 2, digest: Digest = sha256) -> DataFrame:
    """One row for each row of `docs`: doc_id, digest, n_chars, keep_id, group_size and kept.

    `docs` needs doc_id and text; nothing else is read. Null texts count as empty, and all empty
    texts are equal. In each group of equal texts one row is kept: the one with most code points,
    then with the smallest doc_id (null ids last); of rows alike in both, one. An empty table gives
    an empty result. Batches are dealt by the hash of doc_id; the result doesn't depend on them.
    """
    docs = docs.select("doc_id", "text")
    batch = F.pmod(F.xxhash64(F.lit(5), "doc_id"), F.lit(batches)).cast("int")
    rows = written(
        with_digests(docs, digest).drop("body").withColumn("batch", batch)
        .withColumn("row", F.monotonically_increasing_id()), "digests")

    snapshots: list[Snapshot] = []
    matched: list[DataFrame] = []
    groups = [written(_groups(rows.where(F.col("batch") == b)), "groups") for b in range(batches)]
    for b in range(batches):
        arriving = with_digests(docs.where(batch == b), digest)
        distinct = groups[b].select(*KEY)
        hits = [written(screened(distinct, s), "hits") for s in snapshots]
        last = b + 1 == batches
        if last:
            # It needs no snapshot, so only the texts that may have a copy are looked at.
            repeated = groups[b].where("size > 1").select(*KEY)
            wanted = written(reduce(DataFrame.unionAll, [repeated, *hits]).distinct(), "suspects")
            arriving = written(arriving.join(wanted.hint("merge"), KEY, "left_semi"), "arriving")
        texts = distinct_texts(arriving, "texts")
        for hit, snapshot in zip(hits, snapshots, strict=True):
            matched.append(_verified(texts, hit, snapshot))
        if not last:
            snapshots.append(seal(texts))

    parts = [g.where("size > 1") for g in groups]
    if matched:
        across = written(reduce(DataFrame.unionAll, matched).distinct(), "across")
        parts = [g.join(across, KEY, "left_anti").where("size > 1") for g in groups]
        parts += [g.join(across, KEY, "left_semi") for g in groups]
    classes = written(
        reduce(DataFrame.unionAll, parts).groupBy(*KEY)
        .agg(F.sum("size").alias("size"), F.min("best").alias("best")), "classes")
    return rows.join(classes, KEY, "left").select(
        "doc_id", "digest", "n_chars",
        F.when(F.col("size").isNull(), F.col("doc_id")).otherwise(F.col("best.doc_id")).alias(
            "keep_id"),
        F.coalesce("size", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce(F.col("row") == F.col("best.row"), F.lit(True)).alias("kept"),
    )


def drop_copies(docs: DataFrame, batches: int = 2) -> DataFrame:
    """The rows of `docs`, unchanged, that `decisions` keeps."""
    chosen = decisions(docs, batches).groupBy("doc_id", "digest", "n_chars").agg(
        F.count(F.lit(1)).alias("n_rows"), F.bool_or("kept").alias("kept"))
    key, length = free_names(docs, "_digest", "_n_chars")
    keys = chosen.where("kept").select(
        F.col("doc_id"), F.col("digest").alias(key), F.col("n_chars").alias(length), "n_rows")
    marked = docs.withColumn(key, sha256(normalised())).withColumn(
        length, F.length(whole("text")).cast("long"))
    return matching_rows(marked, keys, ["doc_id", key, length]).drop(key, length)
