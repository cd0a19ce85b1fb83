"""Expressions and helpers that the corpus operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barloom.work import written

#: White space that separates words; a word is a run of other characters.
SPACE = r"[\x20\x09-\x0D]"


def whole(text: Column | str) -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def words_of(text: Column | str) -> Column:
    """The words of a text in order; none for null."""
    return F.array_remove(F.split(whole(text), SPACE + "+"), "")


def word_count(text: Column | str) -> Column:
    return F.size(words_of(text)).cast("long")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once, however often and wherever the body uses it.

    A column that lambdas refer to would be copied into them, and computed for every element, once
    the planner merges projections or pushes a filter down.
    """
    return F.get(F.transform(F.array(value), body), 0)


def free_names(docs: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores added as it takes to differ from the columns."""
    taken, out = {c.lower() for c in docs.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def id_remainder(doc_id: Column | str, modulus: int) -> Column:
    """crc32 of the id's text, modulo `modulus`; -1 for a null id."""
    doc_id = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(doc_id.cast("string")) % modulus, F.lit(-1))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@contextmanager
def same_splits(spark: SparkSession) -> Iterator[None]:
    """Within it files are split alike at every read, even if executors come or go meanwhile.

    Spark sizes splits by the cores there are, unless the least number of partitions is set.
    """
    name = "spark.sql.files.minPartitionNum"
    before = spark.conf.get(name, None)
    spark.conf.set(name, before or str(spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def bounded_sample(rows: DataFrame, key: str, at_most: int, seed: int) -> DataFrame:
    """At most `at_most` rows, those with the smallest hash of their key: the same at every run."""
    return rows.orderBy(F.xxhash64(F.lit(seed), F.col(key)), F.col(key)).limit(at_most)


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, learn: Column, at_most: int, seed: int,
) -> DataFrame:
    """(doc_id, text, label) of at most `at_most` labelled documents for which `learn` holds.

    `learn` is a condition on doc_id. Several labels of one document count as the largest; a null
    label is none. The sample is drawn from the labels before any text is read, and its ids, no
    more than `at_most`, are broadcast: no text is shuffled to find it. Of several rows of one
    doc_id the smallest text counts, so the bound holds for rows as well.
    """
    marked = (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & learn)
        .groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    )
    chosen = written(bounded_sample(marked, "doc_id", at_most, seed), "sample")
    texts = docs.select("doc_id", "text")
    found = texts.join(F.broadcast(chosen), "doc_id")
    return found.groupBy("doc_id", "label").agg(F.min("text").alias("text"))


def fitted(rows: DataFrame, fit: Callable[[Iterator[pa.RecordBatch]], bytes]) -> bytes:
    """`fit` applied to a bounded sample in one task; its model comes back as bytes.

    The task can be run again anywhere, and the driver holds the model only.
    """
    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_pydict({"model": pa.array([fit(iter(batches))], pa.binary())})

    got = rows.repartition(1).mapInArrow(task, "model binary").collect()
    return bytes(got[0][0]) if got else fit(iter(()))


def lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The values of a list column, end to end, and where each row begins (one more than rows)."""
    offsets = np.asarray(column.offsets)
    values = column.values.to_numpy(zero_copy_only=False)
    return values[offsets[0]:offsets[-1]], offsets - offsets[0]


def chunks(starts: np.ndarray, at_most: int) -> Iterator[tuple[int, int]]:
    """Row ranges [a, b) that hold at most `at_most` values each, or else one row."""
    a, n = 0, len(starts) - 1
    while a < n:
        b = int(np.searchsorted(starts, starts[a] + at_most, side="right")) - 1
        b = min(max(b, a + 1), n)
        yield a, b
        a = b


def segment_sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums of values[starts[i]:starts[i+1]], 0 for empty ranges; works along axis 0."""
    out = np.zeros((len(starts) - 1, *values.shape[1:]), np.float64)
    full = np.flatnonzero(np.diff(starts) > 0)
    if len(full):
        out[full] = np.add.reduceat(values, starts[full], axis=0, dtype=np.float64)
    return out


def ranked(df: DataFrame, *order: Column, name: str = "rank") -> DataFrame:
    """`df` with its global position (from 0) in the given order, without one task for all rows.

    Rows are dealt by ranges of the order, so a value that a third of the rows share is spread as
    far as the later columns differ; a row number breaks the remaining ties, so even identical rows
    spread. Only one count for each partition meets in a window. `df` should be cheap to read, as
    the range bounds are sampled from it: pass a written table.
    """
    tied = df.withColumn("_tie", F.monotonically_increasing_id())
    order = (*order, F.col("_tie"))
    placed = written(
        tied.repartitionByRange(shuffle_partitions(df.sparkSession), *order)
        .sortWithinPartitions(*order).drop("_tie")
        .withColumn("_at", F.monotonically_increasing_id()),
        "ranked",
    )
    # monotonically_increasing_id() is the partition, shifted by 33 bits, plus the row's place in it.
    part = F.shiftright("_at", 33)
    counts = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.sum("_n").over(before).alias("_before"))
    return (
        placed.withColumn("_part", part).join(F.broadcast(offsets), "_part")  # a row a partition
        .withColumn(name, F.coalesce("_before", F.lit(0)) + F.col("_at").bitwiseAND((1 << 33) - 1))
        .drop("_part", "_before", "_at")
    )


def matching_rows(docs: DataFrame, chosen: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of `docs` whose keys are among `chosen`, one row for each.

    `chosen` has each combination of keys once, and `n_rows`, the rows of `docs` that have it. Nulls
    match nulls. It grows with `docs`, so the join is a merge join at every size. Only where `n_rows` is above 1 do rows of `docs` have to be told apart, and any of
    them is taken.
    """
    once = written(chosen.select(*keys, "n_rows"), "chosen")
    on = [docs[k].eqNullSafe(once[k]) for k in keys]
    if once.where("n_rows > 1").isEmpty():
        return docs.join(once.hint("merge"), on, "left_semi")
    single = once.where("n_rows = 1").hint("merge")
    several = once.where("n_rows > 1").hint("merge")
    taken = docs.join(several, [docs[k].eqNullSafe(several[k]) for k in keys], "left_semi")
    rest = docs.join(single, [docs[k].eqNullSafe(single[k]) for k in keys], "left_semi")
    return rest.unionByName(taken.dropDuplicates(keys))
