"""Token counts of flat token files: a vectorised scan for separators, stitched across blocks.

A flat file is nothing but token ids, two bytes each, little-endian, every document closed by the
end-of-document id; there is no index. Files are read in blocks of fixed size, which cut documents
anywhere. numpy finds the separators of each block; what a block must know of those before it, how
many documents ended and where the last one did, comes from a prefix scan over one row a block.
Everything else is a difference of neighbouring positions.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barloom.llm.common import same_splits, whole
from barloom.work import written

#: End of a document (</s>) in the vocabulary below.
END = 2
TOKENIZER = "/opt/tokenizers/piece_bpe_32k.model"
BLOCK_TOKENS = 1 << 19
FILE_DOCS = 20_000
#: Bytes of a flat file at most: a task reads a file as one value, which can't be larger.
FILE_BYTES = (1 << 31) - 16
#: Texts tokenised by one call.
TEXTS = 64


def write_flat(docs: DataFrame, folder: str, tokenizer: str = TOKENIZER, end: int = END) -> None:
    """Flat token files of the texts of `docs`, one document a row, in the order of its rows.

    Spark's text writer writes each row's ids as they are and the separator as the end of line, so
    any file system Spark knows will do; the separator's bytes must be ASCII. Null texts and texts
    without tokens are lone separators. `tokenizer` is a path that every executor has.
    """
    separator = np.array([end], "<u2").tobytes().decode("ascii")

    @F.arrow_udf("binary")
    def ids(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = sentencepiece.SentencePieceProcessor(model_file=tokenizer)
        for batch in batches:
            out = []
            for i in range(0, len(batch), TEXTS):
                found = model.encode(batch.slice(i, TEXTS).to_pylist(), num_threads=1)
                out += [np.array(f, "<u2").tobytes() for f in found]
            yield pa.array(out, pa.binary())

    lines = docs.select(ids(whole("text")).cast("string").alias("value"))
    lines.write.option("lineSep", separator).option("maxRecordsPerFile", FILE_DOCS).text(folder)


def separators(
    spark: SparkSession, folder: str, end: int = END, block_tokens: int = BLOCK_TOKENS,
) -> DataFrame:
    """(file, block, blocks, tokens, ends) of each block: its length and its separators' places.

    Every file of the folder is a flat file, but those that begin with _ or a dot. One of more than
    FILE_BYTES is an error, which is raised before any is read.
    """
    files = spark.read.format("binaryFile").load(folder)
    large = files.where(F.col("length") > FILE_BYTES).select("path", "length").first()
    if large:
        raise ValueError(f"{large['path']} has {large['length']} bytes; split files of over {FILE_BYTES}")
    size = 2 * block_tokens
    blocks = files.withColumn(
        "blocks", F.greatest(F.ceil(F.col("length") / size), F.lit(1)).cast("long")
    ).withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))

    content = F.substring("content", (F.col("block") * size + 1).cast("int"), F.lit(size))
    cut = blocks.select(
        F.col("path").alias("file"), "block", "blocks",
        F.floor(F.least(F.lit(size), F.col("length") - F.col("block") * size) / 2).alias("tokens"),
        content.alias("content"))

    def places(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [
                np.flatnonzero(np.frombuffer(c.as_buffer(), "<u2", len(c.as_buffer()) // 2) == end)
                for c in batch.column("content")]
            offsets = np.concatenate(([0], np.cumsum([len(f) for f in found]))).astype(np.int32)
            values = np.concatenate([*found, np.empty(0, np.int64)]).astype(np.int32)
            ends = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))
            columns = [batch.column(c) for c in ("file", "block", "blocks", "tokens")]
            yield pa.RecordBatch.from_arrays([*columns, ends], [*batch.schema.names[:4], "ends"])

    # Rows that reach Python hold one block each; a column function would keep whole files beside.
    return cut.mapInArrow(
        places, "file string, block long, blocks long, tokens long, ends array<int>")


def count_tokens(scanned: DataFrame, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """(file, doc, start, n_tokens, closed): the documents of each file, numbered from 0.

    `scanned` is what `separators` found. Two separators in a row enclose an empty document. What
    follows a file's last separator, if anything, is a document that isn't closed; a trailing odd
    byte is no token. Blocks without a separator add to the document that spans them.
    """
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    base = F.col("block") * block_tokens
    last = F.when(F.size("ends") > 0, base + F.element_at("ends", -1))
    known = (
        scanned.withColumn("before", F.coalesce(F.sum(F.size("ends")).over(earlier), F.lit(0)))
        .withColumn("after", F.coalesce(F.max(last).over(earlier) + 1, F.lit(0)))
    )

    def document(number, start, end, closed):
        return F.struct(number.cast("long").alias("doc"), start.cast("long").alias("start"),
                        (end - start).cast("long").alias("n_tokens"), F.lit(closed).alias("closed"))

    ended = F.transform("ends", lambda p, i: document(
        F.col("before") + i,
        F.when(i == 0, F.col("after")).otherwise(base + F.get("ends", i - 1) + 1), base + p, True))
    open_at = F.coalesce(last + 1, F.col("after"))
    left = F.when(
        (F.col("block") == F.col("blocks") - 1) & (base + F.col("tokens") > open_at),
        F.array(document(F.col("before") + F.size("ends"), open_at, base + F.col("tokens"), False)),
    ).otherwise(F.slice(ended, 1, 0))
    return known.select("file", F.inline(F.concat(ended, left)))


def places_of(file: str) -> dict[str, Column]:
    """The task that wrote a flat file, and where among its rows document `doc` of the file was.

    Files are named part-<task>-<uuid>-c<file of the task>.txt.
    """
    number = F.regexp_extract(file, r"-c(\d+)\.[^/]*$", 1).cast("long")
    return {
        "part": F.regexp_extract(file, r"/part-(\d+)-[^/]*$", 1).cast("int"),
        "place": number * FILE_DOCS + F.col("doc"),
    }


def token_counts(docs: DataFrame, folder: str, tokenizer: str = TOKENIZER) -> DataFrame:
    """(doc_id, file, doc, start, n_tokens, closed) of each row of `docs`, by way of flat files.

    The files are written to `folder` and scanned; as they know no ids, those are given back by
    place. So `docs` must be a plain scan, read in the same order twice. Both reads have the same
    splits, whatever executors there are; if files change between them, in what places there are,
    the run fails rather than pair wrongly.
    """
    spark = docs.sparkSession
    with same_splits(spark):
        write_flat(docs, folder, tokenizer)
        ids = written(docs.select(
            "doc_id", F.spark_partition_id().alias("part"),
            F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("place")), "ids")
    found = count_tokens(written(separators(spark, folder), "separators"))
    found = written(found.withColumns(places_of("file")), "found")
    places = ["part", "place"]
    apart = found.select(places).exceptAll(ids.select(places))
    if not apart.isEmpty() or found.count() != ids.count():
        raise RuntimeError("the documents changed before their ids were read; run again")
    return found.join(ids, ["part", "place"]).select(
        "doc_id", F.element_at(F.split("file", "/"), -1).alias("file"), "doc", "start", "n_tokens",
        "closed")
