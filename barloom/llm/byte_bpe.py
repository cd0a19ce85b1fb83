"""Byte-level BPE: texts to token ids and back, long texts in overlapping chunks.

A text is split into pre-tokens by a pattern and each pre-token is encoded by itself. A match of the
pattern depends on nothing before it, so two scans that share one boundary agree from there on. Long
texts are therefore cut into chunks that overlap and are scanned in parallel, each from its first
character as if it were a boundary. Where two neighbours first share a boundary, the earlier chunk
hands over to the later one; chunks that share none (a run longer than the overlap) become one span
and are scanned again. The pieces between the seams are encoded in parallel, too. Decoding
concatenates the bytes of the tokens.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm.common import shuffle_partitions, whole
from barloom.work import written

TOKENIZER = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
#: Fixed value: the published pattern of the vocabulary.
PATTERN = (
    r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
)
#: Code points of a chunk, and how many more of the next one it reads.
CHUNK = 1 << 15
OVERLAP = 1 << 10
#: A match that ends this far before the end of what was read can't be changed by what follows.
MARGIN = 8
#: Pre-tokens whose ids a task remembers.
KNOWN_PIECES = 200_000
#: Bytes of results that a task gathers before it hands them on.
GATHERED = 1 << 20
#: Code points that became letters or numbers after Unicode 16, which the vocabulary's
#: library counts as other symbols.
NEWER = (
    "0558 058b-058c 088f 0c5c 0cdc 208f 209d-209f a7ce-a7cf a7d2 a7d4 a7dd a7e2 a7f1 ab6c-ab6d "
    "107bb-107bf 10940-10959 10ec5-10ec7 10ed9-10eee 11b0a 11db0-11ddb 11de0-11de9 11df1 1246f "
    "12475-1247f 12550-12686 16ea0-16eb8 16ebb-16ed3 16ff2-16ff6 187f8-187ff 18cd6-18cda "
    "18d09-18d20 18d80-18df2 18e00-19191 191a0-191d2 1b123-1b128 1b168 1d6a6 1df1f-1df24 "
    "1df2b-1df81 1df90-1df96 1dfcd-1dfff 1e6c0-1e6de 1e6e0-1e6e2 1e6e4-1e6e5 1e6e7-1e6ed "
    "1e6f0-1e6f4 1e6fe-1e6ff 2b73a-2b73f 2b81e 2cea2-2cead 323b0-33479 3d000-3fc3f"
)

SPANS = (
    "key long, doc_id long, k int, start long, next long, stop long, text string, "
    "ends array<int>, head array<long>, tail array<long>"
)


def read_ranks(path: str) -> dict[bytes, int]:
    """The vocabulary: each token's bytes and its rank, which is its id."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


def splitter(pattern: str = PATTERN) -> Callable[[str], list[str]]:
    """A function that gives the pre-tokens of a text, which joined are the text."""
    find = regex.compile(pattern).findall
    ranges = "".join(
        "-".join(chr(int(end, 16)) for end in part.split("-")) for part in NEWER.split())
    newer = regex.compile(f"[{ranges}]")

    def split(text: str) -> list[str]:
        if text.isascii() or not newer.search(text):
            return find(text)
        # U+FFFD is another symbol for every library.
        ends = np.cumsum([len(piece) for piece in find(newer.sub("�", text))]).tolist()
        return [text[a:b] for a, b in zip([0, *ends], ends, strict=False)]

    return split


class Ids(dict):
    """The ids of each pre-token, as little-endian unsigned 32-bit integers."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        super().__init__()
        self.ranks = ranks
        # To this encoding every text is one pre-token.
        self.merged = tiktoken.Encoding(
            "pieces", pat_str=r"(?s:.)+", mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def __missing__(self, piece: str) -> bytes:
        rank = self.ranks.get(piece.encode())
        ids = np.array(self.merged(piece) if rank is None else [rank], "<u4").tobytes()
        if len(piece) <= 64:
            if len(self) >= KNOWN_PIECES:
                self.clear()
            self[piece] = ids
        return ids

    def of(self, pieces: Iterable[str]) -> bytes:
        return b"".join(map(self.__getitem__, pieces))


def gathered(results: Iterable[bytes]) -> Iterator[pa.Array]:
    """The results in order, in arrays of about `GATHERED` bytes: a batch has many times that."""
    held, size = [], 0
    for result in results:
        held.append(result)
        size += len(result)
        if size >= GATHERED:
            yield pa.array(held, pa.binary())
            held, size = [], 0
    if held:
        yield pa.array(held, pa.binary())


def encoded_texts(text: Column, tokenizer: str, pattern: str) -> Column:
    """The ids of whole texts, as binary. For texts of bounded length: Spark hands over 100 at once,
    which are far fewer than the rows of an Arrow batch."""
    tools = []

    @F.udf("binary", useArrow=False)
    def ids(whole_text: str) -> bytes:
        if not tools:  # once a task
            tools.extend((splitter(pattern), Ids(read_ranks(tokenizer))))
        split, known = tools
        return known.of(split(whole_text))

    # A string that is no UTF-8 would come changed.
    return ids(F.validate_utf8(text))


def _span(split, key, doc_id, k: int, start: int, nxt: int, stop: int, text: str) -> dict:
    """One span, scanned from its first character. `ends` count from there, the others from the
    beginning of the document."""
    ends = np.cumsum([len(piece) for piece in split(text)], dtype=np.int64)
    last = start + len(text) >= stop
    sure = start + (ends if last else ends[ends <= len(text) - MARGIN])
    first_new = min(OVERLAP, len(text))
    return {
        "key": key, "doc_id": doc_id, "k": k, "start": start, "next": nxt, "stop": stop,
        "text": text, "ends": ends.tolist(),
        "head": [start, *sure[sure <= start + first_new].tolist()],
        "tail": sure[sure >= nxt].tolist(),
    }


def _records(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, pa.schema([
        ("key", pa.int64()), ("doc_id", pa.int64()), ("k", pa.int32()), ("start", pa.int64()),
        ("next", pa.int64()), ("stop", pa.int64()), ("text", pa.string()),
        ("ends", pa.list_(pa.int32())), ("head", pa.list_(pa.int64())),
        ("tail", pa.list_(pa.int64()))]))


def _chunks(long: DataFrame, chunk: int) -> DataFrame:
    """(key, doc_id, k, start, next, stop, text) of each chunk of the texts; nothing scanned yet."""
    schema = pa.schema([
        ("key", pa.int64()), ("doc_id", pa.int64()), ("k", pa.int32()), ("start", pa.int64()),
        ("next", pa.int64()), ("stop", pa.int64()), ("text", pa.string())])

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                key, doc_id, text = (c[row].as_py() for c in batch.columns)
                for k, start in enumerate(range(0, len(text), chunk)):
                    nxt = min(start + chunk, len(text))
                    yield pa.RecordBatch.from_pylist([{
                        "key": key, "doc_id": doc_id, "k": k, "start": start, "next": nxt,
                        "stop": len(text), "text": text[start:nxt + OVERLAP]}], schema)

    return long.select("key", "doc_id", "text").mapInArrow(
        cut, SPANS.split(", ends")[0])


def _scanned(chunks: DataFrame, pattern: str) -> DataFrame:
    """Each chunk with its boundaries."""
    def scan(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = splitter(pattern)
        for batch in batches:
            for row in range(batch.num_rows):
                yield _records([_span(split, *(c[row].as_py() for c in batch.columns))])

    return chunks.mapInArrow(scan, SPANS)


def _seams(spans: DataFrame) -> DataFrame:
    """(key, k, seam): the first boundary that a span shares with the one before it; null if none.

    The first span of a document begins at 0. Only the overlaps' boundaries are looked at.
    """
    order = Window.partitionBy("key").orderBy("k")
    shared = F.array_min(F.array_intersect(F.lag("tail").over(order), "head"))
    return spans.select("key", "k", "head", "tail").select(
        "key", "k", F.when(F.col("k") == 0, F.lit(0).cast("long")).otherwise(shared).alias("seam"))


def _merged(spans: DataFrame, seams: DataFrame, pattern: str) -> DataFrame:
    """Spans without a seam joined to those before them, and scanned anew.

    Spans of one document come in order to one task, which holds the text of one joined span.
    """
    def join(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = splitter(pattern)
        held, texts, joined = None, [], False

        def out() -> pa.RecordBatch:
            return _records([_span(
                split, held["key"], held["doc_id"], held["k"], held["start"], held["next"],
                held["stop"], "".join(texts))] if joined else [{**held, "text": texts[0]}])

        for batch in batches:
            for at in range(batch.num_rows):  # as Python objects a batch is several times as large
                row = batch.slice(at, 1).to_pylist()[0]
                if row.pop("seam") is not None:
                    if held:
                        yield out()
                    held, texts, joined = row, [row["text"]], False
                else:
                    have = min(held["next"] + OVERLAP, held["stop"])
                    texts.append(row["text"][have - row["start"]:])
                    held["next"], joined = row["next"], True
        if held:
            yield out()

    ordered = spans.join(seams, ["key", "k"]).select(*spans.columns, "seam").repartition(
        shuffle_partitions(spans.sparkSession), "key").sortWithinPartitions("key", "k")
    return ordered.mapInArrow(join, SPANS)


def encoded_chunks(
    long: DataFrame, tokenizer: str, pattern: str, chunk: int,
) -> DataFrame:
    """(doc_id, ids) of each row of `long` (doc_id, text), encoded chunk by chunk."""
    @F.arrow_udf("binary")
    def ids(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        known = Ids(read_ranks(tokenizer))
        for batch in batches:
            yield from gathered(one(known, *(c[row] for c in batch)) for row in range(len(batch[0])))

    def one(known: Ids, text, ends, start, seam, stop) -> bytes:
        text, start = text.as_py(), start.as_py()
        a, b = seam.as_py() - start, stop.as_py() - start
        cuts = np.asarray(ends.values)
        cuts = [a, *cuts[(cuts > a) & (cuts <= b)].tolist()]
        return known.of(text[i:j] for i, j in zip(cuts, cuts[1:], strict=False))

    keyed = long.withColumn("key", F.monotonically_increasing_id())
    chunks = _chunks(keyed, chunk).repartition(shuffle_partitions(long.sparkSession), "key", "k")
    spans = written(_scanned(chunks, pattern), "spans")
    seams = written(_seams(spans), "seams")
    while not seams.where("seam is null").isEmpty():  # each turn leaves fewer spans
        spans = written(_merged(spans, seams, pattern), "spans")
        seams = written(_seams(spans), "seams")
    order = Window.partitionBy("key").orderBy("k")
    owned = seams.withColumn("until", F.lead("seam").over(order))
    pieces = spans.select("key", "doc_id", "k", "start", "stop", "text", "ends").join(
        owned, ["key", "k"])
    part = pieces.select(
        "key", "doc_id", "k",
        ids("text", "ends", "start", "seam", F.coalesce("until", "stop")).alias("ids"))
    # One group is one document.
    return part.groupBy("key", "doc_id").agg(
        F.expr("listagg(ids) within group (order by k)").alias("ids")).select("doc_id", "ids")


def encode(
    docs: DataFrame, tokenizer: str = TOKENIZER, pattern: str = PATTERN, chunk: int = CHUNK,
) -> DataFrame:
    """One row for each row of `docs`: doc_id, n_tokens, and ids (binary).

    `ids` holds the token ids as little-endian unsigned 32-bit integers, four bytes each; no special
    tokens are made or recognised. `docs` needs doc_id and text; nothing else is read. Null and
    empty texts have no ids. Repeated rows and ids stay rows of their own, and null ids stay null.
    An empty table gives an empty result. `tokenizer` is a path that every executor has. Of
    `pattern`, a match may depend on what it covers and `MARGIN` code points behind it, on nothing
    before it, and the matches must cover the text. Texts longer than `chunk` code points are cut.
    """
    if chunk <= OVERLAP:
        raise ValueError("a chunk has to be longer than the overlap")
    texts = docs.select(F.col("doc_id").cast("long"), whole("text").alias("text"))
    short = texts.where(F.length("text") <= chunk).select(
        "doc_id", encoded_texts(F.col("text"), tokenizer, pattern).alias("ids"))
    long = encoded_chunks(texts.where(F.length("text") > chunk), tokenizer, pattern, chunk)
    return short.unionByName(long).select(
        "doc_id", F.expr("octet_length(ids) div 4").cast("long").alias("n_tokens"), "ids")


def decode(encoded: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """`encoded` with `decoded` (binary): the bytes of the tokens in `ids`, one after the other.

    No ids, or null, give no bytes. An id that the vocabulary lacks is an error. A column named
    `decoded` is replaced.
    """
    @F.arrow_udf("binary")
    def bytes_of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        token = {rank: token for token, rank in read_ranks(tokenizer).items()}
        for rows in batches:
            yield from gathered(
                b"".join(map(token.__getitem__, np.frombuffer(r.as_py() or b"", "<u4").tolist()))
                for r in rows)

    return encoded.withColumn("decoded", bytes_of("ids"))
