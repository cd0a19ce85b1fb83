"""Byte-level BPE against the tokenizer library, chunks of all kinds, and back again."""

from __future__ import annotations

import random

import numpy as np
import pytest
import tiktoken

from barloom.llm import byte_bpe as bpe


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding(
        "own", pat_str=bpe.PATTERN, mergeable_ranks=bpe.read_ranks(bpe.TOKENIZER),
        special_tokens={})


def ids(row):
    return np.frombuffer(row["ids"], "<u4").tolist()


def check(docs, library, **options):
    """Every row against the library, and decoded to its bytes."""
    rows = bpe.decode(bpe.encode(docs, **options)).collect()
    texts = sorted((r["doc_id"] is None, r["doc_id"], r["text"] or "") for r in docs.collect())
    found = sorted((r["doc_id"] is None, r["doc_id"], bytes(r["decoded"]).decode()) for r in rows)
    assert [t for t in texts if not t[0]] == [f for f in found if not f[0]]
    assert sorted(t[2] for t in texts) == sorted(f[2] for f in found)
    for r in rows:
        assert r["n_tokens"] == len(r["ids"]) / 4
        assert ids(r) == library.encode_ordinary(bytes(r["decoded"]).decode())


@pytest.mark.parametrize("chunk", [bpe.CHUNK, 1500])
def test_odd_rows(odd, none, library, chunk):
    check(odd, library, chunk=chunk)
    check(odd.withColumnRenamed("score", "ids").withColumnRenamed("rank", "key"), library)
    assert bpe.decode(bpe.encode(none)).count() == 0


def test_given_documents(real, library):
    check(real("documents"), library, chunk=1200)


def test_runs_longer_than_the_overlap(spark, library, monkeypatch):
    """Without a shared boundary chunks are joined; many seams lie within one run."""
    monkeypatch.setattr(bpe, "OVERLAP", 16)
    rng = random.Random(7)
    parts = ["it's we'll 'll ' 's", " ", "\n\n  \t", "x" * 200, "7" * 90, "  " * 60, "!?" * 45,
             "日本語" * 30, "é", "a b", "'", " ", "word "]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.randint(1, 40)))) for i in range(60)]
    rows += [(90, "x" * 5000), (91, " " * 3000 + "x"), (92, ("y" * 40 + " ") * 50), (92, "y" * 41)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for chunk in (17, 40, 64):
        check(docs, library, chunk=chunk)


def test_every_code_point_is_split_as_by_the_library(library):
    """Tokens of one byte pair show what is in one pre-token."""
    ranks = {bytes([i]): i for i in range(256)}
    for pair in [bytes([b, x]) for b in range(256) for x in b"a1."]:
        ranks[pair] = len(ranks)
    probe = tiktoken.Encoding(
        "probe", pat_str=bpe.PATTERN, mergeable_ranks=ranks, special_tokens={})
    known, split = bpe.Ids(ranks), bpe.splitter()
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for i in range(0, len(points), 1 << 14):
        text = "".join(f"{c}a {c}1 {c}. " for c in points[i:i + (1 << 14)])
        got = np.frombuffer(known.of(split(text)), "<u4").tolist()
        assert got == probe.encode_ordinary(text)


def test_memory_of_pieces_is_bounded(library, monkeypatch):
    monkeypatch.setattr(bpe, "KNOWN_PIECES", 5)
    known = bpe.Ids(bpe.read_ranks(bpe.TOKENIZER))
    text = "one two three four five six seven eight nine ten " * 3
    assert np.frombuffer(known.of(bpe.splitter()(text)), "<u4").tolist() == library.encode_ordinary(text)
    assert len(known) <= 5


def test_results_are_handed_on_in_small_arrays(spark, library, monkeypatch):
    """Whole batches of results would take an executor's memory: 5 MB here, in one partition."""
    import pyarrow

    class Small:
        def __getattr__(self, name):
            return getattr(pyarrow, name)

        def array(self, *given):
            made = pyarrow.array(*given)
            assert made.nbytes < 2 << 20
            return made

    monkeypatch.setattr(bpe, "pa", Small())
    docs = spark.range(0, 500, 1, 1).selectExpr(
        "id as doc_id", "repeat('word \U0001f600' || id || '\0 ', if(id < 470, 800, 5000)) as text")
    check(docs, library)
    assert [len(a) for a in bpe.gathered(bytes([i]) * (1 << 19) for i in range(5))] == [2, 2, 1]
    assert [len(a) for a in bpe.gathered([b"", b"x" * (1 << 20), b""])] == [2, 1]
    assert list(bpe.gathered([])) == []


def test_texts_that_are_no_utf8_are_an_error(spark):
    for times in (1, bpe.CHUNK + 1):
        bad = spark.sql(f"select 1 as doc_id, cast(unhex(repeat('ff', {times})) as string) as text")
        with pytest.raises(Exception, match="(?i)utf-?8"):
            bpe.encode(bad).collect()


def test_errors(spark):
    with pytest.raises(ValueError):
        bpe.encode(spark.createDataFrame([(1, "a")], "doc_id long, text string"), chunk=bpe.OVERLAP)
    bad = spark.createDataFrame([(1, bytearray(b"\xff\xff\xff\xff"))], "doc_id long, ids binary")
    with pytest.raises(Exception, match="KeyError"):
        bpe.decode(bad).collect()
