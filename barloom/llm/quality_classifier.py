"""Quality classifier: logistic regression on hashed word n-grams, trained with FTRL updates.

Spark cuts texts into words and hashes them. The features of a document are its words, its word
pairs, the shapes of its words (letters and digits told apart by kind only, so `KRAM!!` and `FOO!!`
look alike), and the shapes of its pairs, which also tell whether both words are the same. Each is
one hashed n-gram; its value is its count over the square root of the number of words. Weights are
learnt from a bounded sample of labelled documents in one task. Scoring a text is one sparse dot
product, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import (
    chunks,
    fitted,
    free_names,
    id_remainder,
    labelled_sample,
    lists,
    segment_sums,
    whole,
    words_of,
)
from barloom.llm.ftrl import Ftrl, sigmoid


@dataclass(frozen=True)
class Settings:
    buckets: int = 1 << 18
    #: Bound of the labelled sample.
    max_train: int = 12_000
    epochs: int = 3
    alpha: float = 0.3
    l1: float = 0.05
    l2: float = 0.5
    seed: int = 11
    #: Scores from here on predict label 1.
    threshold: float = 0.3


SETTINGS = Settings()

#: Words hashed by one numpy step at most, or else one document.
STEP = 100_000


def hashed_words(text: Column | str) -> Column:
    """32-bit hashes of the words of a text."""
    return F.transform(words_of(text), lambda w: F.hash(w))


def hashed_shapes(text: Column | str) -> Column:
    """32-bit hashes of the words' shapes: runs of upper-case, other letters and digits shortened."""
    shape = whole(text)
    for kind, sign in ((r"\p{Lu}{2,}", "AA"), (r"\p{Lu}", "A"), (r"[\p{L}&&[^\p{Lu}]]+", "a"),
                       (r"\p{Nd}+", "0")):
        shape = F.regexp_replace(shape, kind, sign)
    return F.transform(words_of(shape), lambda w: F.hash(w))


def _mix(h: np.ndarray, salt: int, buckets: int) -> np.ndarray:
    h = (h + np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return ((h >> np.uint64(32)) % np.uint64(buckets)).astype(np.int32)


def features(
    words: np.ndarray, shapes: np.ndarray, starts: np.ndarray, buckets: int,
) -> tuple[np.ndarray, np.ndarray]:
    """Feature cells of documents laid end to end, and where each document's cells begin.

    A document of n words has 4 n cells: its words, its shapes, and for every word the pair with
    its successor (the last word pairs with nothing) twice, as words and as shapes.
    """
    w, s = words.astype(np.uint64), shapes.astype(np.uint64)
    last = np.zeros(len(w), bool)
    last[starts[1:][np.diff(starts) > 0] - 1] = True
    after_w, after_s = np.roll(w, -1), np.roll(s, -1)
    after_w[last] = after_s[last] = np.uint64(0x5851F42D)
    same = (w == after_w) & ~last
    odd = np.uint64(0xD1342543DE82EF95)
    cells = np.stack([
        _mix(w, 1, buckets), _mix(s, 2, buckets), _mix(w * odd + after_w, 3, buckets),
        _mix((s * odd + after_s) * np.uint64(2) + same, 4, buckets),
    ], axis=1).reshape(-1)
    return cells, starts * 4


def _value(starts: np.ndarray) -> np.ndarray:
    """What one occurrence of an n-gram counts in each document."""
    return 1.0 / np.sqrt(np.maximum(np.diff(starts), 1))


def fit(batches: Iterator[pa.RecordBatch], settings: Settings) -> bytes:
    """Weights, the last of them the intercept, from batches of (label, words, shapes)."""
    size = settings.buckets
    cells, values, labels, lengths = [], [], [], []
    for batch in batches:
        words, starts = lists(batch.column("words"))
        shapes, _ = lists(batch.column("shapes"))
        labels += batch.column("label").to_pylist()
        for a, b in chunks(starts, STEP):
            part, own = slice(starts[a], starts[b]), starts[a:b + 1] - starts[a]
            found, at = features(words[part], shapes[part], own, size)
            row = np.repeat(np.arange(b - a), np.diff(at))
            distinct, n = np.unique(row * size + found, return_counts=True)
            row = distinct // size
            cells.append((distinct % size).astype(np.int32))
            values.append((n * _value(own)[row]).astype("f4"))
            lengths.append(np.bincount(row, minlength=b - a))
    # A few large arrays: memory that goes back to the system with them.
    cells = np.concatenate([np.empty(0, np.int32), *cells])
    values = np.concatenate([np.empty(0, "f4"), *values])
    ends = np.cumsum(np.concatenate([np.zeros(1, np.int64), *lengths]))

    def document(i: int) -> tuple[np.ndarray, np.ndarray]:
        own = slice(ends[i], ends[i + 1])
        return np.append(cells[own], np.int32(size)), np.append(values[own], np.float32(1))

    model = Ftrl((size + 1,), alpha=settings.alpha, l1=settings.l1, l2=settings.l2)
    rng = np.random.default_rng(settings.seed)
    # A fixed order first, as batches arrive in any.
    order = np.array(sorted(range(len(labels)), key=lambda i: (
        labels[i], ends[i + 1] - ends[i], crc32(cells[ends[i]:ends[i + 1]]),
        crc32(values[ends[i]:ends[i + 1]]))), np.int64)
    for _ in range(settings.epochs):
        for i in rng.permutation(order):
            at, value = document(i)
            w = model.weights(at)
            model.update(at, (sigmoid(w @ value) - labels[i]) * value, w)
    return model.weights().astype("<f4").tobytes()


def learn(
    docs: DataFrame, labels: DataFrame, label: str = "quality", settings: Settings = SETTINGS,
    learn_from: Column | None = None,
) -> np.ndarray:
    """Weights learnt from labelled documents; `learn_from` restricts doc_id.

    Without labelled documents all weights are 0 and every score is 0.5.
    """
    condition = F.lit(True) if learn_from is None else learn_from
    sample = labelled_sample(docs, labels, label, condition, settings.max_train, settings.seed)
    rows = sample.select(
        "label", hashed_words("text").alias("words"), hashed_shapes("text").alias("shapes"))
    return np.frombuffer(fitted(rows, lambda batches: fit(batches, settings)), "<f4")


def scores(weights: np.ndarray, words: pa.Array, shapes: pa.Array) -> np.ndarray:
    w, starts = lists(words)
    s, _ = lists(shapes)
    out = np.empty(len(starts) - 1)
    for a, b in chunks(starts, STEP):
        own = starts[a:b + 1] - starts[a]
        part = slice(starts[a], starts[b])
        cells, at = features(w[part], s[part], own, len(weights) - 1)
        out[a:b] = segment_sums(weights[cells], at) * _value(own) + weights[-1]
    return sigmoid(out)


def score(docs: DataFrame, weights: np.ndarray, out: str = "score") -> DataFrame:
    """Every row of `docs` with the probability of label 1; a column named `out` is replaced.

    The score depends on the text alone. Null and empty texts get the intercept's. Other columns
    don't pass through Python.
    """
    @F.arrow_udf("double")
    def scored(words: pa.Array, shapes: pa.Array) -> pa.Array:
        return pa.array(scores(weights, words, shapes), pa.float64())

    return docs.withColumn(out, scored.asNondeterministic()(hashed_words("text"), hashed_shapes("text")))


def held_out(doc_id: str = "doc_id") -> Column:
    return id_remainder(doc_id, 5) == 0


def quality_classifier(
    docs: DataFrame, labels: DataFrame, settings: Settings = SETTINGS,
) -> DataFrame:
    """`docs` with score, predicted and held_out, learnt from documents that aren't held out.

    Columns of these names are replaced. Rows of a repeated doc_id are scored one by one; several
    labels of a document count as the largest.
    """
    weights = learn(docs, labels, "quality", settings, ~held_out())
    return (
        score(docs, weights)
        .withColumn("predicted", (F.col("score") >= settings.threshold).cast("int"))
        .withColumn("held_out", held_out())
    )


def drop_rejected(
    docs: DataFrame, labels: DataFrame, settings: Settings = SETTINGS,
) -> DataFrame:
    """The rows of `docs`, unchanged, whose text the classifier predicts to be of label 1."""
    weights = learn(docs, labels, "quality", settings, ~held_out())
    (name,) = free_names(docs, "_score")
    scored = score(docs, weights, name)
    return scored.where(F.col(name) >= settings.threshold).drop(name)
