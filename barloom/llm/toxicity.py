"""Toxicity: a convolutional text classifier on hashed word embeddings.

Words (runs of letters, lower-cased) are hashed by Spark; a word's embedding is the sum of those of
its own cell and of the cell of its first letters, so unseen inflections resemble seen ones. Filters
of several widths slide over the embeddings, each keeps its maximum over the text, and a logistic
unit weighs the maxima. numpy trains it on a bounded sample in one task: the gradient of a maximum
reaches only the window that attained it. Part of the sample is left for calibration: a shift that
puts the best common cut at `threshold`, and cuts for each language beside it. Scoring needs no
shuffle and reads nothing but the text.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import chunks, fitted, id_remainder, labelled_sample, lists, whole
from barloom.llm.ftrl import sigmoid


@dataclass(frozen=True)
class Settings:
    buckets: int = 1 << 17
    dim: int = 8
    widths: tuple[int, ...] = (1, 2, 3)
    filters: int = 8
    #: Letters of a word that its second cell is hashed from.
    prefix: int = 5
    #: Bound of the labelled sample.
    max_train: int = 12_000
    calibrate_share: float = 0.2
    epochs: int = 6
    batch: int = 32
    rate: float = 0.1
    seed: int = 7
    #: Scores from here on are toxic.
    threshold: float = 0.7
    #: A language with fewer toxic calibration documents shares the common cut.
    min_positives: int = 10


SETTINGS = Settings()

#: Words convolved by one numpy step at most, or else one document.
STEP = 100_000


def hashed(text: Column | str, prefix: int) -> list[Column]:
    """Hashes of a text's words and of their first letters, as non-negative ints."""
    words = F.array_remove(F.split(F.lower(whole(text)), r"\P{L}+"), "")
    mask = (1 << 31) - 1
    return [
        F.transform(words, lambda w: F.hash(w).bitwiseAND(mask)),
        F.transform(words, lambda w: F.hash(F.lit("<"), F.substring(w, 1, prefix)).bitwiseAND(mask)),
    ]


class Network:
    """Parameters as plain arrays; cell `buckets` is padding and stays zero."""

    def __init__(self, settings: Settings) -> None:
        rng = np.random.default_rng(settings.seed)
        self.widths, self.buckets = settings.widths, settings.buckets
        f, d = settings.filters, settings.dim
        self.table = rng.normal(0, 0.05, (settings.buckets + 1, d)).astype("f4")
        self.table[-1] = 0
        self.kernels = [rng.normal(0, 0.2, (w, d, f)).astype("f4") for w in self.widths]
        self.bias = [np.zeros(f, "f4") for _ in self.widths]
        self.out = np.full(f * len(self.widths), 0.3, "f4")
        self.shift = np.float32(0)
        self.cut = 0.0  # logit at which the classes part best
        self.cuts: dict[str, float] = {}

    def layout(self, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Where each word goes, where each document begins, and the size, with padding between.

        A document takes at least one place, and is followed by as much padding as the widest
        filter reaches beyond it.
        """
        n = np.diff(starts)
        room = np.maximum(n, 1) + max(self.widths) - 1
        begin = np.concatenate(([0], np.cumsum(room)))
        place = np.arange(starts[-1]) + np.repeat(begin[:-1] - starts[:-1], n)
        return place, begin[:-1], int(begin[-1])

    def embed(self, words: np.ndarray, prefixes: np.ndarray, starts: np.ndarray):
        place, begin, size = self.layout(starts)
        cells = np.full((size, 2), self.buckets, np.int32)
        cells[place, 0] = words % self.buckets
        cells[place, 1] = prefixes % self.buckets
        return cells, begin, self.table[cells[:, 0]] + self.table[cells[:, 1]]

    def maxima(self, embedded: np.ndarray, begin: np.ndarray, last: np.ndarray):
        """Per width, filter responses and their maximum over each document's windows."""
        for kernel, bias in zip(self.kernels, self.bias, strict=True):
            z = np.zeros((len(embedded), kernel.shape[2]), "f4")
            for k, part in enumerate(kernel):
                z[:len(z) - k] += embedded[k:] @ part
            z += bias
            z[last] = -1e9  # windows that begin in padding
            yield z, np.maximum.reduceat(z, begin, axis=0)

    def padding(self, starts: np.ndarray, begin: np.ndarray, size: int) -> np.ndarray:
        real = np.zeros(size, bool)
        place, _, _ = self.layout(starts)
        real[place] = True
        real[begin] = True
        return ~real

    def logits(self, words: np.ndarray, prefixes: np.ndarray, starts: np.ndarray) -> np.ndarray:
        _, begin, embedded = self.embed(words, prefixes, starts)
        pad = self.padding(starts, begin, len(embedded))
        pooled = [m for _, m in self.maxima(embedded, begin, pad)]
        return np.maximum(np.concatenate(pooled, axis=1), 0) @ self.out + self.shift


def _separating(documents: list, settings: Settings) -> np.ndarray:
    """How surely each cell tells toxic documents from others: its log odds less two errors."""
    seen = np.zeros((2, settings.buckets))
    n = np.ones(2)
    for label, words, prefixes, _ in documents:
        cells = np.unique(np.concatenate((words, prefixes)) % settings.buckets)
        seen[label, cells] += 1
        n[label] += 1
    odds = np.log((seen[1] + 0.5) / n[1]) - np.log((seen[0] + 0.5) / n[0])
    error = np.sqrt(1 / (seen[1] + 0.5) + 1 / (seen[0] + 0.5))
    return np.sign(odds) * np.maximum(np.abs(odds) - 2 * error, 0)


def _batch(documents: list) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    starts = np.concatenate(([0], np.cumsum([len(d[1]) for d in documents])))
    return (np.concatenate([d[1] for d in documents]), np.concatenate([d[2] for d in documents]),
            starts, np.array([d[0] for d in documents], "f4"))


def _train(net: Network, documents: list, settings: Settings) -> None:
    """Adagrad on the logistic loss, in minibatches; both classes weigh alike."""
    net.table[:-1, 0] = _separating(documents, settings)
    labels = np.array([d[0] for d in documents])
    weight = len(labels) / (2 * np.maximum(np.bincount(labels, minlength=2), 1))
    net.kernels = [np.abs(k) if w == 1 else k for k, w in zip(net.kernels, net.widths, strict=True)]
    sums = {}

    def step(name: object, array: np.ndarray, gradient: np.ndarray, at=slice(None)) -> None:
        total = sums.setdefault(name, np.full(array.shape, 1e-2, "f4"))
        total[at] += gradient * gradient
        array[at] -= settings.rate * gradient / np.sqrt(total[at])

    rng = np.random.default_rng(settings.seed)
    f = settings.filters
    shift = np.zeros(1, "f4")
    for _ in range(settings.epochs):
        order = rng.permutation(len(documents))
        for i in range(0, len(order), settings.batch):
            words, prefixes, starts, y = _batch([documents[j] for j in order[i:i + settings.batch]])
            cells, begin, embedded = net.embed(words, prefixes, starts)
            pad = net.padding(starts, begin, len(embedded))
            size = np.diff(np.append(begin, len(embedded)))
            pooled, where = [], []
            for z, top in net.maxima(embedded, begin, pad):
                index = np.where(z == np.repeat(top, size, axis=0), np.arange(len(z))[:, None], len(z))
                pooled.append(top)
                where.append(np.minimum.reduceat(index, begin, axis=0))
            hidden = np.maximum(np.concatenate(pooled, axis=1), 0)
            error = (sigmoid(hidden @ net.out + net.shift) - y) * weight[y.astype(int)] / len(y)
            back = error[:, None] * net.out * (hidden > 0)  # documents by filters
            gradient = np.zeros_like(embedded)
            for j, (kernel, at) in enumerate(zip(net.kernels, where, strict=True)):
                own = back[:, j * f:(j + 1) * f].astype("f4")
                change = np.zeros_like(kernel)
                for k in range(len(kernel)):
                    place = np.minimum(at + k, len(embedded) - 1)
                    change[k] = np.einsum("nfd,nf->df", embedded[place], own)
                    np.add.at(gradient, place, own[:, :, None] * kernel[k].T[None])
                step(("kernel", j), kernel, change)
                step(("bias", j), net.bias[j], own.sum(axis=0))
            step("out", net.out, (hidden * error[:, None]).sum(axis=0).astype("f4"))
            step("shift", shift, np.array([error.sum()], "f4"))
            net.shift = shift[0]
            touched = np.flatnonzero(np.abs(gradient).sum(axis=1))
            rows = cells[touched].reshape(-1)
            unique, inverse = np.unique(rows, return_inverse=True)
            total = np.zeros((len(unique), embedded.shape[1]), "f4")
            np.add.at(total, inverse.reshape(-1), np.repeat(gradient[touched], 2, axis=0))
            real = unique < net.buckets
            step("table", net.table, total[real], unique[real])


def best_cut(logits: np.ndarray, labels: np.ndarray, otherwise: float = 0.0) -> float:
    """The logit whose cut has the highest F1, in the middle of the gap; `otherwise` without both."""
    if labels.min(initial=1) == labels.max(initial=0) or not len(labels):
        return otherwise
    order = np.argsort(-logits, kind="stable")
    x, hits = logits[order], np.cumsum(labels[order])
    f1 = 2 * hits / (np.arange(1, len(x) + 1) + labels.sum())
    f1[:-1][x[:-1] == x[1:]] = 0  # equal scores can't be parted
    best = int(np.argmax(f1))
    return float((x[best] + x[min(best + 1, len(x) - 1)]) / 2)


def fit(batches: Iterator[pa.RecordBatch], settings: Settings) -> bytes:
    """The pickled network, from batches of (label, lang, words, prefixes)."""
    documents = []
    for batch in batches:
        words, starts = lists(batch.column("words"))
        prefixes, _ = lists(batch.column("prefixes"))
        langs = batch.column("lang").to_pylist()
        for i, label in enumerate(batch.column("label").to_pylist()):
            own = slice(starts[i], starts[i + 1])
            documents.append((int(label > 0), words[own].copy(), prefixes[own].copy(), langs[i]))
    documents.sort(key=lambda d: (d[0], len(d[1]), crc32(d[1]), str(d[3])))
    net = Network(settings)
    if not documents:
        return pickle.dumps(net.__dict__)
    order = np.random.default_rng(settings.seed).permutation(len(documents))
    held = int(len(order) * settings.calibrate_share)
    train, check = [documents[i] for i in order[held:]], [documents[i] for i in order[:held]]
    _train(net, train, settings)
    if check:
        logits = np.concatenate([
            net.logits(*_batch(check[i:i + 256])[:3]) for i in range(0, len(check), 256)])
        labels = np.array([d[0] for d in check])
        net.cut = best_cut(logits, labels)
        langs = np.array([str(d[3]) for d in check])
        for lang in sorted({d[3] for d in check if d[3] is not None}):
            own = langs == lang
            if labels[own].sum() >= settings.min_positives:
                net.cuts[lang] = best_cut(logits[own], labels[own], net.cut)
    return pickle.dumps(net.__dict__)


def learn(
    docs: DataFrame, labels: DataFrame, settings: Settings = SETTINGS,
    learn_from: Column | None = None,
) -> Network:
    """The network learnt from labelled documents, `learn_from` restricting doc_id.

    The language, if `docs` has a column lang, is used for the languages' cuts alone. Without
    labelled documents all scores are the same.
    """
    condition = F.lit(True) if learn_from is None else learn_from
    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    texts = docs.select("doc_id", F.struct("text", lang.alias("lang")).alias("text"))
    sample = labelled_sample(texts, labels, "toxic", condition, settings.max_train, settings.seed)
    words, prefixes = hashed("text.text", settings.prefix)
    rows = sample.select("label", "text.lang", words.alias("words"), prefixes.alias("prefixes"))
    net = Network(settings)
    net.__dict__ = pickle.loads(fitted(rows, lambda batches: fit(batches, settings)))
    return net


def score(
    docs: DataFrame, net: Network, settings: Settings = SETTINGS, out: str = "score",
) -> DataFrame:
    """Every row of `docs` with its toxicity, 0 to 1, `threshold` at the common cut."""
    centre = np.log(settings.threshold / (1 - settings.threshold)) - net.cut

    @F.arrow_udf("double")
    def scored(words: pa.Array, prefixes: pa.Array) -> pa.Array:
        w, starts = lists(words)
        p, _ = lists(prefixes)
        found = np.empty(len(starts) - 1)
        for a, b in chunks(starts, STEP):
            own = slice(starts[a], starts[b])
            found[a:b] = net.logits(w[own], p[own], starts[a:b + 1] - starts[a])
        return pa.array(sigmoid(found + centre), pa.float64())

    return docs.withColumn(out, scored.asNondeterministic()(*hashed("text", settings.prefix)))


def held_out(doc_id: str = "doc_id") -> Column:
    return id_remainder(doc_id, 3) == 1


def toxicity(docs: DataFrame, labels: DataFrame, settings: Settings = SETTINGS) -> DataFrame:
    """`docs` with score, predicted and held_out, and lang_threshold and flagged beside them.

    predicted cuts the score at `threshold`; flagged cuts it at lang_threshold, the cut calibrated
    for the row's `lang` (the common one where that is null, rare or absent). The score itself
    depends on the text alone; null and empty texts and texts without letters score as padding.
    Columns of these names are replaced; rows of a repeated doc_id are scored one by one.
    """
    net = learn(docs, labels, settings, ~held_out())
    centre = np.log(settings.threshold / (1 - settings.threshold)) - net.cut
    own = F.lit(float(settings.threshold))
    if "lang" in docs.columns:
        for lang, cut in net.cuts.items():
            own = F.when(F.col("lang") == lang, float(sigmoid(cut + centre))).otherwise(own)
    return (
        score(docs, net, settings)
        .withColumn("predicted", (F.col("score") >= settings.threshold).cast("int"))
        .withColumn("held_out", held_out())
        .withColumn("lang_threshold", own)
        .withColumn("flagged", F.col("score") >= F.col("lang_threshold"))
    )
