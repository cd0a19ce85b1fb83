"""Language identification: sparse multinomial regression on TF-IDF of character n-grams.

A text is lower-cased, everything between runs of letters becomes one space, and the code point
n-grams of the rest are hashed. An n-gram's value is its share of the text's n-grams times its
inverse document frequency in the sample. Weights, one a language, are learnt by
follow-the-regularised-leader steps with elastic-net penalties on a sample bounded for each
language, in one task; a temperature is then calibrated on a part of the sample that was left out.
Scoring a text is one sparse product, summed over its n-grams as they come, without a shuffle.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm.common import (
    chunks,
    fitted,
    free_names,
    id_remainder,
    segment_sums,
    whole,
)
from barloom.llm.ftrl import Ftrl, softmax
from barloom.work import written


@dataclass(frozen=True)
class Settings:
    buckets: int = 1 << 16
    #: Bounds of the labelled sample: documents of one language, and of all.
    per_lang: int = 2_000
    max_train: int = 10_000
    calibrate_share: float = 0.2
    epochs: int = 3
    #: Values are scaled so that a step on one document moves its logits noticeably.
    scale: float = 20.0
    alpha: float = 0.5
    l1: float = 0.02
    l2: float = 0.1
    seed: int = 3


SETTINGS = Settings()
UNDETERMINED = "und"

#: The ids' hashes are counted by this many of their first bits to find where a language's sample ends.
CUT_BITS = 12

#: Numbers that one numpy step gathers at most, n-grams times languages, or else one document.
STEP = 1_500_000


def cleaned(text: Column | str = "text") -> Column:
    """Lower-cased runs of letters, each followed by a space; empty without letters."""
    return F.regexp_replace(F.concat(F.lower(whole(text)), F.lit(" ")), r"\P{L}+", " ")


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Texts end to end as code points, each closed by two zeros, and where each begins."""
    size = np.fromiter(map(len, texts), np.int64, len(texts)) + 2
    joined = "\0\0".join([*texts, ""]).encode("utf-32-le", "surrogatepass")
    return np.frombuffer(joined, "<u4"), np.concatenate(([0], np.cumsum(size)))


def cells(points: np.ndarray, buckets: int) -> np.ndarray:
    """Hashed pairs and triples that begin at each code point, end to end; `buckets` is none."""
    a = points
    b = np.append(points[1:], np.uint32(0))
    c = np.append(points[2:], np.zeros(min(2, len(points)), np.uint32))
    pair = a * np.uint32(0x9E3779B1) + b * np.uint32(0x85EBCA6B)
    triple = pair + c * np.uint32(0xC2B2AE35) + np.uint32(0x27D4EB2F)
    out = np.empty((len(a), 2), np.int32)
    for column, h in enumerate((pair, triple)):
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x2C1B3C6D)
        h ^= h >> np.uint32(13)
        out[:, column] = h % np.uint32(buckets)
    end = (a == 0) | (b == 0)
    out[end, 0] = buckets
    out[end | (c == 0), 1] = buckets
    return out.reshape(-1)


@dataclass
class Model:
    langs: list[str]
    weights: np.ndarray  # buckets + 1 by languages, with idf and scale multiplied in
    bias: np.ndarray
    temperature: float

    def logits(self, texts: list[str]) -> np.ndarray:
        buckets = len(self.weights) - 1
        sizes = np.concatenate(([0], np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))))
        out = np.empty((len(texts), len(self.langs)))
        for a, b in chunks(sizes, max(1, STEP // max(1, len(self.langs)))):
            points, starts = code_points(texts[a:b])
            own = cells(points, buckets)
            n = segment_sums((own < buckets).astype(np.float64), 2 * starts)
            total = segment_sums(self.weights[own], 2 * starts)
            out[a:b] = total / np.maximum(n, 1)[:, None] + self.bias
        return out


def fit(batches: Iterator[pa.RecordBatch], settings: Settings) -> bytes:
    """The pickled model, from batches of (text, lang) of cleaned texts."""
    documents = []
    for batch in batches:
        for text, lang in zip(batch.column("text"), batch.column("lang").to_pylist(), strict=True):
            points, _ = code_points([text.as_py()])
            own = cells(points, settings.buckets)
            at, n = np.unique(own[own < settings.buckets], return_counts=True)
            documents.append((lang, at, (n / max(1, n.sum())).astype("f4")))
    documents.sort(key=lambda d: (d[0], len(d[1]), crc32(d[1]), crc32(d[2])))
    langs = sorted({d[0] for d in documents})
    if not langs:
        return pickle.dumps(([], np.zeros((settings.buckets + 1, 0), "f4"), np.zeros(0), 1.0))

    seen = np.zeros(settings.buckets)
    for _, at, _ in documents:
        seen[at] += 1
    idf = settings.scale * (np.log((1 + len(documents)) / (1 + seen)) + 1)
    rng = np.random.default_rng(settings.seed)
    order = rng.permutation(len(documents))
    held = int(len(order) * settings.calibrate_share)
    check, train = order[:held], order[held:]

    number = {lang: i for i, lang in enumerate(langs)}
    penalised = Ftrl((settings.buckets, len(langs)), settings.alpha, l1=settings.l1, l2=settings.l2)
    intercept = Ftrl((len(langs),), settings.alpha, l2=settings.l2)

    def row_logits(i: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        _, at, share = documents[i]
        w, b, x = penalised.weights(at), intercept.weights(), share * idf[at]
        return x @ w + b, x, w, b

    for _ in range(settings.epochs):
        for i in rng.permutation(train):
            logits, x, w, b = row_logits(i)
            error = softmax(logits)
            error[number[documents[i][0]]] -= 1
            penalised.update(documents[i][1], x[:, None] * error, w)
            intercept.update(slice(None), error, b)

    temperature = 1.0
    if held:
        logits = np.stack([row_logits(i)[0] for i in check])
        truth = np.array([number[documents[i][0]] for i in check])
        temperature = calibrated(logits, truth)
    weights = np.zeros((settings.buckets + 1, len(langs)), "f4")
    weights[:-1] = penalised.weights() * idf[:, None]
    return pickle.dumps((langs, weights, intercept.weights(), temperature))


def calibrated(logits: np.ndarray, truth: np.ndarray) -> float:
    """The temperature, from 0.05 to 20, of the least negative log-likelihood."""
    def loss(log_t: float) -> float:
        p = softmax(logits / np.exp(log_t))[np.arange(len(truth)), truth]
        return float(-np.log(np.maximum(p, 1e-12)).mean())

    low, high, ratio = np.log(0.05), np.log(20.0), (5 ** 0.5 - 1) / 2
    while high - low > 1e-4:
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def candidates(marked: DataFrame, per_lang: int) -> DataFrame:
    """Distinct rows of (doc_id, lang, _h), among them the `per_lang` smallest `_h` of each language.

    Rows are counted by language and the first bits of the hash, on the map side; up to where these
    counts reach `per_lang` rows pass, so few of a large language are shuffled or sorted. Repeated
    rows may leave a language short: its range of hashes is then widened.
    """
    last = (1 << CUT_BITS) - 1
    marked = marked.withColumn("_bits", F.shiftright("_h", 64 - CUT_BITS) + (last + 1) // 2)
    counts = marked.groupBy("lang", "_bits").agg(F.count(F.lit(1)).alias("n"))
    so_far = F.sum("n").over(Window.partitionBy("lang").orderBy("_bits"))
    reached = F.min(F.when(F.col("so_far") >= per_lang, F.col("_bits")))
    cuts = written(
        counts.withColumn("so_far", so_far).groupBy("lang")
        .agg(F.coalesce(reached, F.lit(last)).alias("cut")), "cuts")
    while True:
        found = written(
            marked.join(cuts, "lang").where("_bits <= cut").select("doc_id", "lang", "_h").distinct(),
            "candidates")
        sizes = found.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
        short = (F.col("n") < per_lang) & (F.col("cut") < last)
        sized = cuts.join(sizes, "lang")
        if sized.where(short).isEmpty():
            return found
        wider = F.least(F.lit(last), 4 * F.col("cut") + 3)
        cuts = written(
            sized.select("lang", F.when(short, wider).otherwise(F.col("cut")).alias("cut")), "cuts")


def learn(docs: DataFrame, settings: Settings = SETTINGS, learn_from: Column | None = None) -> Model:
    """The model learnt from rows of `docs` with a language and a letter, `learn_from` restricting.

    The sample is drawn from ids and languages, those with the smallest hashes of each language;
    its ids are broadcast, no more than `max_train`. If there are more, small languages keep all
    their rows and the others get equal shares. A doc_id with several languages counts for each,
    with the texts it has there.
    """
    lettered = whole("text").rlike(r"\p{L}")
    marked = docs.where(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & lettered)
    if learn_from is not None:
        marked = marked.where(learn_from)
    hashed = F.xxhash64(F.lit(settings.seed), "doc_id")
    marked = marked.select("doc_id", F.col("lang").cast("string").alias("lang"), hashed.alias("_h"))
    first = Window.partitionBy("lang").orderBy("_h", "doc_id")
    ranked = candidates(marked, settings.per_lang).withColumn("_n", F.row_number().over(first))
    # The first of each language, then the second of each, and so on.
    dealt = ranked.where(F.col("_n") <= settings.per_lang).orderBy("_n", "_h", "doc_id").limit(
        settings.max_train)
    chosen = written(dealt.select("doc_id", "lang"), "sample")
    texts = docs.select("doc_id", F.col("lang").cast("string").alias("lang"), cleaned().alias("text"))
    rows = texts.join(F.broadcast(chosen), ["doc_id", "lang"]).where(F.length("text") > 1)
    # Of several rows of one doc_id the smallest text counts.
    rows = rows.groupBy("doc_id", "lang").agg(F.min("text").alias("text"))
    return Model(*pickle.loads(
        fitted(rows.select("text", "lang"), lambda batches: fit(batches, settings))))


def identify(
    docs: DataFrame, model: Model, lang_out: str = "lang_pred", score_out: str = "score",
) -> DataFrame:
    """Every row of `docs` with the likeliest language and its calibrated probability.

    Null texts and texts without a letter are `und`, with score 0; so is every text if no language
    was learnt. Of equally likely languages the first by name is predicted.
    """
    @F.arrow_udf("struct<lang string, score double>")
    def found(texts: pa.Array) -> pa.Array:
        strings = texts.to_pylist()
        lettered = np.array([len(s) > 1 for s in strings], bool)
        lang = np.full(len(strings), UNDETERMINED, object)
        score = np.zeros(len(strings))
        if model.langs and lettered.any():
            chosen = np.flatnonzero(lettered)
            logits = model.logits([strings[i] for i in chosen])
            p = softmax(logits / model.temperature)
            best = p.argmax(axis=1)
            lang[chosen] = np.array(model.langs, object)[best]
            score[chosen] = p[np.arange(len(best)), best]
        return pa.StructArray.from_arrays(
            [pa.array(lang, pa.string()), pa.array(score, pa.float64())], ["lang", "score"])

    (name,) = free_names(docs, "_found")
    return (
        docs.withColumn(name, found.asNondeterministic()(cleaned()))
        .withColumn(lang_out, F.col(f"{name}.lang")).withColumn(score_out, F.col(f"{name}.score"))
        .drop(name)
    )


def held_out(doc_id: str = "doc_id") -> Column:
    return id_remainder(doc_id, 3) == 1


def language_id(docs: DataFrame, settings: Settings = SETTINGS) -> DataFrame:
    """`docs` with lang_pred, score and held_out, learnt from rows that aren't held out.

    Columns of these names are replaced; rows of a repeated doc_id are predicted one by one. The
    prediction depends on the text alone.
    """
    return identify(docs, learn(docs, settings, ~held_out())).withColumn("held_out", held_out())
