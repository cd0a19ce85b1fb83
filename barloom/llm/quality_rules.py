"""Quality rules: hashed n-gram log-likelihood ratio of a trusted target against the raw corpus.

Words and word pairs are hashed into `buckets` cells. Two multinomials over the cells, one of all
raw documents and one of the trusted ones, give each cell a weight: the logarithm of how much
likelier it is among trusted n-grams. A document's ratio is the mean weight of its n-grams, and it
is kept if that mean reaches a fixed threshold. Simple counts (words, symbols, repeated lines and
repeated word triples) make a base rule that comes first.

Everything is DataFrame functions. Counting needs a shuffle of at most `buckets` rows per task;
scoring needs none, as the weights, `buckets` numbers, are a constant of the scoring expression.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import SPACE, let, whole, words_of
from barloom.work import written

SYMBOLS = r"[#*$%&|<>]"


@dataclass(frozen=True)
class Rules:
    buckets: int = 10_000
    #: Pseudo-counts a cell, dealt out as the raw corpus is.
    smoothing: float = 10.0
    #: Least mean log-likelihood ratio of a document that is kept.
    threshold: float = -0.05
    min_words: int = 50
    max_repeat_percent: int = 50


RULES = Rules()


def _hashes(words: Column) -> Column:
    """64-bit hash of each word."""
    return F.transform(words, lambda w: F.xxhash64(w))


def _pair_hashes(h: Column) -> Column:
    """Hash of each pair of neighbours of an array of hashes."""
    pairs = F.transform(h, lambda x, i: F.xxhash64(x, F.get(h, i + 1)))
    return F.slice(pairs, F.lit(1), F.greatest(F.size(h) - 1, F.lit(0)))


def _cell(h: Column, buckets: int) -> Column:
    return F.pmod(h, F.lit(buckets)).cast("int")


def cell_counts(texts: DataFrame, buckets: int) -> DataFrame:
    """(cell, n): how often each cell occurs among the n-grams of a `text` column."""
    grams = let(_hashes(words_of("text")), lambda h: F.concat(h, _pair_hashes(h)))
    return (
        texts.select(F.explode(grams).alias("h"))
        .groupBy(_cell(F.col("h"), buckets).alias("cell")).agg(F.count(F.lit(1)).alias("n"))
    )


def cell_weights(raw: DataFrame, target: DataFrame, rules: Rules) -> list[float]:
    """log p_target - log p_raw of each cell, from cell counts; all 0 if either has no n-grams.

    Target counts are smoothed towards the raw distribution, so cells with little evidence weigh
    about 0 and a small corpus doesn't hold their rare words against documents outside the target.
    """
    def counts(df: DataFrame) -> list[int]:
        found = {r["cell"]: r["n"] for r in df.collect()}  # `buckets` rows at most
        return [found.get(c, 0) for c in range(rules.buckets)]

    t, r = counts(target), counts(raw)
    if not sum(t) or not sum(r):
        return [0.0] * rules.buckets
    prior = rules.smoothing * rules.buckets
    raw_total = sum(r) + rules.buckets
    p_raw = [(n + 1) / raw_total for n in r]
    total = sum(t) + prior
    return [
        math.log((n + prior * p) / total) - math.log(p)
        for n, p in zip(t, p_raw, strict=True)
    ]


def _repeated_words(h: Column) -> Column:
    """Number of words, given as hashes, that lie in a window of three found twice or more."""
    windows = F.slice(
        F.transform(h, lambda x, i: F.struct(
            F.xxhash64(x, F.get(h, i + 1), F.get(h, i + 2)).alias("w"), i.alias("at"))),
        F.lit(1), F.greatest(F.size(h) - 2, F.lit(0)))

    def places(s: Column) -> Column:
        """Where the windows begin that equal a neighbour, once all are sorted."""
        twice = F.filter(s, lambda e, i: (
            (e["w"] == F.get(s, i - 1)["w"]) | (e["w"] == F.get(s, i + 1)["w"])))
        return F.sort_array(F.transform(twice, lambda e: e["at"]))

    def covered(at: Column) -> Column:
        """Three words a window, less those that the next one covers as well."""
        shared = F.transform(at, lambda a, i: F.greatest(
            F.lit(0), 3 - (F.coalesce(F.get(at, i + 1), a + 3) - a)))
        return 3 * F.size(at) - F.aggregate(shared, F.lit(0), lambda a, b: a + b)

    return let(let(F.sort_array(windows), places), covered)


def _mean_weight(h: Column, weights: list[float]) -> Column:
    """Mean weight of the n-grams of words, given as hashes; 0 without words."""
    buckets = len(weights)
    constant = F.split(F.lit(",".join(map(repr, weights))), ",").cast("array<double>")

    def total(hashes: Column) -> Column:
        return F.aggregate(hashes, F.lit(0.0), lambda a, x: a + F.get(constant, _cell(x, buckets)))

    mean = (total(h) + total(_pair_hashes(h))) / (2 * F.size(h) - 1)
    return F.when(F.size(h) > 0, mean).otherwise(0.0)


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "log_ratio"]


def measured(docs: DataFrame, weights: list[float]) -> DataFrame:
    """`docs` with the counts of the base rule (bigint) and `log_ratio`, the mean weight.

    n_repeat_words counts the words that lie in some three-word window whose words occur again
    elsewhere in the text in the same order; equal windows are found by their 64-bit hash. Columns
    of these names are replaced.
    """
    def counts(words: Column, lines: Column, h: Column) -> Column:
        values = [
            F.size(words), F.length(F.array_join(words, "")),
            F.regexp_count(whole("text"), F.lit(SYMBOLS)),
            F.size(lines) - F.size(F.array_distinct(lines)), _repeated_words(h),
        ]
        return F.struct(*(v.cast("long").alias(n) for n, v in zip(COUNTS, values, strict=False)),
                        _mean_weight(h, weights).alias("log_ratio"))

    with_word = F.filter(F.split(whole("text"), "\n"), lambda line: line.rlike(f"[^{SPACE[1:]}"))
    found = let(words_of("text"), lambda words: let(
        with_word, lambda lines: let(_hashes(words), lambda h: counts(words, lines, h))))
    # A generator, so that a filter on a count isn't computed beside it once more.
    return docs.drop(*COUNTS).select("*", F.inline(F.array(found)))


def apply_rules(docs: DataFrame, weights: list[float], rules: Rules = RULES) -> DataFrame:
    """Every row of `docs` with its counts, `log_ratio`, `base_failed` and `kept`.

    A text that is null or has no words has counts of 0 and a ratio of 0, and fails the base rule.
    Columns of these names are replaced; all others, and repeated rows, stay as they are.
    """
    failed = (F.col("n_words") < rules.min_words) | (
        100 * F.col("n_repeat_words") > rules.max_repeat_percent * F.col("n_words"))
    return (
        measured(docs, weights).withColumn("base_failed", failed)
        .withColumn("kept", ~F.col("base_failed") & (F.col("log_ratio") >= rules.threshold))
    )


def learn_weights(docs: DataFrame, trusted_ids: DataFrame, rules: Rules = RULES) -> list[float]:
    """Cell weights from all of `docs` and from those whose doc_id is in `trusted_ids`.

    Trusted ids grow with the corpus, so they are never broadcast: the texts are shuffled once, at
    every size, to meet them.
    """
    ids = trusted_ids.select("doc_id").where("doc_id is not null").distinct()
    texts = docs.where("text is not null")
    target = texts.select("doc_id", "text").join(
        written(ids, "trusted").hint("merge"), "doc_id", "left_semi")
    return cell_weights(
        cell_counts(texts.select("text"), rules.buckets),
        cell_counts(target.select("text"), rules.buckets), rules)


def quality_rules(docs: DataFrame, trusted_ids: DataFrame, rules: Rules = RULES) -> DataFrame:
    """Learn the weights from `docs` and judge all of them; see `apply_rules` for the columns."""
    return apply_rules(docs, learn_weights(docs, trusted_ids, rules), rules)
