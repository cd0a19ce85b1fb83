"""Audit of document filters in every order, by contractions of contingency tensors.

Each document passes or fails each of five filters, whatever their order. So the documents of a part
are counted once, into a tensor with an axis of pass and fail for each filter, and every figure of
every order and step is a contraction of it: along each axis it takes those that pass, those that
fail, or all. Rows meet in shuffles by their text's digest only after copies have been combined, and
what is left of a part is 32 counts.
"""

from __future__ import annotations

from itertools import permutations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import let, whole, words_of

FILTERS = "ABCDE"
MEASURES = ["n", "good", "toxic"]
PASS, FAIL, ALL = (1, 0), (0, 1), (1, 1)
RESULT = (
    "part string, filter_order string, step int, kept long, removed long, redundant long, "
    "unique_fails long, good_lost long, toxic_lost long, shapley long"
)


def text_failures(text: Column) -> Column:
    """Bits 0 to 3: the filters A to D that a text fails.

    A: under 100 words; B: distinct words below 80 % of them; C: capitals A-Z above 10 % of the code
    points; D: one of #$%&*|.
    """
    def bit(condition: Column, place: int) -> Column:
        return F.when(condition, 1 << place).otherwise(0)

    n_capitals = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]+", ""))
    by_words = let(words_of(text), lambda words: let(
        F.size(words), lambda n: bit(n < 100, 0).bitwiseOR(
            bit(100 * F.size(F.array_distinct(words)) < 80 * n, 1))))
    return by_words.bitwiseOR(bit(100 * n_capitals > 10 * F.length(text), 2)).bitwiseOR(
        bit(text.rlike("[#$%&*|]"), 3))


def labels_of(labels: DataFrame) -> DataFrame:
    """(doc_id, good, toxic) once an id: 1 if any of its labels says so."""
    marks = [F.max(F.when(F.col(c) == 1, 1).otherwise(0)).alias(name)
             for c, name in (("quality", "good"), ("toxic", "toxic"))]
    return labels.where("doc_id is not null").groupBy("doc_id").agg(*marks)


def cells(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, code, n, good, toxic): the counts of each part and set of failed filters."""
    text = whole("text")
    # Null ids have no label; their digest spreads them over the join.
    spread = F.when(F.col("doc_id").isNull(), F.xxhash64("digest")).otherwise(0)
    key = ["doc_id", "spread", "digest", "part", "code"]
    rows = docs.select(
        "doc_id", F.coalesce("lang", F.lit("")).alias("part"), F.unhex(F.sha2(text, 256)).alias("digest"),
        text_failures(text).alias("code")).withColumn("spread", spread)
    # From here on a row is an id and a text; repeated rows are counted.
    rows = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    marks = labels_of(labels).withColumn("spread", F.lit(0).cast("long"))
    counted = rows.join(marks, ["doc_id", "spread"], "left").select(
        "doc_id", "digest", "part", "code", "n",
        *((F.col("n") * F.coalesce(m, F.lit(0))).alias(m) for m in MEASURES[1:]))

    # Of each text and part: what there is, and what its smallest id has. Null ids come last.
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", *MEASURES))
    texts = counted.groupBy("digest", "part", "code").agg(
        *(F.sum(m).alias(m) for m in MEASURES), first.alias("first"))
    # The parts of a text are few, however many copies it has.
    least = texts.groupBy("digest").agg(
        F.min(F.struct("first.none", "first.doc_id")).alias("least"))
    known = texts.join(least, "digest")
    # Rows that pass E: those of the smallest id, or all if no row of the text has one.
    passing = F.when(F.col("least.none"), F.struct(*MEASURES)).when(
        F.col("first.doc_id") == F.col("least.doc_id"), F.struct(*(F.col(f"first.{m}") for m in MEASURES)))
    split = known.withColumn("passing", passing).select("part", F.inline(F.array(
        F.struct("code", *(F.coalesce(f"passing.{m}", F.lit(0)).alias(m) for m in MEASURES)),
        F.struct(F.col("code").bitwiseOR(1 << 4).alias("code"),
                 *((F.col(m) - F.coalesce(f"passing.{m}", F.lit(0))).alias(m) for m in MEASURES)))))
    return split.groupBy("part", "code").agg(*(F.sum(m).alias(m) for m in MEASURES))


def choices() -> list[tuple[str, int]]:
    """Every order of the filters, and each of its steps."""
    orders = ["".join(p) for p in permutations(FILTERS)]
    return [(order, step) for order in orders for step in range(1, len(FILTERS) + 1)]


def selections() -> dict[str, np.ndarray]:
    """For each figure and choice, what is taken along each axis: (choices, filters, 2)."""
    out: dict[str, list] = {"kept": [], "removed": [], "failing": [], "only": []}
    for order, step in choices():
        done, now = order[:step - 1], order[step - 1]
        out["kept"].append([PASS if f in done + now else ALL for f in FILTERS])
        out["removed"].append([FAIL if f == now else PASS if f in done else ALL for f in FILTERS])
        out["failing"].append([FAIL if f == now else ALL for f in FILTERS])
        out["only"].append([FAIL if f == now else PASS for f in FILTERS])
    return {name: np.array(taken, np.int64) for name, taken in out.items()}


def contracted(tensor: np.ndarray, taken: np.ndarray) -> np.ndarray:
    """(choices, measures): the tensor (measures, 2, 2, 2, 2, 2) summed over what is taken."""
    axes = [taken[:, i] for i in range(len(FILTERS))]
    return np.einsum("mabcde,na,nb,nc,nd,ne->nm", tensor, *axes, optimize=True)


def audited(part: str, counts: pd.DataFrame) -> pd.DataFrame:
    """The figures of one part from its cells (code, n, good, toxic)."""
    tensor = np.zeros((len(MEASURES), 1 << len(FILTERS)), np.int64)
    tensor[:, counts["code"].to_numpy()] = counts[MEASURES].to_numpy(np.int64).T
    # The bits of a code run from E to A; the axes from A to E.
    tensor = tensor.reshape(-1, *[2] * len(FILTERS)).transpose(0, 5, 4, 3, 2, 1)
    found = {name: contracted(tensor, taken) for name, taken in selections().items()}
    removed = found["removed"][:, 0]
    out = pd.DataFrame(choices(), columns=["filter_order", "step"])
    now = pd.Series([order[step - 1] for order, step in choices()])
    out["kept"], out["removed"] = found["kept"][:, 0], removed
    out["redundant"] = found["failing"][:, 0] - removed
    out["unique_fails"] = found["only"][:, 0]
    out["good_lost"], out["toxic_lost"] = found["removed"][:, 1], found["removed"][:, 2]
    out["shapley"] = out["removed"].groupby(now).transform("sum")
    out.insert(0, "part", part)
    return out


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per part (lang; null: empty string), order of the filters and step: what the step does.

    `docs` needs doc_id, text and lang, `labels` doc_id, quality and toxic; nothing else is read.
    Null texts count as empty. Filter E fails every row whose text a row with a smaller id has too;
    texts are the same if their SHA-256 are. Null ids are larger than all others and not smaller
    than each other; rows that repeat an id don't fail for one another. An id with several labels
    has those that any of them gives. Parts without documents have no rows, nor has an empty table.
    """
    counts = cells(docs, labels)
    return counts.groupBy("part").applyInPandas(
        lambda key, rows: audited(key[0], rows), RESULT)
