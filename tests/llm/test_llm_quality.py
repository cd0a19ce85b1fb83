"""Quality rules and the quality classifier."""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from barloom.llm import quality_classifier as classifier
from barloom.llm import quality_rules as rules
from barloom.llm.common import labelled_sample
from barloom.llm.ftrl import Ftrl


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def base(text):
    w = words(text)
    windows = Counter(zip(w, w[1:], w[2:]))
    covered = set()
    for i in range(len(w) - 2):
        if windows[tuple(w[i:i + 3])] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [x for x in (text or "").split("\n") if words(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")),
            len(lines) - len(set(lines)), len(covered))


NAMES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


@pytest.mark.parametrize("which", ["odd", "real"])
def test_base_counts(which, odd, real):
    docs = odd if which == "odd" else real("documents")
    for r in rules.measured(docs.select("doc_id", "text"), [0.0]).collect():
        assert tuple(r[n] for n in NAMES) == base(r["text"]), r["doc_id"]


def test_ratio_against_plain_counts(spark):
    """Cells are told apart by hash alone; with one cell a word the ratio can be done by hand."""
    docs = spark.createDataFrame(
        [(1, "a b a"), (2, "c c"), (3, "a c"), (4, None), (5, "")], "doc_id long, text string")
    small = rules.Rules(buckets=64, smoothing=0.5, min_words=0, threshold=-0.1)
    ids = spark.createDataFrame([(1,), (1,), (None,), (77,)], "doc_id long")
    out = {r["doc_id"]: r for r in rules.quality_rules(docs, ids, small).collect()}

    hashes = {w: h for w, h in docs.select(F.explode(F.array(*map(F.lit, "abc"))).alias("w")).select(
        "w", F.xxhash64("w")).distinct().collect()}
    pairs = {(a, b): spark.range(1).select(F.xxhash64(F.lit(hashes[a]), F.lit(hashes[b]))).first()[0]
             for a in "abc" for b in "abc"}

    def cells(text):
        w = (text or "").split()
        return [hashes[x] % 64 for x in w] + [pairs[p] % 64 for p in zip(w, w[1:])]

    texts = {1: "a b a", 2: "c c", 3: "a c", 4: None, 5: ""}
    raw = Counter(c for t in texts.values() for c in cells(t))
    target = Counter(cells(texts[1]))
    for i, text in texts.items():
        p = {c: (raw[c] + 1) / (sum(raw.values()) + 64) for c in range(64)}
        total = sum(target.values()) + 32
        weights = [math.log((target[c] + 32 * p[c]) / total / p[c]) for c in cells(text)]
        wanted = sum(weights) / len(weights) if weights else 0.0
        assert out[i]["log_ratio"] == pytest.approx(wanted)
        assert out[i]["kept"] == (not out[i]["base_failed"] and wanted >= -0.1)


def test_rules_keep_rows_and_columns(odd, none, odd_rows):
    out = rules.quality_rules(odd, odd.where("lang = 'en'"))
    assert out.count() == len(odd_rows) and {"score", "rank", "source"} <= set(out.columns)
    assert out.where("text is null and (kept or n_words > 0 or log_ratio <> 0)").count() == 0
    empty = rules.quality_rules(none, none)
    assert empty.count() == 0 and "kept" in empty.columns
    # Nothing trusted: every ratio is 0, so the base rule decides alone.
    assert rules.quality_rules(odd, none).where("kept <> (not base_failed)").count() == 0


def test_junk_goes_clean_stays(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    judged = rules.quality_rules(docs.select("doc_id", "text"), labels.where("quality = 1"))
    rows = judged.where("not base_failed").join(labels, "doc_id").select(
        "quality", "kept").collect()
    for quality, share in ((1, 0.97), (0, 0.0)):
        own = [r["kept"] for r in rows if r["quality"] == quality]
        assert abs(np.mean(own) - share) <= 0.1, quality


def test_rules_run_no_python(real):
    plan = rules.apply_rules(real("documents"), [0.0] * 8)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange", plan)


def test_ftrl_is_the_closed_form():
    model = Ftrl((3,), alpha=0.5, beta=1.0, l1=0.2, l2=0.1)
    z, n, w = [0.0] * 3, [0.0] * 3, [0.0] * 3
    rng = np.random.default_rng(0)
    for _ in range(50):
        at = rng.permutation(3)[:2]
        g = rng.normal(size=2)
        model.update(at, g, model.weights(at))
        for i, x in zip(at, g):
            s = (math.sqrt(n[i] + x * x) - math.sqrt(n[i])) / 0.5
            z[i] += x - s * w[i]
            n[i] += x * x
            w[i] = 0.0 if abs(z[i]) <= 0.2 else -(z[i] - math.copysign(0.2, z[i])) / (
                (1.0 + math.sqrt(n[i])) / 0.5 + 0.1)
    assert model.weights() == pytest.approx(w)


def test_score_is_a_dot_product(spark):
    texts = ["Foo bar BAZ 12 bar bar", "", None, "x"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    weights = np.random.default_rng(1).normal(size=513).astype("f4")
    rows = classifier.score(docs, weights).select(
        "doc_id", "score", classifier.hashed_words("text").alias("w"),
        classifier.hashed_shapes("text").alias("s")).collect()
    for r in rows:
        starts = np.array([0, len(r["w"])])
        cells, _ = classifier.features(
            np.array(r["w"], np.int32), np.array(r["s"], np.int32), starts, 512)
        assert len(cells) == 4 * len(r["w"])
        x = sum(float(weights[c]) for c in cells) / math.sqrt(max(1, len(r["w"])))
        assert r["score"] == pytest.approx(1 / (1 + math.exp(-(x + float(weights[-1])))))


def test_shapes(spark):
    df = spark.createDataFrame([("KRAM!! Über, x1 FOO!!",)], "text string")
    s = df.select(classifier.hashed_shapes("text")).first()[0]
    assert s[0] == s[3] and len(set(s)) == 3


def test_classifier_holds_out_and_predicts(real):
    docs = real("documents").drop("lang", "source")
    out = classifier.quality_classifier(docs, real("labels")).join(real("labels"), "doc_id")
    rows = out.where("held_out").select("quality", "predicted").collect()
    assert len(rows) > 5 and np.mean([r[0] == r[1] for r in rows]) > 0.85
    assert out.where("held_out <> (crc32(cast(doc_id as string)) % 5 = 0)").count() == 0


def test_held_out_labels_are_not_read(spark, real):
    docs, labels = real("documents"), real("labels")
    turned = labels.withColumn("quality", F.when(
        classifier.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    a = classifier.learn(docs, labels, learn_from=~classifier.held_out())
    b = classifier.learn(docs, turned, learn_from=~classifier.held_out())
    assert (a == b).all() and a.any()


def test_classifier_on_odd_rows(odd, none, odd_rows, spark):
    labels = spark.createDataFrame(
        [(1, 1, 0), (1, 0, 0), (5, 0, 1), (None, 1, 1), (9, None, None)],
        "doc_id long, quality int, toxic int")
    out = classifier.quality_classifier(odd, labels)
    assert out.count() == len(odd_rows)
    assert out.where("score is null or score < 0 or score > 1").count() == 0
    assert classifier.quality_classifier(none, labels).count() == 0
    blank = {r[0] for r in classifier.quality_classifier(odd, labels.limit(0)).select("score").collect()}
    assert blank == {0.5}
    kept = classifier.drop_rejected(odd, labels)
    assert kept.columns == odd.columns


def test_the_sample_is_bounded_by_rows_too(spark):
    """A labelled doc_id that most rows share is one row of the sample."""
    docs = spark.createDataFrame(
        [(i % 3, f"text {i}") for i in range(90)] + [(5, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i in range(6)], "doc_id long, quality int")
    sample = labelled_sample(docs, labels, "quality", F.lit(True), 100, 1).collect()
    assert sorted((r["doc_id"], r["text"]) for r in sample) == [
        (0, "text 0"), (1, "text 1"), (2, "text 11"), (5, None)]
    assert len(labelled_sample(docs, labels, "quality", F.lit(True), 2, 1).collect()) <= 2
