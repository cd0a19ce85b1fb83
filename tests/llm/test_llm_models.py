"""Toxicity and language identification."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from barloom.llm import language_id as lang
from barloom.llm import toxicity as tox
from barloom.llm.ftrl import sigmoid, softmax


def small_net():
    settings = tox.Settings(buckets=50, dim=4, filters=3)
    net = tox.Network(settings)
    rng = np.random.default_rng(2)
    net.bias = [rng.normal(size=3).astype("f4") for _ in net.widths]
    net.out = rng.normal(size=9).astype("f4")
    return net


def by_hand(net, words, prefixes):
    x = [net.table[w % 50] + net.table[p % 50] for w, p in zip(words, prefixes)]
    x = x or [np.zeros(4)]
    n = len(x)
    x += [np.zeros(4)] * 2
    pooled = []
    for kernel, bias in zip(net.kernels, net.bias):
        z = [sum(x[i + k] @ kernel[k] for k in range(len(kernel))) + bias for i in range(n)]
        pooled.append(np.max(z, axis=0))
    return float(np.maximum(np.concatenate(pooled), 0) @ net.out + net.shift)


def test_convolution_against_loops():
    net, rng = small_net(), np.random.default_rng(3)
    sizes = [0, 1, 2, 3, 7, 0, 20]
    docs = [(rng.integers(0, 1000, n), rng.integers(0, 1000, n)) for n in sizes]
    starts = np.concatenate(([0], np.cumsum(sizes)))
    found = net.logits(np.concatenate([d[0] for d in docs]), np.concatenate([d[1] for d in docs]), starts)
    assert found == pytest.approx([by_hand(net, *d) for d in docs], rel=1e-4, abs=1e-4)


def test_training_lowers_the_loss_and_finds_the_word():
    settings = tox.Settings(buckets=997, epochs=4, batch=16)
    rng = np.random.default_rng(4)
    documents = []
    for i in range(400):
        words = rng.integers(10, 900, 30)
        if i % 4 == 0:
            words[rng.integers(0, 30)] = 5
        documents.append((int(i % 4 == 0), words, words + 1, None))
    net = tox.Network(settings)
    tox._train(net, documents, settings)
    logits = net.logits(*tox._batch(documents)[:3])
    labels = np.array([d[0] for d in documents])
    cut = tox.best_cut(logits, labels)
    assert ((logits > cut) == labels).mean() > 0.97
    assert not net.table[-1].any()


def test_gradients_against_differences():
    """A first step of Adagrad tells the gradient; differences of the loss tell it as well."""
    rng = np.random.default_rng(8)
    documents = [
        (int(i % 3 == 0), rng.integers(0, 1000, n), rng.integers(0, 1000, n), None)
        for i, n in enumerate([5, 1, 9, 2, 7, 12, 3])]

    def trained(rate):
        settings = tox.Settings(buckets=50, dim=4, filters=3, epochs=1, batch=7, rate=rate)
        net = tox.Network(settings)
        net.out = np.linspace(-1, 1, 9).astype("f4")
        net.bias = [np.full(3, 0.3, "f4") for _ in net.widths]
        tox._train(net, documents, settings)
        return net

    rate, eps = 1e-2, 1e-5
    start, after = trained(0.0), trained(rate)
    start.table, start.out = start.table.astype("f8"), start.out.astype("f8")
    start.kernels = [k.astype("f8") for k in start.kernels]
    start.bias = [b.astype("f8") for b in start.bias]
    y = np.array([d[0] for d in documents])
    weight = len(y) / (2 * np.bincount(y, minlength=2))

    def loss():
        z = np.array([by_hand(start, d[1], d[2]) for d in documents])
        return float((weight[y] * (np.logaddexp(0, z) - y * z)).mean())

    pairs = [(start.out, after.out), (start.table[:-1], after.table[:-1]),
             *zip(start.kernels, after.kernels), *zip(start.bias, after.bias)]
    for array, moved in pairs:
        step = (array - moved) / rate  # gradient / sqrt(0.01 + gradient ** 2)
        stepped = 0.1 * step / np.sqrt(np.maximum(1 - step * step, 1e-9))
        flat = array.reshape(-1)
        for i in rng.choice(flat.size, min(25, flat.size), replace=False):
            own = flat[i]
            flat[i] = own + eps
            up = loss()
            flat[i] = own - eps
            down = loss()
            flat[i] = own
            assert stepped.reshape(-1)[i] == pytest.approx((up - down) / (2 * eps), rel=0.02, abs=5e-4)


def test_best_cut():
    assert tox.best_cut(np.array([3.0, 2.0, 1.0, 0.0]), np.array([1, 1, 0, 0])) == 1.5
    assert tox.best_cut(np.array([1.0, 1.0]), np.array([1, 1]), 9.0) == 9.0
    assert tox.best_cut(np.array([]), np.array([], int), 9.0) == 9.0
    x, y = np.array([2.0, 2.0, 1.0, 0.0]), np.array([1, 0, 1, 0])
    assert tox.best_cut(x, y) == 0.5


def test_toxic_documents_are_found(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    out = tox.toxicity(docs, labels).join(labels, "doc_id").where("held_out")
    rows = out.select("toxic", "predicted", "lang").collect()
    assert np.mean([r[0] == r[1] for r in rows]) > 0.9
    english = [r["predicted"] for r in rows if r["toxic"] and r["lang"] == "en"]
    assert np.mean(english) > 0.7


def test_toxicity_on_odd_rows(odd, none, odd_rows, spark):
    labels = spark.createDataFrame(
        [(1, 1, 0), (1, 0, 1), (5, 0, 1), (12, 1, 0), (100, 1, 0), (None, 1, 1)],
        "doc_id long, quality int, toxic int")
    out = tox.toxicity(odd, labels)
    assert out.count() == len(odd_rows)
    assert out.where("score is null or score < 0 or score > 1").count() == 0
    assert out.where("predicted <> cast(score >= 0.7 as int)").count() == 0
    assert tox.toxicity(none, labels).count() == 0
    blank = tox.toxicity(odd.drop("lang"), labels.limit(0))
    assert blank.select("lang_threshold").distinct().collect() == [(0.7,)]


def test_language_is_no_input_of_toxicity(real):
    docs, labels = real("documents"), real("labels")
    net = tox.learn(docs, labels, learn_from=~tox.held_out())
    other = tox.learn(docs.withColumn("lang", F.lit("xx")), labels, learn_from=~tox.held_out())
    assert (net.table == other.table).all() and net.cut == other.cut


def test_language_cells_against_loops():
    texts = ["ab ", "", "a", "abc abc "]
    points, starts = lang.code_points(texts)
    for i, text in enumerate(texts):
        own = lang.cells(points[starts[i]:starts[i + 1]], 1 << 10).reshape(-1, 2)
        assert (own[:, 0] < 1 << 10).sum() == max(0, len(text) - 1)
        assert (own[:, 1] < 1 << 10).sum() == max(0, len(text) - 2)
    joined = lang.cells(points, 1 << 10)
    parts = [lang.cells(points[a:b], 1 << 10) for a, b in zip(starts, starts[1:])]
    assert (joined == np.concatenate(parts)).all()


def test_language_score_is_a_sparse_product():
    rng = np.random.default_rng(5)
    model = lang.Model(["x", "y", "z"], rng.normal(size=(65, 3)).astype("f4"), rng.normal(size=3), 1.0)
    model.weights[-1] = 0
    texts = ["ab cd ", "q ", "zz zz zz "]
    for text, found in zip(texts, model.logits(texts)):
        points, _ = lang.code_points([text])
        own = [c for c in lang.cells(points, 64) if c < 64]
        wanted = sum(model.weights[c] for c in own) / len(own) + model.bias
        assert found == pytest.approx(wanted, rel=1e-5)


def test_temperature_minimises_the_loss():
    rng = np.random.default_rng(6)
    truth = rng.integers(0, 3, 500)
    logits = rng.normal(size=(500, 3)) * 6 + 4 * np.eye(3)[truth]

    def loss(t):
        return -np.log(softmax(logits / t)[np.arange(500), truth]).mean()

    best = lang.calibrated(logits, truth)
    assert loss(best) <= min(loss(t) for t in np.geomspace(0.1, 15, 60)) + 1e-6
    assert sigmoid(0.0) == 0.5


def test_languages_are_told(real):
    rows = lang.language_id(real("documents").drop("source")).where("held_out").select(
        "lang", "lang_pred").collect()
    assert np.mean([r[0] == r[1] for r in rows]) > 0.95


def test_language_on_odd_rows(odd, none, odd_rows):
    out = lang.language_id(odd)
    rows = out.select("doc_id", "text", "lang_pred", "score").collect()
    assert len(rows) == len(odd_rows)
    for r in rows:
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == "und") == (not letters) and 0 <= r["score"] <= 1
    assert lang.language_id(none).count() == 0
    unlabelled = odd.withColumn("lang", F.lit(None).cast("string"))
    assert lang.language_id(unlabelled).select("lang_pred").distinct().collect() == [("und",)]


def test_held_out_languages_are_not_read(real):
    docs = real("documents")
    turned = docs.withColumn("lang", F.when(lang.held_out(), F.lit("xx")).otherwise(F.col("lang")))
    a = lang.learn(docs, learn_from=~lang.held_out())
    b = lang.learn(turned, learn_from=~lang.held_out())
    assert a.langs == b.langs and (a.weights == b.weights).all()


def test_language_sample_is_dealt_over_the_languages(spark, monkeypatch):
    """Rare languages keep all lettered documents; letterless ones take nobody's place."""
    from barloom.llm import language_id

    rows = [(100 * k + i, f"l{k:02}", "some words") for k in range(30) for i in range(20)]
    rows += [(9000 + i, "rare", "rare words") for i in range(4)]
    rows += [(9100 + i, "mixed", "12 34" if i % 10 else "words") for i in range(60)]
    rows += [(9200, "none", "1"), (9201, "none", None)]
    seen = {}

    def sampled(found, fit):
        seen.update((r["lang"], r["count"]) for r in found.groupBy("lang").count().collect())
        return fit(iter(()))

    monkeypatch.setattr(language_id, "fitted", sampled)
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    language_id.learn(docs, language_id.Settings(per_lang=15, max_train=250))
    assert (seen.pop("rare"), seen.pop("mixed")) == (4, 6)
    assert len(seen) == 30 and sum(seen.values()) == 240 and set(seen.values()) == {8}


@pytest.mark.parametrize("per_lang", [1, 40, 5000])
def test_language_candidates_hold_the_smallest_hashes(spark, per_lang):
    """However rows repeat: half of one language are copies of the id with the smallest hash."""
    ids = spark.range(3000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 50 == 0, "b").otherwise("a").alias("lang"),
        F.xxhash64(F.lit(3), "id").alias("_h"))
    smallest = ids.where("lang = 'a'").orderBy("_h").limit(1).crossJoin(
        spark.range(3000).select(F.col("id").alias("n"))).drop("n")
    found = lang.candidates(ids.unionAll(smallest).repartition(5), per_lang).collect()
    assert len(found) == len({r["doc_id"] for r in found})
    for one in ("a", "b"):
        wanted = sorted(r["_h"] for r in ids.where(F.col("lang") == one).collect())[:per_lang]
        have = sorted(r["_h"] for r in found if r["lang"] == one)
        assert have[:per_lang] == wanted and len(have) <= 6 * per_lang + 10


def test_language_sample_ranks_few_rows(real):
    """The window over a language reads a written table of candidates, never the documents."""
    marked = real("documents").select("doc_id", "lang", F.xxhash64(F.lit(3), "doc_id").alias("_h"))
    plan = lang.candidates(marked.where("lang is not null"), 5)._jdf.queryExecution().toString()
    assert "candidates-" in plan and "documents.parquet" not in plan
