"""The pipeline against plain Python stage by stage, and stages that keep every column."""

from __future__ import annotations

from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from barloom.llm import language_id, length_packing
from barloom.llm import quality_classifier as classifier
from barloom.llm.common import free_names
from barloom.llm.entropy_mixing import mix
from test_llm_corpus import check_mix, check_packing
from test_llm_dedup import plain_fingerprint, roots, squeezed

SF = "/root/testdata/sf0.001"
SCRATCH = ["_digest", "_n_chars", "_fp", "_score", "_size", "_hash", "_row", "_copies", "_again",
           "n_rows", "n_rows_", "_part", "_at", "_before", "_tie", "rank", "size", "copies", "fp",
           "digest", "check", "body", "score", "row", "root", "label", "once"]


@pytest.fixture(scope="module")
def docs(spark):
    """Given documents, with null ids, repeated rows, and null and empty texts among them."""
    given = spark.read.parquet(f"{SF}/documents.parquet").limit(120)
    more = spark.createDataFrame(
        [(None, "no id and a few words here", "en", "s1", 26), (None, None, None, None, None),
         (9001, "", "en", "s1", 0), (9002, None, "en", "s2", None)], given.schema)
    again = given.where("doc_id % 10 = 3")
    other_ids = again.withColumn("doc_id", F.col("doc_id") + 10_000)
    return given.unionByName(more).unionByName(again).unionByName(other_ids)


def pairs(rows):
    return Counter((r["doc_id"], r["text"]) for r in rows)


def test_each_stage_against_plain_python(spark, docs, tmp_path):
    stages = dict(corpus_pipeline.STAGES)

    def after(name, given):
        out = stages[name](spark, given, SF)
        assert out.columns == given.columns
        out.write.parquet(str(tmp_path / name))
        return spark.read.parquet(str(tmp_path / name))

    labels = spark.read.parquet(f"{SF}/labels.parquet")
    kept = after("quality classifier", docs)
    judged = classifier.quality_classifier(docs, labels).collect()
    assert pairs(kept.collect()) == pairs(
        [r for r in judged if r["score"] >= classifier.SETTINGS.threshold])

    rows = kept.collect()
    single = after("exact dedup", kept)
    groups = defaultdict(list)
    for r in rows:
        groups[squeezed(r["text"])].append(
            (-len(r["text"] or ""), r["doc_id"] is None, r["doc_id"], r["text"]))
    assert pairs(single.collect()) == Counter(
        min(g, key=lambda x: x[:3])[2:] for g in groups.values())

    rows = single.collect()
    apart = after("simhash near-dedup", single)
    prints = [(r, plain_fingerprint(r["text"])) for r in rows]
    unique = sorted({p for _, p in prints})
    root = roots(unique, [(a, b) for i, a in enumerate(unique) for b in unique[:i]
                          if (a ^ b).bit_count() <= 4])
    members = defaultdict(list)
    for r, p in prints:
        members[root[p]].append((r["doc_id"] is None, r["doc_id"] or 0, p, r["text"] or ""))
    left = apart.collect()
    assert len(left) == len(members)
    assert sorted(r["doc_id"] or 0 for r in left) == sorted(min(m)[1] for m in members.values())
    assert not pairs(left) - pairs(rows)

    mixed = after("mixing sources to target weights", apart)
    dealt = mix(apart).collect()
    check_mix(dealt, [(r["doc_id"], r["text"], r["source"]) for r in left])
    wanted = Counter()
    for r in dealt:
        wanted[r["doc_id"]] += r["copies"] if r["size"] else 1
    got = mixed.collect()
    assert Counter(r["doc_id"] for r in got) == +wanted
    assert set(pairs(got)) <= set(pairs(left))

    placed = stages["packing"](spark, mixed, SF).collect()
    check_packing(placed, [(r["doc_id"], r["text"]) for r in got], length_packing.SETTINGS)


def test_stages_keep_columns_of_any_name(spark, docs):
    """Columns named like whatever a stage calls its own: all are there, with their values."""
    named = docs.select(
        "*", *(F.concat(F.lit(f"{n}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("none")))
               .alias(n) for n in SCRATCH))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, named, SF)
        assert out.columns == named.columns, name
        rows = out.collect()
        assert rows
        for r in rows:
            i = "none" if r["doc_id"] is None else r["doc_id"]
            assert all(r[n] == f"{n}:{i}" for n in SCRATCH), name
        plain = stage(spark, docs, SF).collect()
        assert pairs(rows) == pairs(plain), name
    assert corpus_pipeline.STAGES[-1][1](spark, named, SF).count() >= named.count()


def test_language_id_keeps_columns_of_any_name(docs):
    named = docs.withColumn("_found", F.col("doc_id")).withColumn("_FOUND_", F.lit("x"))
    assert free_names(named, "_found", "_new", "_new") == ["_found__", "_new", "_new_"]
    out = language_id.language_id(named)
    assert {*named.columns, "lang_pred"} <= set(out.columns)
    assert all(r["_found"] == r["doc_id"] and r["_FOUND_"] == "x" for r in out.collect())
