"""The filter audit against running every order of the filters over plain rows."""

from __future__ import annotations

import re
from itertools import permutations

import pytest

from barloom.llm import filter_audit as op


def plain(docs, labels):
    mark = {}
    for i, quality, toxic in labels:
        good, bad = mark.get(i, (0, 0))
        mark[i] = (good or quality == 1, bad or toxic == 1)
    mark.pop(None, None)
    least = {}
    for i, text, _ in docs:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    parts = {}
    for i, text, lang in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {
            "A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 10 * len(text),
            "D": bool(re.search(r"[#$%&*|]", text)),
            "E": text in least and (i is None or least[text] < i)}
        parts.setdefault(lang or "", []).append((fails, *mark.get(i, (0, 0))))
    out = {}
    for part, rows in parts.items():
        shapley = dict.fromkeys("ABCDE", 0)
        for order in map("".join, permutations("ABCDE")):
            left = rows
            for step, f in enumerate(order, 1):
                gone = [r for r in left if r[0][f]]
                left = [r for r in left if not r[0][f]]
                failing = sum(r[0][f] for r in rows)
                only = sum(r[0][f] and sum(r[0].values()) == 1 for r in rows)
                shapley[f] += len(gone)
                out[part, order, step] = [
                    len(left), len(gone), failing - len(gone), only, sum(r[1] for r in gone),
                    sum(r[2] for r in gone)]
        for part_, order, step in out:
            if part_ == part:
                out[part, order, step].append(shapley[order[step - 1]])
    return out


def found(docs, labels):
    return {(r[0], r[1], r[2]): list(r[3:]) for r in op.filter_audit(docs, labels).collect()}


def labels_frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_odd_rows(spark, odd, odd_rows, none):
    marks = [(1, 1, 0), (1, 0, 1), (2, None, 1), (None, 1, 1), (6, 1, None), (12, 1, 0), (150, 0, 1),
             (160, 1, 0), (7777, 1, 1)]
    labels = labels_frame(spark, marks)
    docs = [(r[0], r[1], r[2]) for r in odd_rows]
    assert found(odd, labels) == plain(docs, marks)
    clashing = odd.withColumnRenamed("score", "part").withColumnRenamed("rank", "code")
    assert found(clashing, labels) == plain(docs, marks)
    assert found(none, labels) == {}
    assert found(odd, labels_frame(spark, [])) == plain(docs, [])


def test_copies_across_parts_and_null_ids(spark):
    text = " ".join(f"w{i}" for i in range(120))
    docs = [(5, text, "en"), (4, text, "de"), (4, text, "de"), (None, text, "de"), (9, text, None),
            (None, "only null ids", "en"), (None, "only null ids", "fr"), (2, text + " %", ""),
            (3, "A" * 30, "en")] + [(100 + i, text, "en") for i in range(300)]
    marks = [(4, 1, 1), (5, 1, 0), (101, 0, 1)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string").repartition(6)
    assert found(frame, labels_frame(spark, marks)) == plain(docs, marks)


@pytest.mark.parametrize("table", ["documents"])
def test_given_documents(spark, real, table):
    docs = [(r["doc_id"], r["text"], r["lang"]) for r in real(table).collect()]
    marks = [tuple(r) for r in real("labels").select("doc_id", "quality", "toxic").collect()]
    assert found(real(table), real("labels")) == plain(docs, marks)
