"""Centroid clustering against plain Python, whatever the blocks and partitions."""

from __future__ import annotations

import hashlib
import math
import random

import pytest

from barloom.llm import centroids as op
from barloom.llm.centroids import Settings

SCHEMA = "vec_id long, embedding array<double>, cluster string, q int"


def plain(rows, s):
    kept = [(i, [math.floor(s.scale * x) for x in v]) for i, v in rows
            if v is not None and len(v) == s.size and all(x is not None and math.isfinite(x) for x in v)]

    def first(row):
        i, q = row
        return i is None, hashlib.sha256(f"{s.seed}:{i}".encode()).hexdigest() if i is not None else "", q

    centers = [q for _, q in sorted(kept, key=first)[:s.clusters]]

    def nearest(q):
        far = [sum((a - b) ** 2 for a, b in zip(q, c, strict=True)) for c in centers]
        return far.index(min(far)), min(far)

    for _ in range(s.rounds):
        member = [nearest(q)[0] for _, q in kept]
        for c in range(len(centers)):
            of = [q for (_, q), m in zip(kept, member, strict=True) if m == c]
            if of:
                centers[c] = [sum(x) // len(of) for x in zip(*of, strict=True)]
    out = [(i, *nearest(q)) for i, q in kept]
    total = {c: sum(d for _, k, d in out if k == c) for c in range(len(centers))}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centers]
    return sorted((str(i), c, d, total[c], sum(total.values()), digest[c]) for i, c, d in out)


def found(df, s):
    rows = op.with_inertia(*op.cluster(df, s)).collect()
    return sorted((str(r["vec_id"]), *r[1:]) for r in rows)


def rows_of(size, n, seed=1):
    rng = random.Random(seed)
    rows = [(i, [rng.gauss(i % 5, 0.6) for _ in range(size)]) for i in range(n)]
    rows += [(n, [0.1] * size)] * 40  # copies
    rows += [(None, [0.5] * size), (None, [2.0] * size), (3, [-1.0] * size)]
    rows += [(900, None), (901, []), (902, [1.0] * (size - 1)), (903, [1.0] * (size + 1)),
             (904, [None] + [1.0] * (size - 1)), (905, [math.nan] + [1.0] * (size - 1)),
             (906, [math.inf] + [1.0] * (size - 1)), (907, [-math.inf] * size)]
    return rows


@pytest.mark.parametrize("partitions, block", [(1, 4096), (7, 13)])
def test_against_plain_python(spark, monkeypatch, partitions, block):
    monkeypatch.setattr(op, "BLOCK", block)
    s = Settings(clusters=6, rounds=4, size=5)
    rows = rows_of(5, 180)
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(partitions)
    assert found(df, s) == plain(rows, s)


def test_few_equal_and_no_vectors(spark):
    s = Settings(clusters=8, rounds=3, size=2)
    for rows in ([(1, [1.0, 2.0])], [(i, [0.25, -0.25]) for i in range(20)],
                 [(i, [float(i % 2), 0.0]) for i in range(30)]):
        df = spark.createDataFrame([(*r, None, None) for r in rows], SCHEMA)
        assert found(df, s) == plain(rows, s)
    assert found(spark.createDataFrame([], SCHEMA), s) == []
    assert found(spark.createDataFrame([(1, None, None, None)], SCHEMA), s) == []


def test_values_too_large_to_sum(spark):
    s = Settings(clusters=2, rounds=2, size=2)
    big = op.LIMIT / s.scale - 1
    rows = [(1, [big, -big]), (2, [-big, big]), (3, [0.0, 0.0])]
    df = spark.createDataFrame([(*r, None, None) for r in rows], SCHEMA)
    assert found(df, s) == plain(rows, s)
    over = spark.createDataFrame([(1, [1e30, 0.0], None, None)], SCHEMA)
    with pytest.raises(Exception, match="component is beyond"):
        op.cluster(over, s)


def test_given_embeddings(real):
    rows = [(r["vec_id"], list(r["embedding"])) for r in real("embeddings").collect()]
    s = Settings(rounds=3)
    assert found(real("embeddings"), s) == plain(rows, s)
