"""Exact deduplication, SimHash, and connected components."""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict
from itertools import combinations

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from barloom.llm import binary_fuse, exact_dedup, simhash
from barloom.llm.components import components
from barloom.llm.queries import QUERIES


@pytest.mark.parametrize("n", [0, 1, 2, 3, 10, 100, 1000, 30_000])
def test_filter_has_no_false_negatives(n):
    rng = np.random.default_rng(n)
    keys = rng.integers(-(1 << 63), (1 << 63) - 1, n, np.int64)
    made = binary_fuse.build(np.concatenate((keys, keys[: n // 2])))
    assert binary_fuse.may_contain(made, keys).all()
    others = rng.integers(-(1 << 63), (1 << 63) - 1, 50_000, np.int64)
    assert binary_fuse.may_contain(made, others).mean() < (0.02 if n else 1e-9)
    if n >= 1000:
        assert len(made) < 1.5 * n


def squeezed(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


def expected_groups(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[squeezed(text)].append((-len(text or ""), doc_id is None, doc_id))
    return {body: (min(g)[2], len(g)) for body, g in groups.items()}


def check_decisions(found, rows):
    wanted = expected_groups(rows)
    assert len(found) == len(rows)
    texts = defaultdict(set)
    for doc_id, text in rows:
        texts[doc_id].add(squeezed(text))
    for r in found:
        bodies = [b for b in texts[r["doc_id"]] if hashlib.sha256(b.encode()).hexdigest() == r["sha"]]
        assert len(bodies) == 1
        assert (r["keep_id"], r["group_size"]) == wanted[bodies[0]]
    assert sum(r["kept"] for r in found) == len(wanted)
    assert all(r["keep_id"] == r["doc_id"] for r in found if r["kept"])


@pytest.mark.parametrize("batches", [1, 2, 4])
def test_decisions_on_odd_rows(odd, odd_rows, batches):
    found = exact_dedup.decisions(odd, batches).withColumnRenamed("digest", "sha").collect()
    check_decisions(found, [r[:2] for r in odd_rows])


def test_weak_digests_are_caught_by_the_bytes(odd, odd_rows):
    weak = exact_dedup.decisions(odd, 3, lambda body: F.substring(F.sha2(body, 256), 1, 1)).collect()
    wanted = expected_groups([r[:2] for r in odd_rows])
    assert sum(r["kept"] for r in weak) == len(wanted)
    assert sorted(r["group_size"] for r in weak if r["kept"]) == sorted(n for _, n in wanted.values())


def test_screening_keeps_every_member(spark):
    texts = spark.range(5000).select(
        F.sha2(F.col("id").cast("string"), 256).alias("digest"), F.lit(1).alias("check"),
        F.lit("").alias("body"))
    snapshot = exact_dedup.seal(texts)
    asked = spark.range(4000, 9000).select(
        "id", F.sha2(F.col("id").cast("string"), 256).alias("digest"))
    got = {r["id"] for r in exact_dedup.screened(asked, snapshot).collect()}
    assert set(range(4000, 5000)) <= got and len(got) < 1100


@pytest.mark.parametrize("weak", [False, True])
def test_batches_against_kept_snapshots(spark, odd, odd_rows, none, tmp_path, weak):
    """Batches that arrive one by one, with snapshots read from folders, against plain Python."""
    digest = (lambda body: F.substring(F.sha2(body, 256), 1, 1)) if weak else exact_dedup.sha256
    seen, kept = set(), 0
    for i in range(3):
        of_batch = [r[:2] for r in odd_rows if ((r[0] or 0) + len(r[1] or "")) % 3 == i]
        of_batch += [r[:2] for r in odd_rows[:12]] if i == 2 else []
        batch = spark.createDataFrame(of_batch, "doc_id long, text string").repartition(4)
        known = [exact_dedup.load(spark, str(tmp_path / f"{j}")) for j in range(i)]
        found, fresh = exact_dedup.screen(batch, known, digest)
        groups = expected_groups(of_batch)
        wanted = sorted(
            (str(d), len(t or ""), groups[squeezed(t)][1], squeezed(t) in seen) for d, t in of_batch)
        rows = found.collect()
        assert wanted == sorted(
            (str(r["doc_id"]), r["n_chars"], r["group_size"], r["seen"]) for r in rows)
        stay = {groups[b][0] for b in groups if b not in seen}
        assert {r["doc_id"] for r in rows if r["kept"]} == stay
        kept += sum(r["kept"] for r in rows)
        seen |= set(groups)
        exact_dedup.save(fresh, str(tmp_path / f"{i}"))
    assert kept == len(seen) == sum(
        exact_dedup.load(spark, str(tmp_path / f"{j}")).texts.count() for j in range(3))
    with pytest.raises(FileExistsError):
        exact_dedup.save(fresh, str(tmp_path / "0"))
    with pytest.raises(FileNotFoundError):
        exact_dedup.load(spark, str(tmp_path / "9"))
    found, fresh = exact_dedup.screen(none, known)
    assert found.count() == fresh.texts.count() == 0


def test_a_large_batch_asks_a_small_snapshot_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "SHARD_KEYS", 100)
    largest = spark.sparkContext.accumulator(0)
    asked = exact_dedup.may_contain

    def counted(made, keys):
        if len(keys) > 200:
            largest.add(1)
        return asked(made, keys)

    monkeypatch.setattr(exact_dedup, "may_contain", counted)
    digests = spark.range(5000).select(F.sha2(F.col("id").cast("string"), 256).alias("digest"))
    snapshot = exact_dedup.seal(digests.limit(0).unionAll(spark.range(50).select(
        F.sha2(F.col("id").cast("string"), 256).alias("digest"))))
    found = {r[0] for r in exact_dedup.screened(digests, snapshot).collect()}
    assert {hashlib.sha256(str(i).encode()).hexdigest() for i in range(50)} <= found
    assert len(found) < 200 and largest.value == 0


def test_exact_dedup_of_nothing(none):
    assert exact_dedup.decisions(none).count() == 0
    assert exact_dedup.drop_copies(none).count() == 0


def test_drop_copies_keeps_columns_and_one_of_each(odd, odd_rows):
    left = exact_dedup.drop_copies(odd)
    assert left.columns == odd.columns
    bodies = [squeezed(r["text"]) for r in left.collect()]
    assert sorted(bodies) == sorted({squeezed(r[1]) for r in odd_rows})


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    n = max(1, len(words) - 3)
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i:i + 4]).encode(), 42) for i in range(n)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(nodes, pairs):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def expected_components(rows, by_root=False):
    prints = [(i, plain_fingerprint(t)) for i, t in rows]
    unique = sorted({p for _, p in prints})
    root = roots(unique, [
        (a, b) for a, b in combinations(unique, 2) if (a ^ b).bit_count() <= 4])
    least = {r: None for r in root.values()}
    for i, p in prints:
        if i is not None:
            least[root[p]] = i if least[root[p]] is None else min(least[root[p]], i)
    if by_root:
        return sorted(least.values(), key=str)
    return sorted(((i, p, least[root[p]]) for i, p in prints), key=str)


def found_components(df):
    return sorted(((r["doc_id"], r["fp"] % (1 << 64), r["component_id"]) for r in df.collect()), key=str)


def test_simhash_on_odd_rows(odd, odd_rows):
    assert found_components(simhash.near_duplicates(odd)) == expected_components(
        [r[:2] for r in odd_rows])


def test_simhash_on_documents(real):
    docs = real("documents")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    assert found_components(simhash.near_duplicates(docs)) == expected_components(rows)


def test_simhash_query(spark):
    rows = QUERIES["op8_simhash"](spark, "/root/testdata/sf0.001").collect()
    assert all(re.fullmatch("[0-9a-f]{16}", r["fingerprint"]) for r in rows)
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(
        "/root/testdata/sf0.001/documents.parquet").collect()}
    assert all(int(r["fingerprint"], 16) == plain_fingerprint(texts[r["doc_id"]]) for r in rows)


def test_simhash_of_nothing(none):
    assert simhash.near_duplicates(none).count() == 0


@pytest.mark.parametrize("blocks", [5, 6, 7, 9])
def test_close_pairs_share_a_key(blocks):
    rng = np.random.default_rng(blocks)
    masks = simhash.masks(blocks, 4)
    for _ in range(300):
        a = int(rng.integers(0, 1 << 63))
        b = a
        for bit in rng.permutation(64)[:4]:
            b ^= 1 << int(bit)
        assert any(a & m == b & m for m in masks)


@pytest.mark.parametrize("run", [40, simhash.RUN])
def test_links_connect_all_close_pairs(spark, run):
    """A dense ball of near copies, a chain, and noise; short runs are dealt out in parts."""
    rng = np.random.default_rng(8)
    centre = int(rng.integers(0, 1 << 63))
    prints = {centre}
    for _ in range(400):
        p = centre
        for bit in rng.permutation(64)[:int(rng.integers(1, 5))]:
            p ^= 1 << int(bit)
        prints.add(p)
    step = int(rng.integers(0, 1 << 63))
    for bit in range(40):
        step ^= 1 << bit
        prints.add(step)
    prints |= {int(x) for x in rng.integers(0, 1 << 63, 1000)}
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    df = spark.createDataFrame([(p,) for p in signed], "fp long")
    found = [(r["u"] % (1 << 64), r["v"] % (1 << 64)) for r in simhash.links(df, run=run).collect()]
    assert all((a ^ b).bit_count() <= 4 for a, b in found)
    pairs = [(a, b) for a, b in combinations(prints, 2) if (a ^ b).bit_count() <= 4]
    assert roots(prints, found) == roots(prints, pairs)
    if run == simhash.RUN:
        assert len(found) < len(pairs) / 2


def test_drop_near_duplicates(odd, odd_rows):
    left = simhash.drop_near_duplicates(odd)
    assert left.columns == odd.columns
    kept = sorted((r["doc_id"] for r in left.collect()), key=str)
    assert kept == expected_components([r[:2] for r in odd_rows], by_root=True)


@pytest.mark.parametrize("kind", ["chain", "star", "random", "none", "loops"])
def test_components(spark, kind):
    rng = np.random.default_rng(9)
    edges = {
        "chain": [(i, i + 1) for i in range(100)], "star": [(50, i) for i in range(100)],
        "random": [tuple(map(int, rng.integers(-60, 60, 2))) for _ in range(70)],
        "none": [], "loops": [(3, 3), (4, 5), (5, 4), (4, 5)],
    }[kind]
    found = components(spark.createDataFrame(edges, "u long, v long")).collect()
    edges = [e for e in edges if e[0] != e[1]]
    nodes = {n for e in edges for n in e}
    assert {r["node"]: r["root"] for r in found} == roots(nodes, edges)
    assert len(found) == len(nodes)
