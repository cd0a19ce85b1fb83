"""SimHash near-duplicates: fingerprints that share pigeonhole blocks, verified by Hamming distance.

Two 64-bit fingerprints that differ in at most k bits, cut into m blocks, agree in at least m - k
of them. So every set of m - k blocks makes a join key, and each close pair meets under one key at
least; which m is used decides how selective the keys are, never which pairs are found. Equal
fingerprints are one before the join. Under a key, rows come sorted and are compared in numpy, run
by run; a run yields links that connect all it connects, at most one fewer than its members for a
long one, never all pairs. Keys too frequent for a task are dealt out as pairs of parts.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import free_names, matching_rows, shuffle_partitions
from barloom.llm.components import components
from barloom.work import written

SHINGLE = 4
DISTANCE = 4
SEED = 42
#: A run of rows with one key up to this length is compared in one task.
RUN = 50_000
#: Runs up to this length give every link; longer ones a spanning forest.
SHORT = 32


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The 64 majority bits of the XXH64 of all word shingles of a text, repeats included.

    A-Z are lower-cased. Fewer words than a shingle holds make one; a text without words (or null)
    has fingerprint 0. A bit is set if more than half of the hashes have it.
    """
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(joined, seed)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    hash_of = xxhash.xxh64_intdigest
    spans = zip(starts.tolist(), ends[shingle - 1:].tolist(), strict=False)
    hashes = np.array([hash_of(joined[a:b], seed) for a, b in spans], "<u8")
    counts = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 16):
        some = hashes[i:i + (1 << 16)].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(some, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def with_fingerprint(docs: DataFrame, out: str, shingle: int = SHINGLE) -> DataFrame:
    """`docs` with the fingerprint of `text` as a signed long; a column named `out` is replaced."""
    @F.arrow_udf("long")
    def prints(texts: pa.Array) -> pa.Array:
        found = (fingerprint(t.as_py(), shingle) for t in texts)
        return pa.array(np.fromiter(found, np.uint64, len(texts)).view(np.int64))

    return docs.withColumn(out, prints.asNondeterministic()("text"))


def masks(blocks: int, distance: int) -> list[int]:
    """Masks of all sets of `blocks - distance` of the blocks that 64 bits are cut into."""
    bounds = [round(64 * i / blocks) for i in range(blocks + 1)]
    block = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(bounds, bounds[1:], strict=False)]
    return [sum(c) for c in combinations(block, blocks - distance)]


def blocks_for(n: int, distance: int) -> int:
    """The fewest blocks whose keys have about as many bits as it takes to number n fingerprints."""
    m = distance + 1
    while 64 * (m - distance) / m < math.log2(max(n, 2)) + 1 and m < 4 * distance + 4:
        m += 1
    return m


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _run_links(run: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """A spanning forest of the links among the fingerprints of a long run."""
    label = np.arange(len(run))
    out = []
    for j in range(1, len(run)):
        near = np.flatnonzero(np.bitwise_count(run[:j] ^ run[j]) <= distance)
        if len(near):
            groups, first = np.unique(label[near], return_index=True)
            out += [(run[j], run[i]) for i in near[first]]
            label[j] = groups[0]
            if len(groups) > 1:
                label[:j][np.isin(label[:j], groups[1:])] = groups[0]
    return out


def _links(key: np.ndarray, prints: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links within runs of equal keys; rows are sorted by key, and runs are whole."""
    change = np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1
    starts = np.concatenate(([0], change))
    ends = np.concatenate((change, [len(key)]))
    a, b = [np.empty(0, np.uint64)], [np.empty(0, np.uint64)]
    left = np.repeat(ends, ends - starts) - np.arange(len(key))  # rows of the run from here on
    short = np.repeat(ends - starts, ends - starts) <= SHORT
    for step in range(1, SHORT):
        i = np.flatnonzero(short & (left > step))
        if not len(i):
            break
        close = i[np.bitwise_count(prints[i] ^ prints[i + step]) <= distance]
        a.append(prints[close])
        b.append(prints[close + step])
    for i in np.flatnonzero(ends - starts > SHORT):
        if found := _run_links(np.unique(prints[starts[i]:ends[i]]), distance):
            u, v = zip(*found, strict=True)
            a.append(np.array(u, np.uint64))
            b.append(np.array(v, np.uint64))
    return np.concatenate(a), np.concatenate(b)


def _compare(distance: int):
    keys = ("mask", "bits", "part", "other")

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_key, held = np.empty((0, len(keys)), np.int64), np.empty(0, np.uint64)

        def found(key: np.ndarray, prints: np.ndarray) -> pa.RecordBatch:
            u, v = _links(key, prints, distance)
            return pa.RecordBatch.from_pydict(
                {"u": pa.array(u.view(np.int64)), "v": pa.array(v.view(np.int64))})

        for batch in batches:
            if not batch.num_rows:
                continue
            key = np.stack([batch.column(k).to_numpy().astype(np.int64) for k in keys], axis=1)
            key = np.concatenate((held_key, key))
            prints = np.concatenate((held, batch.column("fp").to_numpy().view(np.uint64)))
            # The last run may go on in the next batch.
            cut = np.flatnonzero((key != key[-1]).any(axis=1))
            cut = int(cut[-1]) + 1 if len(cut) else 0
            held_key, held = key[cut:], prints[cut:]
            if cut:
                yield found(key[:cut], prints[:cut])
        if len(held):
            yield found(held_key, held)

    return compare


def links(prints: DataFrame, distance: int = DISTANCE, run: int = RUN) -> DataFrame:
    """(u, v): links that connect every two of the distinct fingerprints `fp` that are close.

    `prints` is a written table of distinct signed longs. Every pair at `distance` bits or fewer is
    connected by a path of links, and every link is such a pair.
    """
    chosen = masks(blocks_for(prints.count(), distance), distance)
    keys = F.array(*(
        F.struct(F.lit(i).alias("mask"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("bits"))
        for i, m in enumerate(chosen)))
    rows = prints.select("fp", F.inline(keys))
    counts = rows.groupBy("mask", "bits").agg(F.count(F.lit(1)).alias("n"))
    heavy = written(counts.where(F.col("n") > run), "heavy")
    dealt = rows.withColumn("part", F.lit(0)).withColumn("other", F.lit(0))
    if not heavy.isEmpty():
        light = dealt.join(heavy, ["mask", "bits"], "left_anti")
        # Parts of half a run; a row goes to the pairs of its part with each part.
        parts = F.ceil(2 * F.col("n") / run).cast("int")
        own = F.pmod(F.xxhash64("fp"), parts).cast("int")
        pairs = rows.join(heavy, ["mask", "bits"]).withColumn("own", own).withColumn(
            "with", F.explode(F.sequence(F.lit(0), parts - 1)))
        dealt = light.unionByName(pairs.select(
            "fp", "mask", "bits", F.least("own", "with").alias("part"),
            F.greatest("own", "with").alias("other")))
    key = ["mask", "bits", "part", "other"]
    ordered = dealt.repartition(shuffle_partitions(prints.sparkSession), *key).sortWithinPartitions(
        *key, "fp")
    return ordered.mapInArrow(_compare(distance), "u long, v long")


def _grouped(docs: DataFrame, shingle: int, distance: int, run: int) -> DataFrame:
    """doc_id, fp, the fingerprint `root` that stands for its component, and component_id."""
    rows = written(with_fingerprint(docs.select("doc_id", "text"), "fp", shingle).drop("text"), "fp")
    distinct = written(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "prints")
    tied = components(links(distinct.select("fp"), distance, run))
    tied = written(tied.withColumnRenamed("node", "fp"), "members")
    rooted = written(
        distinct.join(tied, "fp", "left").withColumn("root", F.coalesce("root", "fp")), "rooted")
    least = written(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "roots")
    joined = written(rooted.drop("least").join(least, "root"), "components")
    return rows.join(joined, "fp")


def near_duplicates(
    docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE, run: int = RUN,
) -> DataFrame:
    """One row for each row of `docs`: doc_id, fp (signed long) and component_id.

    `docs` needs doc_id and text. Texts whose fingerprints differ in at most `distance` bits are
    linked, texts without words too, whose fingerprint is 0; component_id is the smallest doc_id
    that can be reached. Null ids are no smallest id: a component of none but null ids has a null
    component_id. Repeated rows share a component. An empty table gives an empty result.
    """
    return _grouped(docs, shingle, distance, run).select("doc_id", "fp", "component_id")


def drop_near_duplicates(
    docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE,
) -> DataFrame:
    """The rows of `docs`, unchanged, one for each component: that of the smallest doc_id.

    Of several rows with that id the one of the smallest fingerprint stays, and of equal
    fingerprints any.
    """
    found = _grouped(docs, shingle, distance, RUN)
    candidates = found.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    counts = candidates.groupBy("root", "fp", "doc_id").agg(F.count(F.lit(1)).alias("n_rows"))
    first = counts.groupBy("root").agg(F.min(F.struct("fp", "doc_id", "n_rows")).alias("row"))
    (name,) = free_names(docs, "_fp")
    keys = first.select("row.doc_id", F.col("row.fp").alias(name), "row.n_rows")
    marked = with_fingerprint(docs, name, shingle)
    return matching_rows(marked, keys, ["doc_id", name]).drop(name)
