"""Centroid clustering of integer vectors by lookup tables.

Vectors are quantised once and kept in blocks: each dimension's occurring integer values, and for
each vector its places among them. In each round a block tabulates the squared difference between
every occurring value and every centroid's component; a vector's distances are then gathers from
these tables and sums. Sums are exact integers, so neither blocks nor partitions change a result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.work import no_rows, written

#: Vectors in a block; each round tabulates anew for each block.
BLOCK = 4096
#: Quantised components stay below this, so that 64 squared differences fit a long.
LIMIT = 1 << 27


@dataclass(frozen=True)
class Settings:
    """`size` components a vector, `scale` steps to 1, and the seed that picks first centroids."""

    clusters: int = 8
    rounds: int = 10
    size: int = 64
    scale: int = 1024
    seed: int = 3


def kept(vectors: DataFrame, vec: str, size: int) -> DataFrame:
    """The rows whose vector has exactly `size` components, all of them finite numbers."""
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.where((F.size(vec) == size) & finite)


def quantised(vec: str, scale: int) -> Column:
    """floor(scale * x) of each component; one that can't be used in exact sums is an error."""
    def step(x: Column) -> Column:
        scaled = F.floor(x.cast("double") * scale)
        fits = F.abs(x.cast("double") * scale) < LIMIT
        error = F.raise_error(F.lit(f"a component is beyond {LIMIT} / {scale}"))
        return F.when(fits, scaled).otherwise(error.cast("long")).cast("int")

    return F.transform(vec, step)


def in_blocks(rows: DataFrame, size: int) -> DataFrame:
    """`rows` (vec_id, q) as blocks: vec_ids; values and starts, each dimension's occurring values
    one after the other; codes, the place of each component among the values, by dimension."""
    schema = pa.schema([
        ("vec_ids", pa.list_(pa.int64())), ("values", pa.list_(pa.int32())),
        ("starts", pa.list_(pa.int32())), ("codes", pa.binary())])

    def blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, BLOCK):
                part = batch.slice(a, BLOCK)
                q = part.column("q").flatten().to_numpy().reshape(-1, size)
                found = [np.unique(q[:, d], return_inverse=True) for d in range(size)]
                starts = np.cumsum([0, *(len(values) for values, _ in found)])
                yield pa.RecordBatch.from_pylist([{
                    "vec_ids": part.column("vec_id").to_pylist(),
                    "values": np.concatenate([values for values, _ in found]),
                    "starts": starts,
                    # A block has at most BLOCK values of a dimension.
                    "codes": np.stack([places for _, places in found]).astype("<u2").tobytes(),
                }], schema)

    return rows.mapInArrow(blocks, "vec_ids array<long>, values array<int>, starts array<int>, codes binary")


def distances(block: dict, centroids: np.ndarray) -> np.ndarray:
    """Squared distances of a block's vectors (rows) to the centroids (columns)."""
    values = np.asarray(block["values"], np.int64)
    starts = block["starts"]
    codes = np.frombuffer(block["codes"], "<u2").reshape(len(starts) - 1, -1)
    out = np.zeros((codes.shape[1], len(centroids)), np.int64)
    for d, places in enumerate(codes):
        table = (values[starts[d]:starts[d + 1], None] - centroids[None, :, d]) ** 2
        out += table[places]
    return out


def _each_block(blocks: DataFrame, centroids: list[list[int]], result, schema: str) -> DataFrame:
    """`result(block, cluster, distance)` of each block: its vectors' nearest centroids."""
    table = np.array(centroids, np.int64)

    def one(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                names = batch.schema.names
                block = {n: batch.column(n)[row] for n in names}
                block = {
                    "vec_ids": block["vec_ids"].values, "codes": block["codes"].as_py(),
                    "values": block["values"].values.to_numpy(),
                    "starts": block["starts"].values.to_numpy()}
                far = distances(block, table)
                nearest = far.argmin(axis=1)  # the first of equals
                yield result(block, nearest, far[np.arange(len(far)), nearest])

    return blocks.mapInArrow(one, schema)


def _totals(block: dict, cluster: np.ndarray, _: np.ndarray) -> pa.RecordBatch:
    """(cluster, n, sums) of a block; a block's sums stay far below a long."""
    values, starts = block["values"].astype(np.int64), block["starts"]
    codes = np.frombuffer(block["codes"], "<u2").reshape(len(starts) - 1, -1)
    components = np.stack([values[starts[d]:][places] for d, places in enumerate(codes)], axis=1)
    present = np.unique(cluster)
    return pa.RecordBatch.from_pydict({
        "cluster": pa.array(present, pa.int32()),
        "n": pa.array([int((cluster == c).sum()) for c in present], pa.int64()),
        "sums": pa.array([components[cluster == c].sum(axis=0) for c in present],
                         pa.list_(pa.int64()))})


def _assigned(block: dict, cluster: np.ndarray, distance: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({
        "vec_id": block["vec_ids"], "cluster": pa.array(cluster, pa.int32()),
        "distance": pa.array(distance, pa.int64())})


def moved(blocks: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """The centroids after a round: floors of the means of their vectors, or as they were.

    What reaches the driver is a row for each cluster and dimension.
    """
    totals = _each_block(blocks, centroids, _totals, "cluster int, n long, sums array<long>")
    by_dimension = totals.select("cluster", "n", F.posexplode("sums").alias("d", "total"))
    exact = by_dimension.groupBy("cluster", "d").agg(
        F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(20,0)")).alias("total"))
    new = [list(c) for c in centroids]
    for cluster, d, n, total in exact.collect():
        new[cluster][d] = int(total) // n
    return new


def first_centroids(rows: DataFrame, settings: Settings) -> list[list[int]]:
    """Vectors with the smallest hashes of seed and id; fewer if there are fewer vectors."""
    digest = F.sha2(F.concat(F.lit(f"{settings.seed}:"), F.col("vec_id").cast("string")), 256)
    order = [F.col("vec_id").isNull(), digest, F.col("q")]
    return [list(r["q"]) for r in rows.orderBy(*order).limit(settings.clusters).collect()]


def centroid_digest(centroid: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest()


def cluster(
    vectors: DataFrame, settings: Settings = Settings(), vec_id: str = "vec_id",
    vec: str = "embedding",
) -> tuple[DataFrame, list[list[int]]]:
    """One row for each kept vector (vec_id, cluster, distance), and the final centroids.

    Kept are vectors with exactly `size` components, none null or non-finite; a null or empty vector
    is not. No other column is read. The first centroids are the vectors with the smallest sha256 of
    `<seed>:<id>`; of rows with one id the smaller vector comes first, and rows with a null id come
    after all others. Each round assigns every vector to the nearest centroid, of equally near ones
    to the smaller number, and moves each centroid that has vectors to the floor of their mean.
    Fewer vectors than clusters give as many clusters as vectors; none give no rows. Repeated rows
    count as often as they are there. A component beyond 2^27 steps is an error.
    """
    spark = vectors.sparkSession
    rows = kept(vectors, vec, settings.size).select(
        F.col(vec_id).cast("long").alias("vec_id"), quantised(vec, settings.scale).alias("q"))
    centroids = first_centroids(rows, settings)
    if not centroids:
        schema = spark.createDataFrame([], "vec_id long, cluster int, distance long").schema
        return no_rows(spark, schema), []
    blocks = written(in_blocks(rows, settings.size), "blocks")
    for _ in range(settings.rounds):
        centroids = moved(blocks, centroids)
    return _each_block(
        blocks, centroids, _assigned, "vec_id long, cluster int, distance long"), centroids


def with_inertia(assigned: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """`assigned` with cluster_inertia, inertia and centroid_sha256.

    Inertia is summed exactly; a sum that doesn't fit a long is null.
    """
    spark = assigned.sparkSession
    rows = written(assigned, "assigned")
    sums = rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(20,0)")).alias("s"))
    by_cluster = {r["cluster"]: int(r["s"]) for r in sums.collect()}  # a row for each cluster

    def fitting(total: int) -> int | None:
        return total if total < 1 << 63 else None

    final = spark.createDataFrame(
        [(c, fitting(s), fitting(sum(by_cluster.values())), centroid_digest(centroids[c]))
         for c, s in by_cluster.items()],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return rows.join(F.broadcast(final), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
