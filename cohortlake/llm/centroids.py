"""Clustering around centroids in whole numbers, with a distance matrix that is kept and corrected, not computed again.

Nearness to a centroid c is c.c - 2 v.c, as v.v is the same for all. Each vector's row of exact dot
products is stored with it. When a round has moved the centroids, only their changed components count:
v.c grows by the sum of v[d] * change[d] over the components d that changed, and a centroid that stayed
costs nothing. Sums of clusters are corrected in the same way, by the vectors that changed sides.

All arithmetic is in 64-bit integers and exact; results don't depend on the order of rows or tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import dropped, stored

DIMENSIONS, CLUSTERS, ROUNDS, SCALE, SEED = 64, 8, 10, 1024, "3"
#: Larger components would not leave room for exact distances in 64 bits.
LARGEST = 1 << 27


def whole_vectors(vectors: DataFrame, id: str, vector: str, dimensions: int) -> DataFrame:
    """`id` and `v`: floor(SCALE * x) of each component as packed 32-bit integers, of vectors that have all components and only finite ones."""
    x = F.col(f"`{vector}`").cast("array<double>")
    v = F.when((F.size(x) == dimensions) & ~F.exists(x, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf"))), x)
    base = vectors.select(F.col(f"`{id}`").alias("id"), v.alias("x")).where("x IS NOT NULL")
    id_type = base.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            real = np.floor(b.column(1).flatten().to_numpy() * SCALE).reshape(-1, dimensions)  # scaling by a power of two is exact
            if (np.abs(real) > LARGEST).any():
                raise ValueError(f"components beyond {LARGEST / SCALE:g} have no exact distances in 64 bits")
            yield pa.RecordBatch.from_arrays([b.column(0), _packed(real.astype("<i4"))], names=["id", "v"])

    return base.mapInArrow(run, f"id {id_type}, v binary")


def _packed(a: np.ndarray) -> pa.Array:
    """One binary value for each row."""
    a = np.ascontiguousarray(a)
    width = a.shape[1] * a.itemsize
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(width), len(a), [None, pa.py_buffer(a)]).cast(pa.binary())


def _unpacked(column: pa.Array, kind: str, width: int) -> np.ndarray:
    """The rows of a binary column as numbers; none is null and all have the same length."""
    _, offsets, data = column.buffers()
    if not len(column):
        return np.zeros((0, width), kind)
    start = np.frombuffer(offsets, np.int32)[column.offset]
    return np.frombuffer(data, kind, len(column) * width, int(start)).reshape(-1, width)


def first_centroids(vectors: DataFrame, clusters: int, dimensions: int, seed: str) -> np.ndarray:
    """Vectors with the smallest hashes of seed and id; equal ids are ordered by their vectors, a row without an id comes last."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    rows = vectors.select("v", key.alias("key")).orderBy(F.asc_nulls_last("key"), "v").limit(clusters).collect()  # `clusters` rows
    return np.array([np.frombuffer(r.v, "<i4") for r in rows], np.int64).reshape(len(rows), dimensions)


def corrected(dots: np.ndarray, v: np.ndarray, change: np.ndarray) -> np.ndarray:
    """Dot products after the centroids moved by `change` (clusters x components); components that stayed aren't touched."""
    dots = dots.copy()
    for k, row in enumerate(change):
        moved = np.flatnonzero(row)
        if len(moved):
            dots[:, k] += v[:, moved].astype(np.int64) @ row[moved]
    return dots


def assigned(state: DataFrame, change: np.ndarray, centroids: np.ndarray) -> DataFrame:
    """The next state: corrected dot products, the nearest centroid (`cluster`) and the one before (`was`)."""
    k, dimensions = centroids.shape
    norms = (centroids * centroids).sum(1)
    id_type = state.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            v, dots = _unpacked(b.column(1), "<i4", dimensions), _unpacked(b.column(2), "<i8", k)
            dots = corrected(dots, v, change)
            nearest = (norms - 2 * dots).argmin(1).astype(np.int32)  # the first of equals
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), _packed(dots.astype("<i8")), b.column(3), pa.array(nearest)], names=["id", "v", "dots", "was", "cluster"])

    return state.select("id", "v", "dots", F.col("cluster").alias("was")).mapInArrow(run, f"id {id_type}, v binary, dots binary, was int, cluster int")


def moves(state: DataFrame, clusters: int, dimensions: int) -> tuple[np.ndarray, np.ndarray]:
    """What the vectors that changed sides change in the clusters' sums and counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((clusters, dimensions + 1), np.int64)
        for b in batches:
            v = _unpacked(b.column(0), "<i4", dimensions).astype(np.int64)
            v = np.concatenate([v, np.ones((len(v), 1), np.int64)], 1)
            was, now = b.column(1).to_numpy(), b.column(2).to_numpy()
            for k in range(clusters):
                total[k] += v[now == k].sum(0) - v[was == k].sum(0)
        k, d = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(k, pa.int32()), pa.array(d, pa.int32()), pa.array(total[k, d])], names=["k", "d", "n"])

    changed = state.where("cluster <> was").select("v", "was", "cluster").mapInArrow(run, "k int, d int, n bigint")
    out = np.zeros((clusters, dimensions + 1), np.int64)
    # A row for each component of each cluster at most.
    for r in changed.groupBy("k", "d").agg(F.sum("n").alias("n")).collect():
        out[r.k, r.d] = r.n
    return out[:, :-1], out[:, -1]


def cluster_vectors(
    vectors: DataFrame, id: str = "vec_id", vector: str = "embedding", clusters: int = CLUSTERS, rounds: int = ROUNDS, dimensions: int = DIMENSIONS, seed: str = SEED
) -> tuple[DataFrame, np.ndarray]:
    """(`id`, `cluster`, `distance`) of every vector that takes part, and the final centroids.

    Centroids start as the vectors with the smallest hashes of their ids; each of `rounds` rounds assigns all
    vectors and moves every centroid that has any to the floor of their mean; then vectors are assigned
    once more. `distance` is squared. A vector that is null, has another number of components, or a null or
    non-finite one takes no part; with fewer vectors than `clusters` there are as many centroids; ties go
    to the smaller number; repeated rows count each. An empty table gives an empty result. Components
    are refused beyond 131072. The state of the last round is what is kept in the shared folder.
    """
    spark = vectors.sparkSession
    whole, path = stored(whole_vectors(vectors, id, vector, dimensions), "vectors")
    paths = [path]
    centroids = first_centroids(whole, clusters, dimensions, seed)
    n = len(centroids)
    change = centroids
    state = whole.select("*", F.lit(bytes(8 * n)).alias("dots"), F.lit(-1).alias("cluster"))
    sums, counts = np.zeros_like(centroids), np.zeros(n, np.int64)
    for left in range(rounds if n else 0, -1, -1):
        state, path = stored(assigned(state, change, centroids), "nearest")
        dropped(spark, paths.pop())  # the state before is no longer read
        paths.append(path)
        if left:
            more, members = moves(state, n, dimensions)
            sums, counts = sums + more, counts + members
            moved = np.where(counts[:, None] > 0, sums // np.maximum(counts, 1)[:, None], centroids)
            change, centroids = moved - centroids, moved
    norms = (centroids * centroids).sum(1)
    id_type = state.schema["id"].dataType.simpleString()

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v, dots, own = _unpacked(b.column(1), "<i4", dimensions).astype(np.int64), _unpacked(b.column(2), "<i8", n), b.column(3).to_numpy()
            distance = (v * v).sum(1) + norms[own] - 2 * dots[np.arange(len(own)), own] if len(own) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(3), pa.array(distance, pa.int64())], names=["id", "cluster", "distance"])

    out = state.select("id", "v", "dots", "cluster").mapInArrow(finish, f"id {id_type}, cluster int, distance bigint")
    return out.withColumnRenamed("id", id), centroids


def centroid_digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


def with_inertia(found: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Add `cluster_inertia`, `inertia` and `centroid_sha256` to the rows of `cluster_vectors`."""
    sums = {r.cluster: r.d for r in found.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()}  # a row for each cluster
    own = lambda values, kind: F.element_at(F.array(*[F.lit(x).cast(kind) for x in values] or [F.lit(None).cast(kind)]), F.col("cluster") + 1)
    return found.withColumns({
        "cluster_inertia": own([sums.get(k, 0) for k in range(len(centroids))], "bigint"), "inertia": F.lit(sum(sums.values())).cast("bigint"),
        "centroid_sha256": own([centroid_digest(c) for c in centroids], "string"),
    })
