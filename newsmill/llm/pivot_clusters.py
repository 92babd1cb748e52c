"""Clustering of vectors around moving integer centroids, with a stored table of distances to fixed pivots (LAESA).

Components become integers floor(scale * x), so sums, means and squared distances are exact and do not depend on how rows
are dealt to tasks. A few pivots, spread by farthest-first choice over a bounded sample, are fixed once; the distance of
every vector to every pivot is stored beside it. In each round a vector's distance to a centroid is at least the largest
difference of their pivot distances, so only centroids whose bound does not exceed the best distance so far get an exact
distance. Bounds are floating-point numbers with slack far above rounding: they decide what is computed, never the result.

A round is one pass over the stored table: tasks add up their own vectors, one row of sums for each cluster and task is
shuffled, and k rows of centroids come to the driver. Nothing else does.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsmill.llm.tables import forget, stored

SAMPLE = 256  # vectors of the smallest hashes, of which the pivots and the first centroids are chosen
PIVOTS = 16
LARGEST = 1 << 27  # a component beyond this has no squared distance that a long could hold for 64 components
SLACK = 1e-12


class Clusters(NamedTuple):
    assigned: DataFrame  # vec_id, cluster, distance, n_exact
    centroids: list[list[int]]
    sizes: list[int]
    inertia: list[int]


def integers(vectors: DataFrame, id_: str, vector: str, dims: int, scale: int) -> DataFrame:
    """Vectors of exactly `dims` components, none NULL, NaN, infinite or beyond LARGEST, as (id, v)."""
    scaled = F.transform(F.col(f"`{vector}`"), lambda x: x.cast("double") * F.lit(float(scale)))
    usable = (F.size("s") == dims) & F.forall("s", lambda x: x.isNotNull() & (F.abs(x) <= F.lit(float(LARGEST))))
    return (vectors.select(F.col(f"`{id_}`").alias("id"), scaled.alias("s")).filter(F.coalesce(usable, F.lit(False)))
            .select("id", F.transform("s", lambda x: F.floor(x).cast("int")).alias("v")))


def spread_out(sample: np.ndarray, n: int) -> np.ndarray:
    """`n` rows of the sample, each the farthest from those before; equal rows are taken once."""
    taken, near = [0], ((sample - sample[0]) ** 2).sum(1)
    while len(taken) < n and near.max() > 0:
        taken.append(int(near.argmax()))
        near = np.minimum(near, ((sample - sample[taken[-1]]) ** 2).sum(1))
    return sample[taken]


def distances(vectors: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Distances of vectors to points, from exact squares."""
    return np.sqrt(np.stack([np.einsum("ij,ij->i", d := vectors - p, d) for p in points], 1).astype(np.float64))


def nearest(vectors: np.ndarray, to_pivots: np.ndarray, centroids: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cluster and squared distance of each vector, and how many exact distances it took; ties go to the smaller number."""
    n = len(vectors)
    of_centroids = distances(centroids, pivots)
    gap = np.abs(to_pivots[:, None, :] - of_centroids[None])
    low = (gap - SLACK * (to_pivots[:, None, :] + of_centroids[None])).max(2)
    first = low.argmin(1)
    diff = vectors - centroids[first]
    best, cluster, exact = np.einsum("ij,ij->i", diff, diff), first.copy(), np.ones(n, np.int32)
    for c, centre in enumerate(centroids):
        rows = np.flatnonzero((first != c) & (low[:, c] <= np.sqrt(best.astype(np.float64)) * (1 + SLACK) + SLACK))
        diff = vectors[rows] - centre
        found = np.einsum("ij,ij->i", diff, diff)
        exact[rows] += 1
        closer = (found < best[rows]) | ((found == best[rows]) & (c < cluster[rows]))
        best[rows[closer]], cluster[rows[closer]] = found[closer], c
    return cluster.astype(np.int32), best, exact


def matrix(column: pa.Array | pa.ChunkedArray, kind: type) -> np.ndarray:
    """Lists of equal length as rows."""
    return np.asarray(column.flatten()).reshape(len(column), -1).astype(kind)


def each_batch(centroids: np.ndarray, pivots: np.ndarray) -> Callable:
    def assigned(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            if batch.num_rows:
                v = matrix(batch.column("v"), np.int64)
                yield batch.column("id"), v, *nearest(v, matrix(batch.column("to_pivots"), np.float64), centroids, pivots)
    return assigned


def moved(table: DataFrame, centroids: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """The centroids after one round: floored exact means, empty clusters unchanged."""
    k, dims = centroids.shape
    assign = each_batch(centroids, pivots)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros((k, dims), np.int64), np.zeros(k, np.int64)
        for _, v, cluster, _, _ in assign(batches):
            count += np.bincount(cluster, minlength=k)
            for c in np.unique(cluster):
                total[c] += v[cluster == c].sum(0)
        some = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(some, pa.int32()), pa.array(count[some]), pa.array(list(total[some]), pa.list_(pa.int64()))], ["cluster", "n", "sums"])

    parts = table.mapInArrow(sums, "cluster int, n long, sums array<long>").select("cluster", "n", F.posexplode("sums"))
    new = centroids.copy()
    for c, pos, n, total in parts.groupBy("cluster", "pos").agg(F.sum("n"), F.sum(F.col("col").cast("decimal(38,0)"))).collect():
        new[c, pos] = int(total) // n
    return new


def cluster(
    vectors: DataFrame, id_: str = "vec_id", vector: str = "embedding", k: int = 8, rounds: int = 10, dims: int = 64,
    scale: int = 1024, order: Callable[[Column], Column] | None = None,
) -> Clusters | None:
    """`rounds` rounds of assignment and floored means, then a last assignment; None if no vector is usable.

    The first centroids are the `k` usable vectors that come first by `order` of the id (smallest sha256 unless given),
    then by content; NULL ids come last. Fewer vectors give fewer centroids; equal ones may give equal centroids, of which the
    later stay empty. Vectors that are NULL, of another length, or that hold a NULL, non-finite or too large component
    (see LARGEST) take no part. Repeated rows are rows of their own. Columns other than id and vector are not read.
    """
    usable = integers(vectors, id_, vector, dims, scale)
    key = (order or (lambda x: F.sha2(x.cast("string").cast("binary"), 256)))(F.col("id"))
    first = usable.withColumn("_key", key).orderBy(F.col("_key").asc_nulls_last(), "v").limit(max(SAMPLE, k)).select("v").collect()
    if not first:
        return None
    sample = np.array([row[0] for row in first], np.int64)
    pivots, centroids = spread_out(sample, PIVOTS), sample[:k].copy()

    def with_pivots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                to = distances(matrix(batch.column("v"), np.int64), pivots)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), batch.column("v"), pa.array(list(to), pa.list_(pa.float64()))], ["id", "v", "to_pivots"])

    kind = usable.schema["id"].dataType.simpleString()
    table = stored(usable.mapInArrow(with_pivots, f"id {kind}, v array<int>, to_pivots array<double>"), "pivot-table")
    for _ in range(rounds):
        centroids = moved(table, centroids, pivots)
    assign = each_batch(centroids, pivots)

    def last(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, _, cluster, best, exact in assign(batches):
            yield pa.RecordBatch.from_arrays([ids, pa.array(cluster), pa.array(best), pa.array(exact)], [id_, "cluster", "distance", "n_exact"])

    assigned = stored(table.mapInArrow(last, f"`{id_}` {kind}, cluster int, distance long, n_exact int"), "pivot-clusters")
    forget(table)
    sizes, inertia = [0] * len(centroids), [0] * len(centroids)
    for c, n, total in assigned.groupBy("cluster").agg(F.count(F.lit(1)), F.sum(F.col("distance").cast("decimal(38,0)"))).collect():
        sizes[c], inertia[c] = n, int(total)
    return Clusters(assigned, centroids.tolist(), sizes, inertia)


def with_statistics(found: Clusters) -> DataFrame:
    """Every vector's row with `cluster_inertia`, `inertia` (NULL beyond a long) and `centroid_sha256`.

    The table of clusters has k rows.
    """
    whole = sum(found.inertia)
    rows = [(c, total if total < 1 << 63 else None, whole if whole < 1 << 63 else None, hashlib.sha256(",".join(map(str, centre)).encode()).hexdigest())
            for c, (centre, total) in enumerate(zip(found.centroids, found.inertia, strict=True))]
    each = found.assigned.sparkSession.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.assigned.join(F.broadcast(each), "cluster")
