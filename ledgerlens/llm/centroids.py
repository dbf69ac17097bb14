"""Centroid clustering of integer vectors by scalar lookup tables.

Method.  Lloyd's rounds over vectors of whole numbers.  In each round a task
tabulates, per dimension, the squared difference of every occurring value to
every centroid; a vector's distances are then sums of table entries, gathered by
the value's number.  A table covers the rows of one Arrow batch, so it is bounded
by the batch whatever the values are, and holds one dimension at a time.  All
sums are whole numbers, so results do not depend on the partitioning.

Only the centroids and their sums (k times dimensions) pass through the driver.
The vectors are written once to the shared folder and read again each round.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import stored

#: Scaled components must stay below this, so that squared distances fit a long.
LARGEST = 1 << 27


def whole_vectors(rows: DataFrame, dims: int, scale: int, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, v: floor(scale * x) of the vectors with exactly ``dims`` components,
    none null, non-finite or too large (LARGEST after scaling)."""
    x = F.col(vector_col)
    scaled = F.transform(x, lambda c: c.cast("double") * scale)
    fine = F.forall(scaled, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < LARGEST))
    kept = rows.where((F.size(x) == dims) & F.coalesce(fine, F.lit(False)))
    return kept.select(F.col(id_col).cast("long").alias("vec_id"), F.transform(scaled, lambda c: F.floor(c).cast("int")).alias("v"))


def first_centroids(vectors: DataFrame, k: int, seed: int) -> np.ndarray:
    """The k vectors with the smallest sha256 of "<seed>:<id>", ties by the vector;
    null ids come last."""
    h = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    return np.array([r.v for r in vectors.orderBy(h.asc_nulls_last(), "v").limit(k).select("v").collect()], np.int64)  # k rows


def nearest(v: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid (ties: the smaller) and squared distance of
    each row, by one table of squared differences per dimension."""
    total = np.zeros((len(v), len(centroids)), np.int64)
    for d in range(v.shape[1]):
        values, at = np.unique(v[:, d], return_inverse=True)
        table = (values[:, None] - centroids[None, :, d]) ** 2
        total += table[at]
    best = total.argmin(axis=1)
    return best, total[np.arange(len(v)), best]


def _matrix(column, dims: int) -> np.ndarray:
    return np.asarray(column.flatten(), np.int64).reshape(-1, dims)


def _sums(vectors: DataFrame, centroids: np.ndarray) -> list:
    """Per cluster: rows and componentwise sums; partial sums per task."""
    k, dims = centroids.shape

    def run(batches):
        n, s = np.zeros(k, np.int64), np.zeros((k, dims), np.int64)
        for rows in batches:
            v = _matrix(rows.column(0), dims)
            if len(v):
                c, _ = nearest(v, centroids)
                order = np.argsort(c, kind="stable")
                at = np.flatnonzero(np.diff(c[order], prepend=-1))
                s[c[order[at]]] += np.add.reduceat(v[order], at, axis=0)
                n += np.bincount(c, minlength=k)
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(some, dims)), pa.array(np.tile(np.arange(dims), len(some))), pa.array(np.repeat(n[some], dims)), pa.array(s[some].ravel())],
            names=["c", "d", "n", "s"])

    return vectors.select("v").mapInArrow(run, "c long, d long, n long, s long").groupBy("c", "d").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).collect()


def clustered(rows: DataFrame, k: int = 40, rounds: int = 5, dims: int = 64, scale: int = 256, seed: int = 2,
              id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row per kept vector: vec_id, cluster, distance (squared),
    cluster_inertia, inertia, centroid_sha256.

    Other vectors (null, of another length, with a null, non-finite or too large
    component) take no part and have no row.  Repeated rows and ids each count and
    have a row each.  With fewer than k kept vectors there are as many centroids as
    vectors; with none, no rows.  Clusters without vectors keep their centroid.
    """
    spark = rows.sparkSession
    vectors = stored(whole_vectors(rows, dims, scale, id_col, vector_col), "vectors")
    centroids = first_centroids(vectors, k, seed)
    if not len(centroids):
        return spark.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    for _ in range(rounds):
        new = centroids.copy()
        for r in _sums(vectors, centroids):  # k * dims rows
            new[r.c, r.d] = r.s // r.n
        centroids = new

    def run(batches):
        for part in batches:
            c, d = nearest(_matrix(part.column(1), dims), centroids)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(c.astype(np.int32)), pa.array(d)], names=["vec_id", "cluster", "distance"])

    assigned = stored(vectors.mapInArrow(run, "vec_id long, cluster int, distance long"), "assigned")
    inertia = {r.cluster: r.s for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}  # k rows
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    facts = spark.createDataFrame([(c, s, sum(inertia.values()), digest[c]) for c, s in inertia.items()],
                                  "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
