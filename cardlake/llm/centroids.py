"""Centroid clustering of integer vectors with a pivot table (LAESA).

Vectors become integers, ``floor(scale * x)``, and all that decides is exact:
squared distances and sums are integers, means are floors.

* Pivots are fixed: the first ``pivots`` starting centroids.  Each vector's
  distance to each pivot is computed once and stored with it.
* In a round, a centroid's distance to a vector is at least the largest
  difference of their distances to a pivot (the triangle inequality).  The
  centroid of the lowest bound is measured first; of the others only those
  whose bound doesn't exceed that distance get an exact integer distance.
  Bounds are taken a little lower than computed, so rounding excludes nothing;
  ties go to the smaller number.
* A task adds up its vectors by cluster, so a round shuffles one row for a task
  and cluster, however many vectors a cluster holds; the driver holds the
  centroids (``k`` by ``dims`` integers) and nothing of the vectors.

The start is fixed by the ids: the ``k`` kept vectors with the smallest
SHA-256 of ``<seed>:<id>``.  A centroid without vectors stays where it is.

Defined cases: left out are vectors that are null, have another number of
components, or hold one that is null, not finite, or of 2**27 or more as an
integer (their squared distances wouldn't fit a long); rows under a null id
are clustered, but start no centroid; repeated ids and equal vectors are rows
of their own; with fewer than ``k`` vectors there are as many centroids as
vectors; an empty table gives an empty one; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardlake.llm.common import small, written

LIMIT = 1 << 27  # exclusive bound of an integer component
SLACK = 1e-9     # of the distances: many times the rounding of a square root and a difference


def whole_numbers(v: Column, scale: int) -> Column:
    """``floor(scale * x)`` of each component; null for a vector that holds a null, a
    non-finite number or one that is too large."""
    x = F.transform(v, lambda c: c.cast("double") * scale)
    fits = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (c < LIMIT) & (c >= -LIMIT))
    return F.when(fits, F.transform(x, lambda c: F.floor(c).cast("int")))


def as_rows(column: pa.Array, dims: int) -> np.ndarray:
    """An Arrow list column of ``dims`` integers each as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dims).astype(np.int64)


def _squares(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    d = x - c
    return np.einsum("ij,ij->i", d, d)


def pivot_distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.stack([_squares(x, p) for p in pivots], 1).astype(float))


def assign(x: np.ndarray, to_pivots: np.ndarray, centroids: np.ndarray, pivots: np.ndarray) -> tuple:
    """(number of the nearest centroid, exact squared distance, how many were measured)."""
    of_centroids = pivot_distances(centroids, pivots)
    lowest = np.zeros((len(x), len(centroids)))
    for p in range(len(pivots)):
        mine, theirs = to_pivots[:, p, None], of_centroids[None, :, p]
        np.maximum(lowest, np.abs(mine - theirs) - SLACK * (mine + theirs + 1), out=lowest)
    best = lowest.argmin(1)
    distance = _squares(x, centroids[best])
    measured = len(x)
    first = best.copy()
    for c in range(len(centroids)):
        rows = np.flatnonzero((first != c) & (lowest[:, c] <= np.sqrt(distance) * (1 + SLACK)))
        measured += len(rows)
        d = _squares(x[rows], centroids[c])
        nearer = (d < distance[rows]) | ((d == distance[rows]) & (c < best[rows]))
        best[rows[nearer]], distance[rows[nearer]] = c, d[nearer]
    return best, distance, measured


def starting_vectors(points: DataFrame, k: int, seed: int) -> np.ndarray:
    """The ``k`` vectors whose ids have the smallest hashes, in that order."""
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")).cast("binary"), 256)
    rows = points.where("id is not null").select(order.alias("h"), "x").orderBy("h", "x").limit(k).collect()
    return np.array([r["x"] for r in rows], np.int64)


def pivot_table(points: DataFrame, pivots: np.ndarray) -> DataFrame:
    """(id, x, to_pivots): the vectors with their distances to the pivots."""
    dims = pivots.shape[1]

    def run(batches):
        for b in batches:
            near = pivot_distances(as_rows(b["x"], dims), pivots)
            kept = pa.FixedSizeListArray.from_arrays(pa.array(near.ravel()), len(pivots)).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([b["id"], b["x"], kept], names=["id", "x", "to_pivots"])

    kind = dict(points.dtypes)["id"]
    return written(points.select("id", "x").mapInArrow(run, f"id {kind}, x array<int>, to_pivots array<double>"),
                   "pivot-table")


def _read(b: pa.RecordBatch, centroids: np.ndarray, pivots: np.ndarray) -> tuple:
    x = as_rows(b["x"], pivots.shape[1])
    near = b["to_pivots"].flatten().to_numpy().reshape(len(x), len(pivots))
    return (x, *assign(x, near, centroids, pivots))


def next_centroids(table: DataFrame, centroids: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Floors of the means of the vectors nearest to each centroid; empty ones stay."""
    k, dims = centroids.shape

    def run(batches):
        n, total = np.zeros(k, np.int64), np.zeros((k, dims), object)  # Python's integers don't overflow
        for b in batches:
            x, best, _, _ = _read(b, centroids, pivots)
            for c in np.unique(best):
                mine = x[best == c]
                n[c] += len(mine)
                total[c] += mine.sum(0)
        found = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(found, pa.int32()), pa.array(n[found]),
             pa.array([[str(v) for v in total[c]] for c in found], pa.list_(pa.string()))],
            names=["cluster", "n", "total"])

    parts = table.mapInArrow(run, "cluster int, n long, total array<string>")
    sums = (parts.select("cluster", "n", F.posexplode("total").alias("at", "v")).groupBy("cluster", "at")
            .agg(F.sum("n").alias("n"), F.sum(F.col("v").cast("decimal(38,0)")).alias("v")))
    out = centroids.copy()
    for r in sums.collect():  # k * dims numbers
        out[r["cluster"], r["at"]] = int(r["v"]) // r["n"]
    return out


def clustered(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", dims: int = 64, scale: int = 64,
              k: int = 16, rounds: int = 3, seed: int = 1, pivots: int = 8) -> DataFrame:
    """(key, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every kept vector;
    distances are squared and belong to the centroids after the last round."""
    x = F.when(F.size(vector) == dims, whole_numbers(F.col(vector), scale))
    points = vectors.select(F.col(key).alias("id"), x.alias("x")).where("x is not null")
    kind = dict(points.dtypes)["id"]
    centroids = starting_vectors(points, k, seed)
    if not len(centroids):
        # of null ids only, or nothing
        return points.limit(0).select(F.col("id").alias(key), F.lit(0).alias("cluster"), *[
            F.lit(0).cast("long").alias(c) for c in ("distance", "cluster_inertia", "inertia")],
            F.lit("").alias("centroid_sha256"))
    fixed = centroids[:pivots].copy()
    table = pivot_table(points, fixed)
    for _ in range(rounds):
        centroids = next_centroids(table, centroids, fixed)

    def run(batches):
        for b in batches:
            _, best, distance, _ = _read(b, centroids, fixed)
            yield pa.RecordBatch.from_arrays([b["id"], pa.array(best, pa.int32()), pa.array(distance)],
                                             names=["id", "cluster", "distance"])

    final = written(table.mapInArrow(run, f"id {kind}, cluster int, distance long"), "assigned")
    sums = final.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s"))
    inertia = {r["cluster"]: int(r["s"]) for r in sums.collect()}  # k numbers
    names = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]
    facts = vectors.sparkSession.createDataFrame(
        [(c, s, sum(inertia.values()), names[c]) for c, s in sorted(inertia.items())],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return final.join(small(facts, 96), "cluster").select(
        F.col("id").alias(key), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
