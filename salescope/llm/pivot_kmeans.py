"""Centroid clustering over integer vectors with a table of pivot distances.

LAESA: the distances of every vector to a few fixed pivots are stored once, beside the
vector. In each round the distances of the centroids to the same pivots give, by the
triangle inequality, |d(v, p) - d(c, p)| as a lower bound of d(v, c) for every pair; the
largest over the pivots is its bound. Each vector gets the exact integer distance of the
centroid with the least bound, and then of the centroids whose bound doesn't exceed it.
Bounds are floats and are cut by a relative margin far above their rounding, so no
nearest centroid is lost; distances, sums and means are integers.

A round is one pass in Arrow batches that returns one row of sums per centroid and
batch, combined by Spark. Only centroids and pivots, ``k`` and ``pivots`` vectors, reach
the driver. Vectors stay in one written table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salescope.session import materialize

#: Scaled components lie within this bound, so that squared distances fit 64 bits.
LARGEST = 2**27
#: Relative and absolute slack of a bound, in distances.
MARGIN, SLACK = 1e-9, 1e-3


def scaled(vectors: DataFrame, id_col: str, vector: str, dims: int, scale: int) -> DataFrame:
    """(id, v) of the rows whose vector has ``dims`` components, all finite, as floor(scale * x)."""
    v = F.col(f"`{vector}`")
    big = 1.7976931348623157e308
    usable = F.coalesce((F.size(v) == dims) & F.forall(v, lambda x: F.coalesce(
        ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) <= big), F.lit(False))), F.lit(False))
    ints = F.transform(v, lambda x: F.floor(x.cast("double") * scale))
    fits = F.forall(v, lambda x: F.abs(x.cast("double") * scale) < LARGEST)
    checked = F.when(fits, ints).otherwise(F.raise_error(F.lit(f"a scaled component reaches {LARGEST}")).cast("array<bigint>"))
    return vectors.filter(usable).select(F.col(f"`{id_col}`").alias("id"), checked.alias("v"))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), dims)


def _squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of ``a`` to the matching rows of ``b``."""
    d = a - b
    return np.einsum("ij,ij->i", d, d)


def _to_pivots(v: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.stack([_squared(v, p[None, :]) for p in pivots], axis=1).astype(np.float64))


def nearest(v: np.ndarray, table: np.ndarray, centroids: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(centroid, squared distance) of each vector, ties to the smaller number, and the distances taken."""
    own = _to_pivots(centroids, pivots)
    bound = np.zeros((len(v), len(centroids)))
    for j in range(table.shape[1]):
        np.maximum(bound, np.abs(table[:, j, None] - own[None, :, j]), out=bound)
    bound = np.maximum(bound * (1 - MARGIN) - SLACK, 0.0)
    best = bound.argmin(axis=1)
    dist = _squared(v, centroids[best])
    taken = len(v)
    # what may still be as near: bound no greater than the distance found, the first choice aside
    open_ = bound <= np.sqrt(dist.astype(np.float64))[:, None] * (1 + MARGIN) + SLACK
    open_[np.arange(len(v)), best] = False
    for c in np.flatnonzero(open_.any(axis=0)):
        rows = np.flatnonzero(open_[:, c])
        rows = rows[bound[rows, c] <= np.sqrt(dist[rows].astype(np.float64)) * (1 + MARGIN) + SLACK]
        d = _squared(v[rows], centroids[c][None, :])
        taken += len(rows)
        closer = (d < dist[rows]) | ((d == dist[rows]) & (c < best[rows]))
        dist[rows[closer]], best[rows[closer]] = d[closer], c
    return best, dist, taken


@dataclass(frozen=True)
class Clustering:
    """Assigned vectors (id, cluster, distance), the final centroids, and exact distances taken per round."""

    assigned: DataFrame
    centroids: list[list[int]]
    distances: list[int]


def _pivot_table(rows: DataFrame, pivots: np.ndarray, dims: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d = _to_pivots(_matrix(batch.column("v"), dims), pivots)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(d) + 1) * len(pivots), pa.int32()), pa.array(d.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], names=["id", "v", "d"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, v array<bigint>, d array<double>")


def cluster(
    vectors: DataFrame, order: Column, id_col: str = "vec_id", vector: str = "embedding", dims: int = 64,
    k: int = 40, rounds: int = 5, scale: int = 256, pivots: int = 16,
) -> Clustering:
    """Lloyd rounds from the ``k`` first vectors by ``order``, then one more assignment.

    Vectors take part when they have ``dims`` components, none null or non-finite; the
    others, and null ones, have no row in the result. ``order`` is an expression over
    ``id``; equal orders go by vector. With fewer than ``k`` vectors each starts a
    centroid. A mean is the floor of the exact quotient; a centroid without vectors stays;
    ties go to the smaller number. Repeated rows each count; a null id is kept and null
    in the result. A scaled component of 2**27 or more in size raises, as distances would
    not fit a long. An empty table gives no rows and no centroids. Other columns are ignored.
    """
    rows = scaled(vectors, id_col, vector, dims, scale)
    first = rows.select("v", order.alias("o")).orderBy(F.asc_nulls_last("o"), "v").limit(k)
    centroids = np.array([r.v for r in first.orderBy(F.asc_nulls_last("o"), "v").collect()], np.int64).reshape(-1, dims)
    fixed = _spread(centroids, pivots)
    table = materialize(_pivot_table(rows, fixed, dims), "pivots")
    if not len(centroids):
        return Clustering(table.select("id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")), [], [])
    taken = []
    for _ in range(rounds):
        sums = _round(table, centroids, fixed, dims).groupBy("cluster").agg(
            F.sum("n").alias("n"), F.sum("taken").alias("taken"),
            F.array(*[F.sum(F.get("total", F.lit(i)).cast("decimal(38,0)")) for i in range(dims)]).alias("total")).collect()
        taken.append(sum(r.taken for r in sums))
        for r in sums:
            if r.n:
                centroids[r.cluster] = [int(t) // r.n for t in r.total]
    return Clustering(_assign(table, centroids.copy(), fixed, dims), centroids.tolist(), taken)


def _spread(points: np.ndarray, n: int) -> np.ndarray:
    """Up to ``n`` of the points, each the farthest from those before it; the first is point 0."""
    if not len(points):
        return points
    chosen, far = [0], _squared(points, points[:1])
    while len(chosen) < min(n, len(points)):
        chosen.append(int(far.argmax()))
        far = np.minimum(far, _squared(points, points[chosen[-1]][None, :]))
    return points[chosen]


def _unpacked(batch: pa.RecordBatch, dims: int, n_pivots: int) -> tuple[np.ndarray, np.ndarray]:
    d = batch.column("d").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, n_pivots)
    return _matrix(batch.column("v"), dims), d


def _round(table: DataFrame, centroids: np.ndarray, pivots: np.ndarray, dims: int) -> DataFrame:
    """(cluster, n, taken, total) per batch: rows, exact distances and sums of components."""
    centroids = centroids.copy()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            v, d = _unpacked(batch, dims, len(pivots))
            best, _, taken = nearest(v, d, centroids, pivots)
            found, number, n = np.unique(best, return_inverse=True, return_counts=True)
            total = np.zeros((len(found), dims), np.int64)
            np.add.at(total, number, v)
            yield pa.RecordBatch.from_pydict({
                "cluster": pa.array(found, pa.int32()), "n": pa.array(n, pa.int64()),
                "taken": pa.array([taken] + [0] * (len(found) - 1), pa.int64()),
                "total": pa.array(total.tolist(), pa.list_(pa.int64()))})

    return table.select("v", "d").mapInArrow(run, "cluster int, n long, taken long, total array<bigint>")


def _assign(table: DataFrame, centroids: np.ndarray, pivots: np.ndarray, dims: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v, d = _unpacked(batch, dims, len(pivots))
            best, dist, _ = nearest(v, d, centroids, pivots)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(best, pa.int32()), pa.array(dist, pa.int64())], names=["id", "cluster", "distance"])

    kind = table.schema["id"].dataType.simpleString()
    return table.mapInArrow(run, f"id {kind}, cluster int, distance long")


def with_inertia(found: Clustering) -> DataFrame:
    """``assigned`` with ``cluster_inertia`` and ``inertia``, and each row's ``centroid``."""
    rows = materialize(found.assigned, "assigned")
    spark = rows.sparkSession
    parts = rows.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    named = spark.createDataFrame(list(enumerate(found.centroids)), "cluster int, centroid array<bigint>")
    total = rows.agg(F.sum("distance").alias("s"))
    sums = parts.join(named, "cluster").withColumn("inertia", total.scalar())
    return rows.join(materialize(sums, "inertia"), "cluster")
