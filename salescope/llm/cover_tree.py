"""Exact top-k inner product search with cover trees over queries and data.

Vectors become integers, floor(scale * x). A bounded sample of pivots deals them to
cells of near vectors and a cell is cut into blocks of bounded size, so a vector that a
third of all rows repeat fills many blocks. Each block is searched first by the queries
that live in it, which gives every query a kth score to start from. Blocks, cells and
groups of queries are the upper nodes of the two trees, each with a centre and a covering
radius: for centres c, d and radii r, s no inner product exceeds
c.d + r |d| + s |c| + r s, and a pair whose bound is below the worst kth score of its
queries is cut. Groups meet cells, then blocks, then each query alone meets the blocks
left, all on centres and radii; only after that are rows copied, a query to the blocks
that may hold a better row and a block to the groups of queries it gets. A task builds
the lower levels of both trees and walks them the same way, best bound first. All of it
is exact for any cells.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from salescope.session import materialize

LEAF = 128
FANOUT = 12
NO_ID = np.iinfo(np.int64).max


class Node:
    """Rows under a centre, all within ``radius`` of it; a leaf has no children."""

    __slots__ = ("rows", "centre", "norm", "radius", "children")

    def __init__(self, rows: np.ndarray, points: np.ndarray, centre: np.ndarray):
        self.rows, self.centre, self.children = rows, centre, []
        self.norm = float(np.sqrt(centre @ centre))
        gap = points[rows] - centre
        self.radius = float(np.sqrt(np.einsum("ij,ij->i", gap, gap).max()))


def cover_tree(points: np.ndarray) -> Node:
    """Each level takes far-apart centres until they cover at half the radius, or ``FANOUT`` of them."""
    root = Node(np.arange(len(points)), points, points[0])
    todo = [root]
    while todo:
        node = todo.pop()
        if len(node.rows) <= LEAF or node.radius == 0:
            continue
        own = points[node.rows]
        near, label, centre = np.full(len(own), np.inf), np.zeros(len(own), np.int64), 0
        for c in range(FANOUT):
            gap = own - own[centre]
            d = np.einsum("ij,ij->i", gap, gap)
            label[d < near] = c
            near = np.minimum(near, d)
            centre = int(near.argmax())
            if near[centre] <= (node.radius / 2) ** 2:
                break
        for c in range(int(label.max()) + 1):
            rows = node.rows[label == c]
            if len(rows):
                node.children.append(Node(rows, points, points[rows[0]]))
        todo += node.children
    return root


def ceiling(dot, norm_a, norm_b, radius_a, radius_b):
    """The largest inner product between two balls, with a margin for rounding relative to its parts."""
    reach = radius_a * norm_b + radius_b * norm_a + radius_a * radius_b
    return dot + reach + 1e-9 * (norm_a * norm_b + reach) + 1e-6


def bound(a: Node, b: Node) -> float:
    return ceiling(float(a.centre @ b.centre), a.norm, b.norm, a.radius, b.radius)


def dual_search(queries: np.ndarray, query_ids: np.ndarray, data: np.ndarray, ids: np.ndarray, k: int, kth: np.ndarray):
    """(scores, ids) of each query's best k rows with a score of ``kth`` or more; empty places have ``NO_ID``."""
    score = np.full((len(queries), k), -np.inf)
    best = np.full((len(queries), k), NO_ID, np.int64)
    q, d = cover_tree(queries), cover_tree(data)
    heap, turn = [(-bound(q, d), 0, q, d)], 1
    while heap:
        limit, _, a, b = heapq.heappop(heap)
        worst = np.maximum(score[a.rows, -1], kth[a.rows]).min()
        if -limit < worst:
            continue
        if not a.children and not b.children:
            for at in range(0, len(b.rows), 8 * LEAF):  # a leaf of equal vectors may be large
                rows = b.rows[at : at + 8 * LEAF]
                got = queries[a.rows] @ data[rows].T
                got[query_ids[a.rows][:, None] == ids[rows][None, :]] = -np.inf
                got[got < np.maximum(score[a.rows, -1], kth[a.rows])[:, None]] = -np.inf
                some = np.isfinite(got).any(axis=0)
                if not some.any():
                    continue
                both = np.concatenate([score[a.rows], got[:, some]], axis=1)
                names = np.concatenate([best[a.rows], np.broadcast_to(ids[rows[some]], (len(a.rows), some.sum()))], axis=1)
                order = np.lexsort((names, -both), axis=1)[:, :k]
                score[a.rows], best[a.rows] = np.take_along_axis(both, order, 1), np.take_along_axis(names, order, 1)
            continue
        for x in a.children if a.children and (not b.children or a.radius >= b.radius) else [a]:
            for y in b.children if b.children and (not a.children or b.radius > a.radius) else [b]:
                heapq.heappush(heap, (-bound(x, y), turn, x, y))
                turn += 1
    best[~np.isfinite(score)] = NO_ID
    return score, best


def _matrix(blobs, dims: int | None = None, kind=np.int64) -> np.ndarray:
    """Rows of floats from packed numbers, the shorter ones filled up with zeros."""
    out = np.zeros((len(blobs), max((len(b) // 8 for b in blobs), default=0) if dims is None else dims))
    for i, b in enumerate(blobs):
        v = np.frombuffer(b, kind)
        out[i, : len(v)] = v
    return out


def _norms(m: np.ndarray) -> np.ndarray:
    return np.sqrt(np.einsum("ij,ij->i", m, m))


def _ball(points: np.ndarray) -> tuple[bytes, float]:
    """Centre and covering radius of some rows."""
    centre = points.mean(axis=0)
    return centre.tobytes(), float(_norms(points - centre).max()) * (1 + 1e-9)


FOUND = "query_id long, vec_id long, score long"
BALL = "centre binary, radius double"


def _found(q: pd.DataFrame, d: pd.DataFrame, k: int) -> pd.DataFrame:
    if not len(q) or not len(d):
        return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype("int64")
    dims = max(len(b) for v in (q["v"], d["v"]) for b in v) // 8
    ids = q["vec_id"].to_numpy(np.int64)
    kth = q["kth"].astype("float64").fillna(-np.inf).to_numpy()
    score, best = dual_search(_matrix(list(q["v"]), dims), ids, _matrix(list(d["v"]), dims), d["vec_id"].to_numpy(np.int64), k, kth)
    row, col = np.nonzero(best != NO_ID)
    return pd.DataFrame({"query_id": ids[row], "vec_id": best[row, col], "score": score[row, col].astype(np.int64)})


def _search_home(k: int, pivots: np.ndarray):
    """Each block searched by its own queries, and one row with its ball and its reach from the pivot of its cell."""

    def search(pdf: pd.DataFrame) -> pd.DataFrame:
        found = _found(pdf[pdf["asks"].to_numpy(bool)].assign(kth=np.nan), pdf, k)
        block = int(pdf["block"].iloc[0])
        points = _matrix(list(pdf["v"]))
        centre, radius = _ball(points)
        pivot = pivots[block >> 32]
        wide = np.zeros((len(points), max(points.shape[1], len(pivot))))
        wide[:, : points.shape[1]] = points
        wide[:, : len(pivot)] -= pivot
        ball = pd.DataFrame({"block": [block], "centre": [centre], "radius": [radius], "reach": [float(_norms(wide).max())]})
        both = pd.concat([found.astype("Int64"), ball.astype({"block": "Int64"})], ignore_index=True)
        return both[["query_id", "vec_id", "score", "block", "centre", "radius", "reach"]]

    return search


def _search_sent(k: int):
    def search(pdf: pd.DataFrame) -> pd.DataFrame:
        asks = pdf["asks"].to_numpy(bool)
        return _found(pdf[asks], pdf[~asks], k)

    return search


def _group_ball(pdf: pd.DataFrame) -> pd.DataFrame:
    """The ball of a group of queries and their worst kth score."""
    centre, radius = _ball(_matrix(list(pdf["v"])))
    worst = pdf["kth"].astype("float64").fillna(-np.inf).min()
    return pd.DataFrame({"g": [pdf["g"].iloc[0]], "worst": [worst], "centre": [centre], "radius": [radius]})


def _meet_cells(pivots: np.ndarray, reach: dict[int, float]):
    """A group of queries once for each cell that may hold a row above its worst kth score."""
    cells = np.array(sorted(reach), np.int64)
    centres = pivots[cells]
    radii, norms = np.array([reach[c] for c in cells]) * (1 + 1e-9), _norms(centres)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = _matrix(batch.column("centre").to_pylist(), kind=np.float64)
            dims = min(own.shape[1], centres.shape[1])
            dot, radius = own[:, :dims] @ centres[:, :dims].T, batch.column("radius").to_numpy()
            most = ceiling(dot, _norms(own)[:, None], norms[None, :], radius[:, None], radii[None, :])
            row, cell = np.nonzero(most >= batch.column("worst").to_numpy()[:, None])
            taken = batch.take(pa.array(row))
            yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(cells[cell])], names=[*batch.schema.names, "cell"])

    return meet


def _meet(left: str, kind, radius: str | None, least: str, out: list[str]):
    """Pairs of a node or query ``left`` and a block whose bound reaches ``least``."""

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = batch.column(left).to_pylist(), batch.column("block_centre").to_pylist()
            dims = max((len(x) // 8 for x in a + b), default=0)
            a, b = _matrix(a, dims, kind), _matrix(b, dims, np.float64)
            own = batch.column(radius).to_numpy() if radius else 0.0
            most = ceiling(np.einsum("ij,ij->i", a, b), _norms(a), _norms(b), own, batch.column("block_radius").to_numpy())
            floor = batch.column(least).cast(pa.float64()).fill_null(-np.inf).to_numpy()
            yield batch.filter(pa.array(most >= floor)).select(out)

    return meet


def _cells(pivots: np.ndarray):
    """The nearest pivot of each vector."""
    half = (pivots**2).sum(axis=1) / 2

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = [np.array(v, np.int64).tobytes() for v in batch.column("v").to_pylist()]
            m = _matrix(raw, max([pivots.shape[1], *(len(b) // 8 for b in raw)]))
            cell = (m[:, : pivots.shape[1]] @ pivots.T - half).argmax(axis=1) if len(raw) else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(cell.astype(np.int64)), batch.column("vec_id"), pa.array(raw, pa.binary())], names=["cell", "vec_id", "v"])

    return cells


def exact_top_k(
    vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vector: str = "embedding", k: int = 5, scale: int = 256,
    pivots: int = 256, block_rows: int = 2048, group_queries: int = 2048,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` rows with the highest integer inner products.

    ``is_query`` is a condition on the column ``vec_id``. Rows with a query's own id are
    no candidates of it; ties go to the smaller id, and a query with fewer candidates gets
    all of them. Rows with a null id, or whose vector is null or holds null or non-finite
    components, take no part; rows alike in id and vector count once, rows of one id
    with several vectors are several candidates, and several queries whose best ``k`` are
    ranked together. Shorter vectors are filled up with zeros; an empty table has no
    rows, other columns are ignored. Scores are exact up to 2**53. Cells are fitted on one
    row for each half block, ``pivots`` rows at most, which sets speed and not results;
    every row is searched.
    """
    x = F.col("_v")
    base = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("_v"))
    fine = ~F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    base = base.filter(F.col("vec_id").isNotNull() & x.isNotNull() & fine)
    base = base.select("vec_id", F.transform("_v", lambda c: F.floor(c * scale).cast("long")).alias("v"))
    base = materialize(base.distinct(), "vectors")
    n_pivots = max(1, min(pivots, 2 * base.count() // block_rows))
    sample = [r["v"] for r in base.orderBy(F.xxhash64("vec_id"), "vec_id", "v").limit(n_pivots).collect()]
    centres = _matrix([np.array(v, np.int64).tobytes() for v in sample] or [b""], max([1, *map(len, sample)]))
    placed = base.mapInArrow(_cells(centres), "cell long, vec_id long, v binary")
    placed = materialize(placed.withColumn("asks", F.coalesce(is_query, F.lit(False))), "cells")
    sizes = placed.groupBy("cell").agg(
        F.ceil(F.count("*") / block_rows).alias("parts"), F.ceil(F.count_if("asks") / group_queries).alias("groups"))
    placed = placed.join(materialize(sizes, "sizes"), "cell")
    number, high = F.xxhash64("vec_id", "v"), F.col("cell") * F.lit(1 << 32)
    placed = placed.withColumn("block", high + F.pmod(number, F.col("parts")))
    placed = placed.withColumn("g", F.when(F.col("asks"), high + F.pmod(F.xxhash64(number), F.col("groups"))))
    placed = materialize(placed.select("block", "g", "vec_id", "v", "asks"), "blocks")

    home = placed.select("block", "vec_id", "v", "asks").groupBy("block")
    home = materialize(home.applyInPandas(_search_home(k, centres), f"{FOUND}, block long, {BALL}, reach double"), "first")
    first = home.filter("query_id is not null").select("query_id", "vec_id", "score")
    balls = home.filter("centre is not null").select(
        F.shiftright("block", 32).alias("cell"), "block", F.col("centre").alias("block_centre"), F.col("radius").alias("block_radius"), "reach")
    reach = {r["cell"]: r["reach"] for r in balls.groupBy("cell").agg(F.max("reach").alias("reach")).collect()}  # one row a pivot

    kth = first.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("kth")).filter(F.col("n") >= k)
    asking = placed.filter("asks").join(kth.select(F.col("query_id").alias("vec_id"), "kth"), "vec_id", "left")
    asking = materialize(asking.select("g", F.col("block").alias("home"), "vec_id", "v", "kth"), "asking")
    groups = asking.groupBy("g").applyInPandas(_group_ball, f"g long, worst double, {BALL}")
    near = groups.mapInArrow(_meet_cells(centres, reach), f"g long, worst double, {BALL}, cell long") if reach else groups.withColumn("cell", F.lit(None).cast("long"))
    ball = "block_centre binary, block_radius double"
    pairs = near.join(balls.drop("reach"), "cell").mapInArrow(
        _meet("centre", np.float64, "radius", "worst", ["g", "block", "block_centre", "block_radius"]), f"g long, block long, {ball}")
    sent = asking.join(materialize(pairs, "pairs"), "g").filter("block <> home")
    sent = materialize(sent.mapInArrow(
        _meet("v", np.int64, None, "kth", ["block", "vec_id", "v", "kth"]), "block long, vec_id long, v binary, kth long"), "sent")

    parts = materialize(sent.groupBy("block").agg(F.ceil(F.count("*") / group_queries).alias("parts")), "parts")
    asks = sent.join(parts, "block").select("block", F.pmod(number, F.col("parts")).alias("part"), "vec_id", "v", F.lit(True).alias("asks"), "kth")
    data = placed.join(parts, "block").withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    rest = asks.unionByName(data.select("block", "part", "vec_id", "v", F.lit(False).alias("asks"), F.lit(None).cast("long").alias("kth")))
    rest = rest.groupBy("block", "part").applyInPandas(_search_sent(k), FOUND)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return first.union(rest).withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
