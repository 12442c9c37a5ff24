"""Segments: by class, by price, by k-means; their statistics and profiles."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salescope.functions import vocab
from salescope.functions.hashing import hex_fraction, md5_of
from salescope.operators.order_stats import with_quantiles
from salescope.session import materialize


def segment_by_class(ordinal: Column, names: Mapping[int, str] | None = None) -> Column:
    """Segment name per class code; unknown classes have none."""
    names = names or {code: name for name, code in vocab.CLASS_ORDER.items()}
    expr = F.lit(None).cast("string")
    for code, name in names.items():
        expr = F.when(ordinal == code, name).otherwise(expr)
    return expr


# The variant that pools the two small top classes.
MERGED_CLASSES = {0: "Hobbyist", 1: "Indie", 2: "AA_AAA", 3: "AA_AAA"}


def segment_by_price(price: Column, edges: Sequence[float] = vocab.PRICE_EDGES) -> Column:
    """Half-open bands named by their interval; prices outside the edges have none."""
    expr = F.lit(None).cast("string")
    for lo, hi in zip(edges, edges[1:]):
        expr = F.when((price >= lo) & (price < hi), f"[{lo:g},{hi:g})").otherwise(expr)
    return expr


def segment_stats(df: DataFrame, segment: str, target: str) -> DataFrame:
    """Size, share of the whole table, and target statistics per segment."""
    total = df.agg(F.count("*")).scalar()
    known = df.where(F.col(segment).isNotNull())
    base = known.groupBy(segment).agg(
        F.count("*").alias("n"), F.avg(target).alias("mean"), F.stddev(target).alias("std"),
        F.min(target).cast("double").alias("min"), F.max(target).cast("double").alias("max"),
    ).withColumn("pct", 100.0 * F.col("n") / total)
    return with_quantiles(base, known, [segment], {"median": (target, 0.5)})


def _scaled(df: DataFrame, features: str, key: str | None) -> tuple[DataFrame, int]:
    """``df`` with ``scaled``, the z-scores (population deviation, constants to 0) as an array, and ``__key``."""
    x = vector_to_array(features)
    width = len(df.select(features).first()[0])
    stats = df.agg(*[f(x[i]).alias(f"{n}{i}") for n, f in (("m", F.avg), ("s", F.stddev_pop)) for i in range(width)]).first()
    scores = F.array(*[(x[i] - stats[f"m{i}"]) / (stats[f"s{i}"] or 1.0) for i in range(width)])
    named = F.col(key).cast("string") if key else F.md5(x.cast("string").cast("binary"))
    rows = df.withColumn("scaled", scores).withColumn("__key", named)
    return materialize(rows.repartition(max(2, df.sparkSession.sparkContext.defaultParallelism)), "scaled"), width


def _matrix(lists: pa.Array) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)


def _distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    d = (x * x).sum(axis=1)[:, None] - 2.0 * (x @ centres.T) + (centres * centres).sum(axis=1)
    return np.maximum(d, 0.0)


def _starts(rows: DataFrame, k: int, n_init: int, seed: int) -> np.ndarray:
    """``n_init`` sequences of ``k`` starting rows, as an array of (start, centre, feature).

    Each next row is drawn with a chance in proportion to its squared distance from the
    rows before it: of the waiting times -ln(u) / distance with hashed u the least wins.
    One scan draws the next row of every start.
    """
    chosen: list[list[list[float]]] = [[] for _ in range(n_init)]
    for step in range(k):
        u = F.array(*[hex_fraction(md5_of(seed, F.lit(s), F.lit(step), F.col("__key"))) for s in range(n_init)])
        centres = [np.array(c) for c in chosen]

        def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                x, draws = _matrix(batch.column(0)), _matrix(batch.column(1))
                wait = -np.log(np.maximum(draws, 1e-300))
                for s, c in enumerate(centres):
                    if len(c):
                        near = _distances(x, c).min(axis=1)
                        wait[:, s] = np.where(near > 1e-12, wait[:, s] / np.maximum(near, 1e-300), np.inf)
                first = wait.argmin(axis=0)
                yield pa.RecordBatch.from_pydict({
                    "start": pa.array(range(n_init), pa.int32()), "wait": wait[first, range(n_init)],
                    "x": pa.array(x[first].tolist(), pa.list_(pa.float64()))})

        found = rows.select("scaled", u.alias("u")).mapInArrow(best, "start int, wait double, x array<double>")
        for r in found.groupBy("start").agg(F.min(F.struct("wait", "x")).alias("b")).collect():
            chosen[r.start].append(r.b.x)
    return np.array(chosen)


def _assigned(rows: DataFrame, runs: list[np.ndarray], exact: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sizes, sums of rows and, if ``exact``, costs of the centres of several runs one after the other, from one scan.

    A task takes a few hundred rows at a time, so their distances to all centres stay in
    its cache, and returns one row of sums per centre.
    """
    centres = np.concatenate(runs)
    ends = np.cumsum([0, *(len(c) for c in runs)])
    squares, at_once = (centres * centres).sum(axis=1)[:, None], max(256, 2**18 // len(centres))

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n, cost = np.zeros_like(centres), np.zeros(len(centres), np.int64), np.zeros(len(centres))
        for batch in batches:
            if not batch.num_rows:
                continue
            matrix = _matrix(batch.column(0))
            for x in (matrix[i : i + at_once] for i in range(0, len(matrix), at_once)):
                d = centres @ x.T
                d *= -2.0
                d += (x * x).sum(axis=1)
                d += squares
                np.maximum(d, 0.0, out=d)
                hot = np.empty_like(d)
                for lo, hi in zip(ends, ends[1:]):
                    np.equal(d[lo:hi], d[lo:hi].min(axis=0), out=hot[lo:hi])
                    if exact or hot[lo:hi].sum() != len(x):  # the first of equally near centres
                        pick = d[lo:hi].argmin(axis=0)
                        hot[lo:hi] = np.arange(hi - lo)[:, None] == pick
                        if exact:
                            cost[lo:hi] += np.bincount(pick, ((x - centres[lo + pick]) ** 2).sum(axis=1), hi - lo)
                n += hot.sum(axis=1).astype(np.int64)
                total += hot @ x
        yield pa.RecordBatch.from_pydict({
            "centre": pa.array(range(len(n)), pa.int32()), "n": n, "cost": cost, "x": pa.array(total.tolist(), pa.list_(pa.float64()))})

    parts = rows.select("scaled").mapInArrow(sums, "centre int, n long, cost double, x array<double>").groupBy("centre").agg(
        F.sum("n").alias("n"), F.sum("cost").alias("cost"), F.array(*[F.sum(F.col("x")[i]) for i in range(centres.shape[1])]).alias("x")).collect()
    parts.sort(key=lambda r: r.centre)
    return np.array([r.n for r in parts]), np.array([r.x for r in parts]), np.array([r.cost for r in parts])


def _lloyd(rows: DataFrame, runs: list[np.ndarray], iterations: int, tolerance: float) -> list[tuple[np.ndarray, np.ndarray, float]]:
    """(centres, sizes, inertia) of each run, all runs sharing one scan per iteration.

    Centres of all open runs are stacked. A run closes when its centres move by less than
    ``tolerance`` in all. An empty cluster keeps its centre. Sizes and inertia come from
    one more scan, over the centres of all closed runs.
    """
    runs, open_ = [np.array(c) for c in runs], list(range(len(runs)))
    for _ in range(iterations):
        sizes, sums, _ = _assigned(rows, [runs[r] for r in open_], exact=False)
        ends = np.cumsum([0, *(len(runs[r]) for r in open_)])
        still = []
        for r, lo, hi in zip(open_, ends, ends[1:]):
            n = sizes[lo:hi, None]
            moved = np.where(n > 0, sums[lo:hi] / np.maximum(n, 1), runs[r])
            if np.sqrt(((moved - runs[r]) ** 2).sum()) > tolerance:
                runs[r] = moved
                still.append(r)
        open_ = still
        if not open_:
            break
    sizes, _, costs = _assigned(rows, runs, exact=True)
    ends = np.cumsum([0, *(len(c) for c in runs)])
    return [(c, sizes[lo:hi], float(sum(costs[lo:hi]))) for c, lo, hi in zip(runs, ends, ends[1:])]


def fit_kmeans(df: DataFrame, k: int = 3, features: str = "features", n_init: int = 10, seed: int = 42,
               key: str | None = None, iterations: int = 300, tolerance: float = 1e-9):
    """Best of ``n_init`` starts by inertia. Returns (centres, labelled rows, inertia).

    Clusters are renumbered by descending size, then by the first centre. ``key`` names
    the rows in the draws of the starts; without it their features do.
    """
    rows, width = _scaled(df, features, key)
    best = min(_lloyd(rows, list(_starts(rows, k, n_init, seed)), iterations, tolerance), key=lambda r: r[2])
    centres, sizes, inertia = best
    centres = centres[sorted(range(k), key=lambda i: (-sizes[i], tuple(centres[i])))]

    def distance(centre: np.ndarray) -> Column:
        return sum(((F.col("scaled")[i] - float(centre[i])) * (F.col("scaled")[i] - float(centre[i])) for i in range(width)), F.lit(0.0))

    ds = F.array(*[distance(c) for c in centres])
    nearest = (F.array_position(ds, F.array_min(ds)) - 1).cast("int")
    return centres, rows.withColumn("cluster", nearest).drop("__key"), inertia


def kmeans_elbow(df: DataFrame, ks: Sequence[int] = range(2, 11), features: str = "features",
                 n_init: int = 10, seed: int = 42, key: str | None = None, iterations: int = 300,
                 tolerance: float = 1e-9) -> DataFrame:
    """Smallest inertia found for every k; the starts of a k begin those of the next."""
    rows, _ = _scaled(df, features, key)
    starts = _starts(rows, max(ks), n_init, seed)
    runs = [(k, starts[s, :k]) for k in ks for s in range(n_init)]
    found = _lloyd(rows, [c for _, c in runs], iterations, tolerance)
    least: dict[int, float] = {}
    for (k, _), (_, _, inertia) in zip(runs, found):
        least[k] = min(inertia, least.get(k, inertia))
    return df.sparkSession.createDataFrame([(int(k), v) for k, v in least.items()], "k int, inertia double")


def cluster_profile(df: DataFrame, cluster: str, target: str, features: Sequence[str]) -> DataFrame:
    """Size, share, target statistics and mean features per cluster."""
    total = df.agg(F.count("*")).scalar()
    base = df.groupBy(cluster).agg(
        F.count("*").alias("n"), F.avg(target).alias("mean_target"),
        F.max(target).cast("double").alias("max_target"),
        *[F.avg(c).alias(f"avg_{c}") for c in features],
    ).withColumn("pct", 100.0 * F.col("n") / total)
    return with_quantiles(base, df, [cluster], {"median_target": (target, 0.5)})


def cluster_top_features(df: DataFrame, cluster: str, target: str, features: Sequence[str], k: int = 3) -> DataFrame:
    """Size, target statistics and the ``k`` features of largest absolute mean per cluster.

    The feature means are aggregated first, so ranking sees one row per
    (cluster, feature).
    """
    means = df.groupBy(cluster).agg(*[F.abs(F.avg(c)).alias(c) for c in features])
    long = means.unpivot(cluster, list(features), "feature", "strength")
    order = Window.partitionBy(cluster).orderBy(F.desc(F.round("strength", 9)), "feature")
    top = (
        long.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)
        .groupBy(cluster)
        .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "feature"))),
                                      lambda s: s["feature"]), ", ").alias("top_features"))
    )
    total = df.agg(F.count("*")).scalar()
    base = df.groupBy(cluster).agg(
        F.count("*").alias("n"), F.avg(target).alias("mean_target"), F.stddev(target).alias("std_target"),
    ).withColumn("pct", 100.0 * F.col("n") / total).join(top, cluster)
    return with_quantiles(base, df, [cluster], {"median_target": (target, 0.5)})
