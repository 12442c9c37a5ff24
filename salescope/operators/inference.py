"""Permutation tests and bootstrap intervals.

Every random choice is an md5 of ``seed:rep:...``, so a run can be repeated anywhere.
Nothing orders the rows of a replicate:

- Rows are numbered once, in hash order. A replicate shuffles the numbers by a
  pseudo-random permutation, a Feistel network whose round functions are tables of about
  sqrt(n) hashes, so a row finds its label or its price in a replicate by itself, in
  arrays, and tasks emit sums per replicate.
- The median of a shuffled side lies in a narrow band of the value axis; rows below it
  are counted, and only the few times sqrt(n) values inside are brought together.
- A resampled median is one draw of the middle order statistic of n uniforms.
- Coefficient replicates are matrix products over Arrow batches.

Replicates run in batches that end in written tables of one row per replicate.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import cache, reduce
from hashlib import md5
from itertools import combinations
from math import ceil, exp, factorial, floor, isqrt, log, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salescope.functions.hashing import digits_of, hex_uint32, md5_of, md5_words
from salescope.operators.order_stats import exact_quantiles, hash_ranks, null_safe, values_at_ranks
from salescope.operators.relational import union_summaries
from salescope.session import materialize

TOLERANCE = 1e-9
REPLICATES_PER_BATCH = 2000
#: Half-width of the band around an expected place, in deviations.
WINDOW = 6.0
#: Most distinct prices (16 bytes each) that travel to the tasks at once.
PRICES_AT_ONCE = 1_000_000
ROUNDS = 6
#: Bytes of round tables in a task.
TABLE_BYTES = 2**26
#: Rows of a task that are shuffled together.
PIECE_ROWS = 2**15


def _batches(n_rep: int, size: int):
    for start in range(0, n_rep, size):
        yield start, min(start + size, n_rep) - 1


def _over_batches(n_rep: int, run: Callable[[int, int], DataFrame], most: int | None = None) -> DataFrame:
    size = max(1, min(REPLICATES_PER_BATCH, most or n_rep))
    parts = [materialize(run(a, b), "replicates") for a, b in _batches(n_rep, size)]
    return reduce(DataFrame.unionByName, parts)


def _result(spark, name: str, observed: float, null: DataFrame, extreme: Column, n_rep: int, alpha: float) -> DataFrame:
    """One result row: the p-value is the share of null statistics at least as extreme."""
    return null.agg(F.avg(extreme.cast("int")).alias("p_value")).select(
        F.lit(name).alias("test"), F.lit(float(observed)).alias("observed_stat"), "p_value",
        F.lit(n_rep).alias("n_permutations"), F.lit(float(alpha)).alias("alpha"),
        (F.col("p_value") < alpha).cast("int").alias("reject"),
    )


def round_tables(seed: int | str, rep: int, sides: tuple[int, int]) -> list[np.ndarray]:
    """The round functions of one replicate."""
    return [table[:side] for table, side in zip(rounds_of(seed, [rep], sides)[0], sides[::-1] * ROUNDS)]


def rounds_of(seed: int | str, reps: Sequence[int], sides: tuple[int, int]) -> np.ndarray:
    """The round functions of the permutations of some replicates, as hashes modulo the side they move.

    An array of (replicate, round, number). The hash of ``seed:rep:round:block`` holds the
    values of four numbers in a row; messages of one length are hashed together.
    """
    blocks = -(-max(sides) // 4)
    out = np.empty((len(reps), ROUNDS, blocks, 4), np.uint32)
    reps, x = np.array(reps), np.arange(blocks)
    rep_widths, x_widths = (np.char.str_len(v.astype(str)) for v in (reps, x))
    for rw in np.unique(rep_widths):
        places = np.flatnonzero(rep_widths == rw)
        for xw in np.unique(x_widths):
            xs = x[x_widths == xw]
            step = max(1, 2**15 // (ROUNDS * len(xs)))
            for some in (places[i : i + step] for i in range(0, len(places), step)):
                rep, j, block = (v.ravel() for v in np.meshgrid(reps[some], np.arange(ROUNDS), xs, indexing="ij"))
                words = md5_words([f"{seed}:".encode(), digits_of(rep, rw), b":", digits_of(j, 1), b":", digits_of(block, xw)], len(rep))
                out[some, :, xs[0] : xs[-1] + 1] = np.stack(words, axis=1).reshape(len(some), ROUNDS, len(xs), 4)
    return out.reshape(len(reps), ROUNDS, -1) % np.array([sides[j % 2] for j in range(ROUNDS)], np.uint32)[:, None]


def feistel_sides(n: int) -> tuple[int, int]:
    """The sides of the least nearly square rectangle that holds 0 to n - 1."""
    a = isqrt(n - 1) + 1 if n > 1 else 1
    return a, -(-n // a)


def grid_places(index: np.ndarray, sides: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """The row and column of each number on the rectangle, in the narrowest type that holds twice a side."""
    kind = np.uint16 if max(sides) <= 2**15 else np.uint32 if max(sides) <= 2**31 else np.uint64
    return tuple(x.astype(kind) for x in np.divmod(index, sides[1]))


def _rounds(left: np.ndarray, right: np.ndarray, sides: tuple[int, int], tables: Sequence[np.ndarray]) -> np.ndarray:
    """The numbers of the places to which one turn of the network sends ``left``, ``right``."""
    a, b = (left.dtype.type(side) for side in sides)
    for j, table in enumerate(tables):
        # a sum over its side is less by that side; one under it wraps round and is the larger
        if j % 2 == 0:
            left = left + table.take(right)
            np.minimum(left, left - a, out=left)
        else:
            right = right + table.take(left)
            np.minimum(right, right - b, out=right)
    wide = np.uint32 if sides[0] * sides[1] < 2**32 else np.int64
    return left.astype(wide) * wide(sides[1]) + right


def shuffled_places(left: np.ndarray, right: np.ndarray, n: int, sides: tuple[int, int], tables: Sequence[np.ndarray]) -> np.ndarray:
    """A permutation of 0 to n - 1 at the numbers of ``grid_places``: turns of the network, repeated while outside."""
    out = _rounds(left, right, sides, tables)
    todo = np.flatnonzero(out >= n)
    while len(todo):
        out[todo] = _rounds(*grid_places(out[todo], sides), sides, tables)
        todo = todo[out[todo] >= n]
    return out


def permuted(index: np.ndarray, n: int, sides: tuple[int, int], tables: Sequence[np.ndarray]) -> np.ndarray:
    """A permutation of 0 to n - 1 at ``index``."""
    left, right = grid_places(index, sides)
    return shuffled_places(left, right, n, sides, [t.astype(left.dtype) for t in tables]).astype(np.int64)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """The columns of some ten thousand rows at a time, so that the round tables are fetched for many rows at once."""
    held, rows = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append([c.to_numpy(zero_copy_only=False) for c in batch.columns])
            rows += batch.num_rows
        if rows >= PIECE_ROWS:
            yield [np.concatenate(c) for c in zip(*held)]
            held, rows = [], 0
    if held:
        yield [np.concatenate(c) for c in zip(*held)]


def _spread(rows: DataFrame) -> DataFrame:
    """Rows over all cores: each is worked on once per replicate, so even small tables keep them busy."""
    return rows.repartition(max(rows.sparkSession.sparkContext.defaultParallelism, 2))


def _numbered(rows: DataFrame, key: str, seed: int) -> tuple[DataFrame, int, int]:
    """Rows with ``index`` from 0 in hash order, their number, and the most replicates whose tables fit a task."""
    ranked = hash_ranks(rows.withColumn("__h", md5_of(f"{seed}:base", F.col(key))), [], "__h", "__rank")
    out = materialize(_spread(ranked.withColumn("index", F.col("__rank") - 1).drop("__rank", "__h", key)), "numbered")
    n = out.count()
    return out, n, max(1, TABLE_BYTES // (4 * ROUNDS * feistel_sides(n)[0]))


def _summed_over(indexed: DataFrame, columns: Sequence[str], n: int, first: int, last: int, seed: int,
                 out: Sequence[str], of: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> DataFrame:
    """``rep`` and the sums ``out``: ``of`` turns the shuffled places and the columns of some rows into parts of them.

    Each task adds up its rows and emits one row per replicate.
    """
    sides = feistel_sides(n)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = None
        sums = np.zeros((last - first + 1, len(out)))
        for index, *values in _pieces(batches):
            left, right = grid_places(index, sides)
            if tables is None:
                tables = rounds_of(seed, range(first, last + 1), sides).astype(left.dtype)
            held = np.column_stack(values)
            for i, table in enumerate(tables):
                sums[i] += of(shuffled_places(left, right, n, sides, table), held)
        if tables is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(first, last + 1), pa.int32()), *(pa.array(s) for s in sums.T)],
                                             names=["rep", *out])

    partial = indexed.select("index", *columns).mapInArrow(run, "rep int, " + ", ".join(f"{c} double" for c in out))
    return partial.groupBy("rep").agg(*[F.sum(c).alias(c) for c in out])


def _shuffled_medians(indexed: DataFrame, n: int, reps: Sequence[int], seed: int, n_first: int,
                      bands: Sequence[tuple[float, float]]) -> DataFrame:
    """``(rep, stat)``: difference of the sides' medians, null where one lies outside its band."""
    sides, sizes = feistel_sides(n), (n_first, n - n_first)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = None
        for index, v in _pieces(batches):
            order = np.argsort(v)
            v = v[order]
            # in value order the rows below a band and those inside are slices; rows over both bands count for neither side
            places = [(np.searchsorted(v, lo), np.searchsorted(v, hi, side="right")) for lo, hi in bands]
            left, right = grid_places(index[order[: max(end for _, end in places)]], sides)
            if tables is None:
                tables = rounds_of(seed, reps, sides).astype(left.dtype)
            below, inside = [], []
            for table in tables:
                first = shuffled_places(left, right, n, sides, table) < n_first
                for mine, (start, end) in zip((first, ~first), places):
                    below.append(int(np.count_nonzero(mine[:start])))
                    inside.append(v[start:end][mine[start:end]])
            ends = np.concatenate([[0], np.cumsum([len(x) for x in inside])])
            yield pa.RecordBatch.from_pydict({
                "rep": pa.array(np.repeat(list(reps), 2), pa.int32()), "side": pa.array(np.tile([0, 1], len(reps)), pa.int32()),
                "below": pa.array(below, pa.int64()), "v": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(inside)))})

    def middle(m: int, below: int, parts: list[np.ndarray]) -> float | None:
        values = np.sort(np.concatenate(parts))
        lo, hi = (m - 1) // 2 - below, m // 2 - below
        return float(values[lo] + values[hi]) / 2 if 0 <= lo and hi < len(values) else None

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, below, parts, medians = None, 0, [], {}

        def close():
            medians[held[1]] = middle(sizes[held[1]], below, parts)
            if held[1] == 1:
                a, b = medians.pop(0), medians.pop(1)
                yield pa.RecordBatch.from_pydict({"rep": pa.array([held[0]], pa.int32()), "stat": pa.array(
                    [None if a is None or b is None else a - b], pa.float64())})

        for batch in batches:
            for rep, side, under, values in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(3)):
                if held != (rep, side):
                    if held is not None:
                        yield from close()
                    held, below, parts = (rep, side), 0, []
                below += under
                parts.append(values.values.to_numpy())
        if held is not None:
            yield from close()

    partial = indexed.select("index", "v").mapInArrow(run, "rep int, side int, below long, v array<double>")
    return partial.repartition("rep").sortWithinPartitions("rep", "side").mapInArrow(settle, "rep int, stat double")


def perm_median_null(base: DataFrame, key: str, value: str, n_first: int, n_rep: int, seed: int = 42) -> DataFrame:
    """``(rep, stat)``: median of the rows shuffled to the first ``n_first`` places minus that of the rest.

    The median of m rows drawn from n lies within a few times n / sqrt(m) / 2 places of
    the whole table's middle, which fixes one band of values per side for all replicates.
    A replicate whose median lies outside is taken again with a band eight times as wide.
    """
    indexed, n, most = _numbered(base.select(key, F.col(value).cast("double").alias("v")), key, seed)

    @cache
    def bands(width: float) -> list[tuple[float, float]]:
        spots = []
        for m in (n_first, n - n_first):
            reach = width * n / (2 * sqrt(m)) + 2
            spots.append((max(0, floor(n / 2 - reach)), min(n - 1, ceil(n / 2 + reach))))
        ranks = base.sparkSession.createDataFrame([(r,) for pair in spots for r in pair], "rank bigint")
        at = {r["rank"]: r.v for r in values_at_ranks(indexed, "v", ranks).collect()}
        return [(at[lo], at[hi]) for lo, hi in spots]

    def run(first: int, last: int) -> DataFrame:
        done, width, reps = [], WINDOW, list(range(first, last + 1))
        while reps:
            found = materialize(_shuffled_medians(indexed, n, reps, seed, n_first, bands(width)), "medians")
            done.append(found.where(F.col("stat").isNotNull()))
            reps, width = [r.rep for r in found.where(F.col("stat").isNull()).collect()], width * 8
        return reduce(DataFrame.unionByName, done)

    return _over_batches(n_rep, run, most)


def perm_median_diff(df: DataFrame, key: str, group: str, value: str, n_rep: int = 10_000,
                     alpha: float = 0.05, seed: int = 42) -> DataFrame:
    """Right-tailed test: is the median of group 1 above the median of group 0.

    Rows without a group or a value (null or NaN) take no part; other groups raise, and so
    does an empty side.
    """
    present = F.col(group).isNotNull() & F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double"))
    base = materialize(df.where(present).select(key, group, value), "perm")
    sides = {r[group]: r for r in exact_quantiles(base, [group], [value], {"median": 0.5}).collect()}
    if set(sides) != {0, 1}:
        raise ValueError(f"groups 0 and 1 must both have rows, and no other: {sorted(sides)}")
    observed = sides[1]["median"] - sides[0]["median"]
    null = perm_median_null(base, key, value, sides[1]["n"], n_rep, seed)
    return _result(df.sparkSession, "median_diff", observed, null, F.col("stat") >= observed - TOLERANCE, n_rep, alpha)


def group_sizes(df: DataFrame, group: str, value: str) -> DataFrame:
    """Size and median of every group."""
    known = df.where(F.col(group).isNotNull())
    return exact_quantiles(known, [group], [value], {"median": 0.5}).drop("variable").orderBy(group)


def perm_anova_f(df: DataFrame, key: str, group: str, value: str, n_rep: int = 10_000,
                 alpha: float = 0.05, seed: int = 42) -> DataFrame:
    """Right-tailed permutation test on the between/within F of several groups.

    Shuffling labels keeps the group sizes and the total sum of squares, so a
    replicate needs only its group sums. Labels number few (they are classes).
    """
    base = materialize(df.where(F.col(group).isNotNull() & F.col(value).isNotNull()).select(key, group, value), "perm")
    stats = base.groupBy(group).agg(F.count("*").alias("n"), F.sum(value).alias("s")).orderBy(group).collect()
    sizes = [r.n for r in stats]
    total, k = sum(sizes), len(sizes)
    mean = sum(r.s for r in stats) / total
    centred = base.select(key, (F.col(value) - mean).alias("v"))
    squares = centred.agg(F.sum(F.col("v") * F.col("v"))).first()[0]

    def f_of(between):
        return (between / (k - 1)) / ((squares - between) / (total - k))

    observed = f_of(sum((r.s - r.n * mean) ** 2 / r.n for r in stats))
    ends, names = np.cumsum(sizes)[:-1].tolist(), [f"s{j}" for j in range(k)]
    indexed, n, most = _numbered(centred, key, seed)

    def sums(place: np.ndarray, values: np.ndarray) -> np.ndarray:
        label = np.zeros(len(place), np.int64)
        for end in ends:
            label += place >= end
        return np.bincount(label, values[:, 0], k)

    def run(first: int, last: int) -> DataFrame:
        between = reduce(lambda a, b: a + b, [F.col(c) * F.col(c) / m for c, m in zip(names, sizes)])
        return _summed_over(indexed, ["v"], n, first, last, seed, names, sums).select("rep", f_of(between).alias("stat"))

    null = _over_batches(n_rep, run, most)
    return _result(df.sparkSession, "anova_f", observed, null, F.col("stat") >= observed - TOLERANCE, n_rep, alpha)


def _price_slices(rows: DataFrame) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first place, distinct prices in order, their counts), at most ``PRICES_AT_ONCE`` at a time."""
    counts = materialize(rows.groupBy("x").agg(F.count("*").alias("c")), "prices")
    distinct, start = counts.count(), 0
    cuts = [(r,) for r in range(PRICES_AT_ONCE, distinct, PRICES_AT_ONCE)]
    edges = [None, *sorted(r.v for r in values_at_ranks(counts, "x", counts.sparkSession.createDataFrame(cuts, "rank bigint")).collect()), None] \
        if cuts else [None, None]
    for lo, hi in zip(edges, edges[1:]):
        part = counts if lo is None else counts.where(F.col("x") >= lo)
        part = part if hi is None else part.where(F.col("x") < hi)
        got = sorted((r.x, r.c) for r in part.collect())
        yield start, np.array([x for x, _ in got]), np.array([c for _, c in got], np.int64)
        start += sum(c for _, c in got)


def run_lookup(ends: np.ndarray) -> Callable[[np.ndarray], np.ndarray]:
    """The function that tells in which run each place lies, if runs end before the places ``ends``.

    A table over equal stretches of places names the run at the head of each; there are
    some eight stretches to a run, so few places lie behind a further end and are searched.
    """
    ends = ends.astype(np.uint32) if ends[-1] < 2**32 else ends
    shift = max(0, int(ends[-1] // (8 * len(ends))).bit_length() - 1)
    heads = np.searchsorted(ends, np.arange((int(ends[-1]) >> shift) + 1, dtype=np.int64) << shift, side="right").astype(np.int32)

    def which(place: np.ndarray) -> np.ndarray:
        run = heads.take(place >> place.dtype.type(shift))
        late = np.flatnonzero(ends.take(run) <= place)
        run[late] = np.searchsorted(ends, place[late], side="right")
        return run

    return which


def _shuffled_sums(indexed: DataFrame, basis: Sequence[str], n: int, first: int, last: int, seed: int,
                   place: int, prices: np.ndarray, counts: np.ndarray) -> DataFrame:
    """``rep`` and, per column of ``basis``, its cross sum with the shuffled prices of one slice.

    Places run in price order: a row takes the price at its shuffled place, and those of
    ``prices`` begin at ``place``.
    """
    ends, whole = np.cumsum(counts), counts.sum() == n
    which = run_lookup(ends)

    def sums(at: np.ndarray, values: np.ndarray) -> np.ndarray:
        if whole:
            return prices[which(at)] @ values
        here = (at >= place) & (at < place + int(ends[-1]))
        return prices[which(at[here] - at.dtype.type(place))] @ values[here]

    return _summed_over(indexed, basis, n, first, last, seed, basis, sums)


def perm_ols_coef(df: DataFrame, key: str, price: str, target: str, controls: Sequence[str] = (),
                  n_rep: int = 10_000, alpha: float = 0.05, seed: int = 42) -> DataFrame:
    """Left-tailed permutation test on the price coefficient of an OLS with controls.

    The control block stays fixed, so each replicate only needs the cross sums of
    the shuffled price with the controls and the target, which tasks add up on their own
    rows. Places run in price order, so only distinct prices and their counts travel.
    """
    cols = [price, target, *controls]
    base = materialize(
        df.where(F.col(target).isNotNull()).select(
            key, *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in cols]), "perm")
    means = base.agg(*[F.avg(c).alias(c) for c in cols]).first()
    rows = base.select(
        F.col(key).alias("__key"), (F.col(price) - means[price]).alias("x"), (F.col(target) - means[target]).alias("y"),
        *[(F.col(c) - means[c]).alias(f"c{i}") for i, c in enumerate(controls)])
    basis = ["y", *[f"c{i}" for i in range(len(controls))]]
    all_cols = ["x", *basis]
    pairs = [(a, b) for i, a in enumerate(all_cols) for b in all_cols[i:]]
    sums = rows.agg(*[F.sum(F.col(a) * F.col(b)).alias(f"{a}_{b}") for a, b in pairs]).first()

    def s(a: str, b: str) -> float:
        return sums[f"{a}_{b}"] if (a, b) in pairs else sums[f"{b}_{a}"]

    cs = basis[1:]
    block = np.array([[s(a, b) for b in cs] for a in cs]).reshape(len(cs), len(cs))
    inverse = np.linalg.pinv(block, hermitian=True) if cs else block
    cy = np.array([s(c, "y") for c in cs])
    on_y, sxx = (inverse @ cy if cs else cy), s("x", "x")

    def slope(xy, xc: list):
        num, den = xy, sxx
        for i, a in enumerate(xc):
            num = num - a * float(on_y[i])
            for j, b in enumerate(xc):
                den = den - a * b * float(inverse[i, j])
        return num / den

    observed = float(slope(s("x", "y"), [s("x", c) for c in cs]))
    indexed, n, most = _numbered(rows, "__key", seed)
    sums = [_over_batches(n_rep, lambda first, last: _shuffled_sums(indexed, basis, n, first, last, seed, *part), most)
            for part in _price_slices(indexed)]

    def total(parts: list[DataFrame]) -> DataFrame:
        return reduce(DataFrame.unionByName, parts).groupBy("rep").agg(*[F.sum(b).alias(b) for b in basis])

    null = total(sums).select("rep", slope(F.col("y"), [F.col(c) for c in cs]).alias("stat"))
    return _result(df.sparkSession, "price_coef", observed, null, F.col("stat") <= observed + TOLERANCE, n_rep, alpha)


def uniform(seed: int | str, rep: int, *more: int | str) -> float:
    """A number strictly between 0 and 1 from the first 52 bits of a hash."""
    return (int(md5(":".join(map(str, (seed, rep, *more))).encode()).hexdigest()[:13], 16) + 0.5) / 2**52


def beta_draw(a: int, b: int, seed: int | str, rep: int) -> float:
    """A draw of Beta(a, b), a and b whole, by rejection from a log-logistic law (Cheng's BB).

    Each trial takes two hashed uniforms; the first that is accepted counts. With a = 1 or
    b = 1 the law is inverted instead.
    """
    if a == 1:
        return 1.0 - (1.0 - uniform(seed, rep, 0, 0)) ** (1.0 / b)
    if b == 1:
        return uniform(seed, rep, 0, 0) ** (1.0 / a)
    lesser, total = min(a, b), a + b
    slope = sqrt((total - 2.0) / (2.0 * a * b - total))
    pull, trial = lesser + 1.0 / slope, 0
    while True:
        u, v = uniform(seed, rep, trial, 0), uniform(seed, rep, trial, 1)
        odds = slope * log(u / (1.0 - u))
        w = lesser * exp(odds)
        if pull * odds - log(4.0) + total * log(total / (max(a, b) + w)) >= log(u * u * v):
            return w / (max(a, b) + w) if a == lesser else max(a, b) / (max(a, b) + w)
        trial += 1


def middle_places(n: int, seed: int | str, rep: int) -> tuple[int, int]:
    """Sorted places of the two middle values (the same one twice if n is odd) of a resample of n from n.

    The j-th least of n draws sits at the place floor(U n) of the j-th least of n uniforms,
    which follows a Beta law; given that, the next one is the least of the rest.
    """
    half = (n + 1) // 2
    u = beta_draw(half, n + 1 - half, seed, rep)
    after = u if n % 2 else u + (1.0 - u) * (1.0 - (1.0 - uniform(seed, rep, "next")) ** (1.0 / (n - half)))
    return min(floor(u * n), n - 1), min(floor(after * n), n - 1)


def bootstrap_medians(df: DataFrame, value: str, n_rep: int, seed: int | str = 42) -> DataFrame:
    """``(rep, median)`` of resamples with replacement, drawn without drawing their rows.

    A replicate costs one draw of its middle order statistic; the values at all the
    places drawn are then looked up together. Null and NaN are no values; without values
    there are no replicates.
    """
    spark = df.sparkSession
    src = materialize(df.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double"))).select(value), "sample")
    n = src.count()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            reps = batch.column("rep").to_pylist()
            places = [middle_places(n, seed, rep) for rep in reps]
            yield pa.RecordBatch.from_pydict({"rep": pa.array(reps, pa.int32()), "rank": pa.array(places, pa.list_(pa.int64()))})

    reps = spark.range(n_rep if n else 0).select(F.col("id").cast("int").alias("rep"))
    spots = materialize(reps.mapInArrow(run, "rep int, rank array<bigint>").select("rep", F.explode("rank").alias("rank")), "spots")
    return materialize(spots.join(values_at_ranks(src, value, spots), "rank").groupBy("rep").agg(F.avg("v").alias("median")), "medians")


def bootstrap_median_ci(df: DataFrame, group: str, value: str, a, b, n_rep: int = 10_000,
                        alpha: float = 0.05, seed: int = 42) -> DataFrame:
    """Percentile interval of ``median(a) - median(b)`` over resamples of both groups."""
    left = bootstrap_medians(df.where(F.col(group) == a), value, n_rep, f"{seed}:{a}")
    right = bootstrap_medians(df.where(F.col(group) == b), value, n_rep, f"{seed}:{b}")
    diff = null_safe(left.withColumnRenamed("median", "m_a"), right.withColumnRenamed("median", "m_b"), ["rep"])
    return _interval(materialize(diff.select((F.col("m_a") - F.col("m_b")).alias("diff")), "diff"), str(a), str(b), alpha)


def _interval(diffs: DataFrame, a: str, b: str, alpha: float) -> DataFrame:
    ends = exact_quantiles(diffs.withColumn("__all", F.lit(0)), ["__all"], ["diff"],
                           {"ci_low": alpha / 2, "ci_high": 1 - alpha / 2})
    return ends.select(F.lit(a).alias("group_a"), F.lit(b).alias("group_b"), "ci_low", "ci_high")


def bootstrap_pairwise_ci(df: DataFrame, group: str, value: str, groups: Sequence, n_rep: int = 10_000,
                          alpha: float = 0.05, seed: int = 42) -> DataFrame:
    """Interval of the median difference for every pair of classes."""
    medians = {g: bootstrap_medians(df.where(F.col(group) == g), value, n_rep, f"{seed}:{g}") for g in groups}
    parts = []
    for a, b in combinations(groups, 2):
        diff = null_safe(medians[a].withColumnRenamed("median", "m_a"), medians[b].withColumnRenamed("median", "m_b"), ["rep"])
        parts.append(_interval(diff.select((F.col("m_a") - F.col("m_b")).alias("diff")), str(a), str(b), alpha))
    return reduce(DataFrame.unionByName, parts)


# Cumulative Poisson(1) probabilities; counting how many lie at or under a uniform
# number draws the weight. Twelve terms exceed the 32-bit resolution of the hash.
POISSON_CDF = [float(c) for c in np.cumsum([exp(-1.0) / factorial(k) for k in range(13)])]


def poisson_count(u: Column) -> Column:
    """The Poisson(1) count at a uniform number."""
    return reduce(lambda a, b: a + b, [(u >= c).cast("int") for c in POISSON_CDF])


def poisson_weight(h: Column) -> Column:
    return poisson_count(hex_uint32(h) / F.lit(float(2 ** 32)))


def poisson_weights(keys: Sequence[str | None], first: int, last: int, seed: int | str) -> np.ndarray:
    """(key, replicate): Poisson(1) counts at the hash of ``seed:rep:key``; keys of one length are hashed together.

    A null key is left out of the message.
    """
    texts = [b"" if k is None else f":{k}".encode() for k in keys]
    lengths = np.array([len(t) for t in texts])
    out = np.empty((len(texts), last - first + 1), np.uint8)
    cuts = np.ceil(np.array(POISSON_CDF) * 2.0**32)
    for length in np.unique(lengths):
        for rows in np.array_split(at := np.flatnonzero(lengths == length), -(-len(at) // 2**15)):
            matrix = np.frombuffer(b"".join(texts[i] for i in rows), np.uint8).reshape(len(rows), length)
            for rep in range(first, last + 1):
                h = md5_words([f"{seed}:{rep}".encode(), matrix], len(rows))[0]
                out[rows, rep - first] = np.searchsorted(cuts, h.astype(float), side="right")
    return out


def bootstrap_coefs(df: DataFrame, key: str, target: str, features: Sequence[str], n_rep: int = 500,
                    seed: int = 42) -> DataFrame:
    """``(rep, feature, coef)``: OLS on weighted rows, one weight per (rep, row).

    Row weights are Poisson(1), the large-sample form of drawing n rows with
    replacement. Each task multiplies the weights of its rows in all replicates with the
    products of their columns and emits one row of cross sums per replicate; the small
    systems are solved where these sums meet.
    """
    cols = [*features, target]
    base = materialize(_spread(df.where(F.col(target).isNotNull()).select(
        key, *[F.col(c).cast("double").alias(c) for c in cols]).dropna()), "boot")
    means = base.agg(*[F.avg(c).alias(c) for c in cols]).first()
    rows = base.select(F.col(key).cast("string").alias("__key"), *[(F.col(c) - means[c]).alias(f"v{i}") for i, c in enumerate(cols)])
    names, width = list(features), len(cols) + 1
    upper = np.triu_indices(width)

    def sums(batches: Iterator[pa.RecordBatch], first: int, last: int) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.column_stack([np.ones(batch.num_rows), *(c.to_numpy(zero_copy_only=False) for c in batch.columns[1:])])
            w = poisson_weights(batch.column(0).to_pylist(), first, last, seed)
            part = np.empty((w.shape[1], len(upper[0])))
            step = max(1, 2**22 // len(upper[0]))
            for at in range(0, len(x), step):  # products of pairs of columns, some million numbers at a time
                piece = w[at : at + step].T.astype(float) @ (x[at : at + step, upper[0]] * x[at : at + step, upper[1]])
                part = piece if at == 0 else part + piece
            total = part if total is None else total + part
        if total is not None:
            yield from _arrays(range(len(total)), total)

    def _arrays(places, rows_):
        yield pa.RecordBatch.from_arrays([pa.array(list(places), pa.int32()), pa.array(list(rows_), pa.list_(pa.float64()))], names=["place", "sums"])

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, held = None, None
        for batch in batches:
            for p, row in zip(batch.column(0).to_pylist(), batch.column(1)):
                mine = row.values.to_numpy()
                if p == place:
                    held = held + mine
                    continue
                if held is not None:
                    yield _solved(place, held)
                place, held = p, mine
        if held is not None:
            yield _solved(place, held)

    def _solved(place: int, flat: np.ndarray) -> pa.RecordBatch:
        g = np.zeros((width, width))
        g[upper] = flat
        g = g + np.triu(g, 1).T
        beta = np.linalg.pinv(g[:-1, :-1], hermitian=True) @ g[:-1, -1]
        return pa.RecordBatch.from_pydict({"place": pa.array([place] * len(names), pa.int32()), "feature": names, "coef": beta[1:]})

    def run(first: int, last: int) -> DataFrame:
        partial = rows.mapInArrow(lambda batches: sums(batches, first, last), "place int, sums array<double>")
        solved = partial.repartition("place").sortWithinPartitions("place").mapInArrow(solve, "place int, feature string, coef double")
        return solved.select((F.col("place") + first).alias("rep"), "feature", "coef")

    return _over_batches(n_rep, run)


def bootstrap_coef_stability(df: DataFrame, key: str, target: str, features: Sequence[str],
                             track: Sequence[str] | None = None, n_rep: int = 500, seed: int = 42) -> DataFrame:
    """Mean, deviation, sign agreement and percentile interval per coefficient.

    Stable means: at least 95 % of replicates agree in sign with the mean, and the
    interval excludes zero.
    """
    track = list(track or features)
    coefs = bootstrap_coefs(df, key, target, features, n_rep, seed).where(F.col("feature").isin(track))
    stats = coefs.groupBy("feature").agg(F.avg("coef").alias("mean"), F.stddev_pop("coef").alias("std"))
    agree = null_safe(coefs, stats, ["feature"]).groupBy("feature").agg(
        F.max("mean").alias("mean"), F.max("std").alias("std"),
        (F.avg((F.signum("coef") == F.signum("mean")).cast("int")) * 100).alias("sign_pct"))
    ends = exact_quantiles(coefs, ["feature"], ["coef"], {"ci_low": 0.025, "ci_high": 0.975}).drop("variable", "n")
    stable = (F.col("sign_pct") >= 95) & ~((F.col("ci_low") <= 0) & (F.col("ci_high") >= 0))
    return null_safe(agree, ends, ["feature"]).withColumn("stable", stable.cast("int"))


def inference_summary(results: Sequence[DataFrame]) -> DataFrame:
    """Results side by side with the decision at alpha and at alpha over their number."""
    stacked = union_summaries({str(i): r for i, r in enumerate(results)}, "test")
    return stacked.withColumn(
        "reject_bonferroni", (F.col("p_value") < F.col("alpha") / len(results)).cast("int"))
