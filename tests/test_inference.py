"""Replicates against plain Python on a small table."""

import hashlib
import itertools
import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from salescope.operators import inference as I


def digest(*parts):
    return hashlib.md5(":".join(map(str, parts)).encode()).hexdigest()


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(2)
    return [(i, int(i % 3), float(rng.normal() + 0.4 * (i % 3)), float(i % 11), float(rng.normal())) for i in range(300)]


@pytest.fixture(scope="module")
def df(spark, rows):
    return spark.createDataFrame(rows, "k int, g int, v double, x double, c double").cache()


def shuffled(rows, rep, seed=42):
    """The rows, numbered in hash order, at the places to which the replicate sends their numbers."""
    numbered = sorted(rows, key=lambda r: digest(f"{seed}:base", r[0]))
    placed = sorted(zip(plain_permutation(len(rows), rep, seed), numbered))
    return [r for _, r in placed]


def test_median_difference(df, rows):
    two = df.where("g < 2")
    sub = [r for r in rows if r[1] < 2]
    n1 = sum(r[1] for r in sub)
    obs = np.median([r[2] for r in sub if r[1] == 1]) - np.median([r[2] for r in sub if r[1] == 0])
    null = []
    for rep in range(12):
        vals = [r[2] for r in shuffled(sub, rep)]
        null.append(np.median(vals[:n1]) - np.median(vals[n1:]))
    got = I.perm_median_diff(two, "k", "g", "v", n_rep=12).first()
    assert got.observed_stat == pytest.approx(obs) and got.p_value == pytest.approx(np.mean(np.array(null) >= obs))
    stats = {r.rep: r.stat for r in I.perm_median_null(two, "k", "v", n1, 12).collect()}
    assert [stats[i] for i in range(12)] == pytest.approx(null)


def f_stat(labels, values):
    groups = [values[labels == g] for g in np.unique(labels)]
    mean = values.mean()
    between = sum(len(g) * (g.mean() - mean) ** 2 for g in groups) / (len(groups) - 1)
    within = sum(((g - g.mean()) ** 2).sum() for g in groups) / (len(values) - len(groups))
    return between / within


def test_anova(df, rows):
    labels = np.sort([r[1] for r in rows])
    obs = f_stat(np.array([r[1] for r in rows]), np.array([r[2] for r in rows]))
    null = [f_stat(labels, np.array([r[2] for r in shuffled(rows, rep)])) for rep in range(10)]
    got = I.perm_anova_f(df, "k", "g", "v", n_rep=10).first()
    assert got.observed_stat == pytest.approx(obs, rel=1e-9)
    assert got.p_value == pytest.approx(np.mean(np.array(null) >= obs))


def test_anova_ignores_order_inside_a_group(df):
    runs = [I.perm_anova_f(df.orderBy(o), "k", "g", "v", n_rep=3).first() for o in (F.desc("v"), F.col("k"))]
    assert runs[0].observed_stat == pytest.approx(runs[1].observed_stat) and runs[0].p_value == runs[1].p_value


def plain_permutation(n, rep, seed=42):
    """The Feistel network of a replicate, one number at a time."""
    a = math.isqrt(n - 1) + 1 if n > 1 else 1
    b = -(-n // a)

    def hashed(j, x, side):
        return int(digest(seed, rep, j, x // 4)[8 * (x % 4) : 8 * (x % 4) + 8], 16) % side

    out = []
    for i in range(n):
        while True:
            left, right = divmod(i, b)
            for j in range(6):
                if j % 2:
                    right = (right + hashed(j, left, b)) % b
                else:
                    left = (left + hashed(j, right, a)) % a
            i = left * b + right
            if i < n:
                break
        out.append(i)
    return out


@pytest.mark.parametrize("n", [1, 2, 3, 10, 101, 300])
def test_permutations_are_permutations(n):
    sides = I.feistel_sides(n)
    for rep in range(3):
        got = I.permuted(np.arange(n), n, sides, I.round_tables(42, rep, sides)).tolist()
        assert got == plain_permutation(n, rep) and sorted(got) == list(range(n))


def test_permutations_send_every_row_everywhere():
    """Each row meets each place about equally often, and pairs of rows independently."""
    n, reps = 23, 4000
    sides = I.feistel_sides(n)
    seen, pairs = np.zeros((n, n)), np.zeros((n, n))
    for rep in range(reps):
        at = I.permuted(np.arange(n), n, sides, I.round_tables("u", rep, sides))
        seen[np.arange(n), at] += 1
        pairs[at[0], at[1]] += 1
    chi = ((seen - reps / n) ** 2 / (reps / n)).sum()
    assert chi < n * n + 6 * np.sqrt(2 * n * n)
    off = ~np.eye(n, dtype=bool)
    expected = reps / (n * (n - 1))
    assert ((pairs[off] - expected) ** 2 / expected).sum() < n * n + 6 * np.sqrt(2 * n * n)


@pytest.mark.parametrize("at_once", [1_000_000, 4])
def test_ols_coefficient_with_controls(df, rows, monkeypatch, at_once):
    monkeypatch.setattr(I, "REPLICATES_PER_BATCH", 4)  # more than one batch
    monkeypatch.setattr(I, "PRICES_AT_ONCE", at_once)  # prices in one or several slices
    y = np.array([r[2] for r in rows])
    controls = np.array([[r[4], r[1]] for r in rows])
    numbered = sorted(rows, key=lambda r: digest("42:base", r[0]))
    prices = sorted(r[3] for r in rows)

    def beta(x):
        design = np.column_stack([np.ones(len(y)), x, controls])
        return np.linalg.lstsq(design, y, rcond=None)[0][1]

    obs, null = beta(np.array([r[3] for r in rows])), []
    for rep in range(10):
        place = {r[0]: p for r, p in zip(numbered, plain_permutation(len(rows), rep))}
        null.append(beta(np.array([prices[place[r[0]]] for r in rows])))
    got = I.perm_ols_coef(df, "k", "x", "v", ["c", "g"], n_rep=10).first()
    assert got.observed_stat == pytest.approx(obs, rel=1e-8)
    assert got.p_value == pytest.approx(np.mean(np.array(null) <= obs))


def test_shuffled_prices_need_no_exchange_of_rows(spark, df):
    """The only exchange holds one row per task and replicate."""
    rows = df.select(F.col("k").cast("bigint").alias("index"), F.col("x").cast("double").alias("x"), F.col("v").alias("y"))
    sums = I._shuffled_sums(rows, ["y"], 300, 0, 9, 42, 0, np.arange(11.0), np.full(11, 28, np.int64))
    plan = sums._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Join" not in plan and plan.count("Exchange") == 1
    assert plan.index("HashAggregate") < plan.index("Exchange") < plan.index("MapInArrow")


def test_bands_that_miss_are_widened(df, rows, monkeypatch):
    """Narrow bands leave replicates out, which wider ones then settle to the same values."""
    two = df.where("g < 2")
    n1 = sum(r[1] for r in rows if r[1] < 2)
    plenty = {r.rep: r.stat for r in I.perm_median_null(two, "k", "v", n1, 20).collect()}
    monkeypatch.setattr(I, "WINDOW", 0.02)
    assert {r.rep: r.stat for r in I.perm_median_null(two, "k", "v", n1, 20).collect()} == pytest.approx(plenty)


def test_medians_of_many_rows(spark):
    """On many rows most lie outside the bands, and the medians are right."""
    n, n1 = 20_000, 3_000
    df = spark.range(n).select(F.col("id").alias("k"), (F.col("id") * 7919 % 10_007).cast("double").alias("v"))
    got = {r.rep: r.stat for r in I.perm_median_null(df, "k", "v", n1, 3).collect()}
    vals = [i * 7919 % 10_007 for i in range(n)]
    for rep in range(3):
        order = [r[0] for r in shuffled([(i,) for i in range(n)], rep)]
        assert got[rep] == np.median([vals[i] for i in order[:n1]]) - np.median([vals[i] for i in order[n1:]])


def test_a_missing_side_raises(df):
    with pytest.raises(ValueError, match="groups 0 and 1"):
        I.perm_median_diff(df.where("g = 0"), "k", "g", "v", n_rep=2)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5])
def test_middle_of_a_resample_has_the_enumerated_law(n):
    """All n**n resamples, against many draws of the middle places."""
    want = Counter()
    for draws in itertools.product(range(n), repeat=n):
        s = sorted(draws)
        want[s[(n - 1) // 2], s[n // 2]] += 1 / n**n
    reps = 20_000
    got = Counter(I.middle_places(n, "law", rep) for rep in range(reps))
    assert set(got) <= set(want)
    for places, p in want.items():
        assert abs(got[places] / reps - p) < 5 * np.sqrt(p * (1 - p) / reps) + 1e-9, places


@pytest.mark.parametrize("a, b", [(2, 2), (2, 3), (3, 2), (40, 41), (7, 1), (1, 9), (5000, 5001)])
def test_beta_draws(a, b):
    draws = np.array([I.beta_draw(a, b, "beta", rep) for rep in range(8000)])
    mean, var = a / (a + b), a * b / (a + b) ** 2 / (a + b + 1)
    assert abs(draws.mean() - mean) < 5 * np.sqrt(var / 8000) and draws.var() == pytest.approx(var, rel=0.12)


def test_bootstrap_median(df, rows):
    vals = sorted(r[2] for r in rows if r[1] == 0)
    want = [np.mean([vals[p] for p in I.middle_places(len(vals), "s", rep)]) for rep in range(8)]
    got = {r.rep: r.median for r in I.bootstrap_medians(df.where("g = 0"), "v", 8, "s").collect()}
    assert [got[i] for i in range(8)] == pytest.approx(want)
    assert I.bootstrap_medians(df.where("g > 9"), "v", 8).count() == 0


def test_bootstrap_interval_agrees_with_row_draws(df, rows):
    """The interval of 4000 replicates against one from resampled rows."""
    groups = {g: np.array([r[2] for r in rows if r[1] == g]) for g in (0, 1)}
    rng = np.random.default_rng(5)
    diffs = [np.median(rng.choice(groups[1], 100)) - np.median(rng.choice(groups[0], 100)) for _ in range(4000)]
    got = I.bootstrap_median_ci(df, "g", "v", 1, 0, n_rep=4000).first()
    assert [got.ci_low, got.ci_high] == pytest.approx(np.quantile(diffs, [0.025, 0.975]), abs=0.06)


def test_bootstrap_coefficients(df, rows):
    def weight(rep, key):
        u = int(digest(42, rep, key)[:8], 16) / 2**32
        return sum(u >= c for c in I.POISSON_CDF)

    got = {(r.rep, r.feature): r.coef for r in I.bootstrap_coefs(df, "k", "v", ["x", "c"], 5).collect()}
    x = np.array([[1.0, r[3], r[4]] for r in rows])
    y = np.array([r[2] for r in rows])
    for rep in range(5):
        w = np.array([weight(rep, r[0]) for r in rows], dtype=float)
        beta = np.linalg.solve(x.T @ (x * w[:, None]), x.T @ (w * y))
        assert got[(rep, "x")] == pytest.approx(beta[1], rel=1e-7)
        assert got[(rep, "c")] == pytest.approx(beta[2], rel=1e-7)
    summary = I.bootstrap_coef_stability(df, "k", "v", ["x", "c"], track=["x"], n_rep=5).collect()
    assert [r.feature for r in summary] == ["x"] and summary[0].ci_low <= summary[0].ci_high


def test_poisson_weights_average_one(spark):
    from salescope.functions.hashing import md5_of
    w = spark.range(40_000).select(I.poisson_weight(md5_of(0, F.col("id"))).alias("w"))
    row = w.agg(F.avg("w"), F.var_pop("w")).first()
    assert row[0] == pytest.approx(1, abs=0.03) and row[1] == pytest.approx(1, abs=0.05)


def test_summary_corrects_for_the_number_of_tests(spark):
    r = spark.createDataFrame([("t", 1.0, 0.03, 10, 0.05, 1)],
                              "test string, observed_stat double, p_value double, n_permutations int, alpha double, reject int")
    row = I.inference_summary([r, r, r]).first()
    assert row.reject == 1 and row.reject_bonferroni == 0


def test_run_lookup_names_the_run_of_every_place():
    for counts in ([1], [5000, 1, 1, 3, 1], [1] * 40 + [9000] + [2] * 7, np.random.default_rng(5).integers(1, 400, 300)):
        which = I.run_lookup(np.cumsum(counts))
        for kind in (np.uint32, np.int64):
            assert which(np.arange(sum(counts)).astype(kind)).tolist() == np.repeat(np.arange(len(counts)), counts).tolist()


@pytest.mark.parametrize("kind", [np.uint16, np.uint32, np.uint64])
def test_places_do_not_depend_on_the_type(kind):
    n = 2**30 - 5 if kind == np.uint16 else 2**30 + 5 if kind == np.uint32 else 10_007
    sides, index = I.feistel_sides(n), np.arange(0, n, max(1, n // 500))
    tables = [np.random.default_rng(j).integers(0, sides[j % 2], sides[1 - j % 2]) for j in range(I.ROUNDS)]
    left, right = I.grid_places(index, sides)
    if kind == np.uint64:
        left, right = left.astype(kind), right.astype(kind)
    assert left.dtype == kind
    out = index.copy()
    while (todo := np.flatnonzero((out >= n) | (out == index))).size:  # none of these numbers is left in place
        l, r = np.divmod(out[todo], sides[1])
        for j, t in enumerate(tables):
            l, r = ((l + t[r]) % sides[0], r) if j % 2 == 0 else (l, (r + t[l]) % sides[1])
        out[todo] = l * sides[1] + r
    got = I.shuffled_places(left, right, n, sides, [t.astype(kind) for t in tables])
    assert got.tolist() == out.tolist()


def test_shuffles_cost_a_fraction_of_plain_rounds():
    """A million places took a tenth of a second, mostly in divisions and masked subtractions."""
    import time

    n = 7_200_000
    sides, index = I.feistel_sides(n), np.arange(2**15)
    left, right = I.grid_places(index, sides)
    tables = list(I.rounds_of(1, range(4), sides).astype(left.dtype))
    start = time.process_time()
    for t in tables * 8:
        I.shuffled_places(left, right, n, sides, t)
    assert (time.process_time() - start) / 32 / 2**15 < 60e-9


def test_hashes_in_arrays_are_md5():
    from salescope.functions.hashing import md5_words

    for length in (0, 1, 47, 55, 56, 63, 64, 120, 130):
        rows = np.random.default_rng(length).integers(0, 256, (3, length)).astype(np.uint8)
        words = md5_words([b"a:", rows], 3)
        assert ["".join(f"{w[i]:08x}" for w in words) for i in range(3)] == [hashlib.md5(b"a:" + bytes(r)).hexdigest() for r in rows]


def test_weights_in_arrays_are_those_of_columns(spark):
    from salescope.functions.hashing import md5_of

    keys = ["7", None, "10", "ab", "ü", "x" * 70]
    df = spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "i int, k string").orderBy("i")
    got = I.poisson_weights(keys, 8, 11, "s")
    for rep in range(8, 12):
        want = df.select(I.poisson_weight(md5_of("s", F.lit(rep), F.col("k"))).alias("w")).collect()
        assert got[:, rep - 8].tolist() == [r.w for r in want]
