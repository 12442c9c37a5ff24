"""Exact order statistics against numpy, at every depth of narrowing."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from salescope.functions.hashing import md5_of
from salescope.operators import features as B
from salescope.operators import order_stats as O

QS = {"p0": 0.0, "p25": 0.25, "p50": 0.5, "p333": 1 / 3, "p995": 0.995, "p100": 1.0}


def table(spark, n, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        group = "hot" if rng.random() < 0.6 else rng.choice(["a", "b", None])
        value = rng.choice([None, 7.0, rng.lognormvariate(0, 3), float(rng.randint(-3, 3))])
        rows.append((i, group, value))
    return rows, spark.createDataFrame(rows, "id int, g string, v double")


@pytest.mark.parametrize("slices", [10**9, 1024, 100, 4, 2])
def test_quantiles_match_numpy(spark, monkeypatch, slices):
    monkeypatch.setattr(O, "SLICES", slices)
    rows, df = table(spark, 8000 if slices > 4 else 300, 3)
    got = {r.g: r for r in O.exact_quantiles(df, ["g"], ["v"], QS).collect()}
    for g in ("hot", "a", "b", None):
        vals = [v for _, k, v in rows if k == g and v is not None]
        assert got[g].n == len(vals)
        for name, q in QS.items():
            assert got[g][name] == pytest.approx(np.quantile(vals, q), rel=1e-12, abs=1e-12), (g, name)


INF = float("inf")
ODD = {
    "constant": [0.1] * 500,
    "gaps": [None, float("nan"), 1.0, 2.0, float("nan")] * 60,
    "infinite": [-INF] * 40 + [INF] * 41 + [float(i) for i in range(100)],
    "only_infinite": [-INF] * 3 + [INF] * 4,
    "extreme": [1.7976931348623157e308, -1.7976931348623157e308, 5e-324, -5e-324, 0.0, -0.0, 1e-300, 1e300] * 30,
    "orders": [10.0 ** (i / 7) * (-1) ** i for i in range(-2000, 2000)],
    "close": [1.0 + i * 2.220446049250313e-16 for i in range(900)],
    "skewed": [float(i) for i in range(900)] + [1e18],
    "one": [3.0],
}


@pytest.mark.parametrize("slices", [64, 5])
def test_quantiles_of_odd_data(spark, monkeypatch, slices):
    monkeypatch.setattr(O, "SLICES", slices)
    keep = {k: (v if slices > 5 else v[::9] or v) for k, v in ODD.items()}
    df = spark.createDataFrame([(k, v) for k, vs in keep.items() for v in vs], "g string, v double")
    got = {r.g: r for r in O.exact_quantiles(df, ["g"], ["v"], QS).collect()}
    for k, vs in keep.items():
        vals = sorted(v for v in vs if v is not None and v == v)
        assert got[k].n == len(vals)
        for name, q in QS.items():
            p = q * (len(vals) - 1)
            a, b = vals[int(p)], vals[min(int(p) + 1, len(vals) - 1)]
            want = a if a == b else a + (b - a) * (p - int(p))
            assert got[k][name] == want or (want != want and got[k][name] != got[k][name]), (k, name)


def test_groups_without_values_have_no_row(spark):
    df = spark.createDataFrame([("a", None), ("a", float("nan"))], "g string, v double")
    assert O.exact_quantiles(df, ["g"], ["v"], QS).collect() == []


def test_a_pass_scans_the_rows_once(spark, monkeypatch):
    """Even data of any size needs as many counting passes as its logarithm to the base of the slices."""
    passes = []
    inner = O._counted
    monkeypatch.setattr(O, "_counted", lambda *a: passes.append(1) or inner(*a))
    monkeypatch.setattr(O, "SLICES", 32)
    df = spark.range(30_000).select(F.lit(1).alias("g"), F.col("id").cast("double").alias("v"))
    assert O.exact_quantiles(df, ["g"], ["v"], {"m": 0.5}).first().m == 14_999.5
    assert len(passes) <= 5


def test_quantiles_do_not_depend_on_partitions(spark):
    _, df = table(spark, 2000, 5)
    runs = [sorted(map(repr, O.exact_quantiles(df.repartition(p), ["g"], ["v"], QS).collect())) for p in (1, 8)]
    assert runs[0] == runs[1]


def test_skewness_and_median_literals(spark):
    from salescope.operators.profile import target_skew
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (8.0,)], "x double")
    assert target_skew(df, "x").first().skewness == pytest.approx(1.1376244, abs=1e-6)
    assert O.exact_quantiles(df.withColumn("k", F.lit(1)), ["k"], ["x"], {"m": 0.5}).first().m == 3.0


def test_hash_ranks_number_every_row(spark):
    df = spark.range(5000).select(F.col("id").alias("k"), (F.col("id") % 3).alias("rep")).withColumn("h", md5_of(1, F.col("k")))
    rows = O.hash_ranks(df, ["rep"], "h", "rank").collect()
    for rep in range(3):
        mine = sorted((r for r in rows if r.rep == rep), key=lambda r: r.h)
        assert [r["rank"] for r in mine] == list(range(1, len(mine) + 1))


def test_split_shares_are_exact_per_stratum(spark):
    df = spark.range(3001).select(F.col("id").alias("k"), F.when(F.col("id") % 3 > 0, "big").when(F.col("id") % 7 == 0, "small").alias("s"))
    out = B.stratified_split(df, "k", ["s"]).collect()
    assert sorted(r.k for r in out) == list(range(3001))
    for s in ("big", "small", None):
        part = [r.split for r in out if r.s == s]
        share = (len(part) * 15 + 50) // 100
        assert part.count("test") == share and part.count("val") == share


def test_split_of_tiny_strata(spark):
    df = spark.createDataFrame([(i, i) for i in range(5)], "k int, s int")
    assert {r.split for r in B.stratified_split(df, "k", ["s"]).collect()} == {"train"}


def test_folds_are_even(spark):
    out = [r.fold for r in B.kfold_assign(spark.range(1000).withColumnRenamed("id", "k"), "k", 3).collect()]
    assert [out.count(i) for i in range(3)] == [334, 333, 333]


@pytest.mark.parametrize("slices", [10**9, 100])
def test_values_at_ranks(spark, monkeypatch, slices):
    monkeypatch.setattr(O, "SLICES", slices)
    vals = sorted(random.Random(1).choice([1.0, 2.0, random.random() * 50]) for _ in range(60_000))
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    ranks = [29_900, 30_000, 30_000, 30_150]
    got = {r["rank"]: r.v for r in O.values_at_ranks(df, "v", spark.createDataFrame([(r,) for r in ranks], "rank bigint")).collect()}
    assert got == {r: vals[r] for r in set(ranks)}


@pytest.mark.parametrize("skew", [False, True])
def test_hash_cuts_are_exact_for_any_hash(spark, skew):
    """Windows find the cut of a uniform hash at once, and of one that is not by widening."""
    h = F.concat(F.lit("00000000"), md5_of(3, F.col("id"))) if skew else md5_of(3, F.col("id"))
    df = spark.range(4000).select((F.col("id") % 40 == 0).alias("s"), h.alias("h"))
    ranks = {"none": F.lit(0), "first": F.lit(1), "third": F.expr("n div 3"), "all": F.col("n")}
    got = {r.s: r for r in O.hash_cuts(df, ["s"], "h", ranks).collect()}
    for s in (False, True):
        mine = sorted(r.h for r in df.collect() if r.s == s)
        assert got[s].none is None and got[s].first == mine[0]
        assert got[s].third == mine[len(mine) // 3 - 1] and got[s].all == mine[-1]


def test_frequency_encode_counts_unknowns_together(spark):
    from salescope.operators.preprocess import frequency_encode
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, None), (5, None)], "i int, c string")
    out = {r.i: r.f for r in frequency_encode(df, "c", "f").collect()}
    assert out == {1: 2, 2: 2, 3: 1, 4: 2, 5: 2}
