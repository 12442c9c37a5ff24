"""Pairwise moments, the models that follow from them, and their plans."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from salescope.operators import gram, profile
from salescope.operators import linear as L


def gappy(rng, n, p):
    x = rng.normal(size=(n, p)) * 10.0 ** rng.integers(-3, 6, p) + 10.0 ** rng.integers(0, 6, p)
    x[rng.random((n, p)) < 0.2] = np.nan
    x[:, 0] = 0.1
    return x


def test_merged_batches_equal_the_whole():
    x = gappy(np.random.default_rng(0), 700, 6)
    whole, parts = gram.PairMoments.of(x), [gram.PairMoments.of(b) for b in np.array_split(x, [1, 2, 300, 300])]
    merged = parts[0]
    for p in parts[1:]:
        merged = merged.merge(p)
    for name in ("n", "mean", "square", "cross"):
        assert getattr(merged, name) == pytest.approx(getattr(whole, name), rel=1e-9, abs=1e-6), name
    assert np.isnan(merged.correlation()[0]).all()


@pytest.mark.parametrize("partitions", [1, 7])
def test_correlations_match_pandas(spark, partitions):
    x = gappy(np.random.default_rng(1), 900, 5)
    names = list("abcde")
    rows = [tuple(None if v != v and i % 2 else float(v) for v in r) for i, r in enumerate(x)]  # gaps as null and as NaN
    df = spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names)).repartition(partitions)
    want = pd.DataFrame(x, columns=names).corr()
    got = {(r.a, r.b): r["corr"] for r in profile.corr_matrix(df, names).collect()}
    assert len(got) == 25 and all(got["a", n] is None for n in names)
    for a in names[1:]:
        for b in names[1:]:
            assert got[a, b] == pytest.approx(want.loc[a, b], rel=1e-9, abs=1e-12)
    top = profile.corr_with_target(df, names[:-1], "e", 4).collect()
    assert [r.feature for r in top][-1] == "a" and top[0]["corr"] == pytest.approx(want["e"].drop(["a", "e"]).abs().max() * np.sign(top[0]["corr"]))


def test_correlations_stay_apart_from_large_means(spark):
    df = spark.range(5000).select((F.col("id") % 7 + 1e9).alias("a"), (F.col("id") % 7 * 2 - 1e12).alias("b"), F.lit(None).cast("double").alias("c"))
    got = {(r.a, r.b): r["corr"] for r in profile.corr_matrix(df, ["a", "b", "c"]).collect()}
    assert got["a", "b"] == pytest.approx(1.0, abs=1e-9) and got["a", "c"] is None and got["c", "c"] is None


def test_no_rows_have_no_correlation(spark):
    df = spark.createDataFrame([], "a double, b double")
    assert profile.corr_matrix(df, ["a", "b"]).collect() == []
    with pytest.raises(ValueError, match="no rows"):
        L.ols(L.moments(df.withColumnsRenamed({"a": "z_a", "b": "label"}), ["a"]))


def test_eighty_columns_take_one_pass_without_expressions_per_pair(spark):
    names = [f"x{i}" for i in range(80)]
    df = spark.range(20_000).select(*[((F.col("id") * (i + 3) * 7919) % 1009).cast("double").alias(n) for i, n in enumerate(names)])
    found = profile.corr_matrix(df, names)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan and plan.count("Range (0") == 1
    assert found.count() == 6400


def test_a_gap_in_a_model_raises(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 3.0), (2.0, 5.0)], "z_a double, label double")
    with pytest.raises(ValueError, match="z_a"):
        L.moments(df, ["a"])


def segments(spark, n_segments, per=12, seed=0):
    rng = np.random.default_rng(seed)
    rows = []
    for s in range(n_segments):
        beta = rng.normal(size=2)
        for i in range(per):
            x = rng.normal(size=2)
            rows.append((None if s == 1 else s, "train" if i % 4 else "val", float(x @ beta + s), *map(float, x)))
    return rows, spark.createDataFrame(rows, "seg int, split string, label double, z_a double, z_b double")


def test_a_thousand_segments_in_one_scan(spark, monkeypatch):
    monkeypatch.setattr(gram, "GROUPS_IN_MEMORY", 100)
    rows, df = segments(spark, 1000)
    table, coefs, scored = L.segment_ols(df, ["a", "b"], "seg")
    got = {(r.segment, r.feature): r.coef for r in coefs.collect()}
    assert len(got) == 999 * 3
    for s in (0, 2, 517, 999):
        mine = np.array([r[2:] for r in rows if r[0] == s and r[1] == "train"])
        design = np.column_stack([mine[:, 1:], np.ones(len(mine))])
        assert [got[s, f] for f in ("a", "b", "intercept")] == pytest.approx(np.linalg.lstsq(design, mine[:, 0], rcond=None)[0], rel=1e-7, abs=1e-9)
    assert scored.where("abs(y_pred - y_true) > 1e-6").count() == 0 and scored.count() == 999 * 12
    assert table.count() == 1000
    plan = scored._jdf.queryExecution().optimizedPlan().toString()
    assert "CASE WHEN" not in plan


def test_a_segment_without_training_rows_has_no_prediction(spark):
    _, df = segments(spark, 4)
    df = df.withColumn("split", F.when(F.col("seg") == 3, "val").otherwise(F.col("split")))
    _, coefs, scored = L.segment_ols(df, ["a", "b"], "seg")
    assert {r.seg for r in scored.where("y_pred is null").collect()} == {3}
    wide = {r.feature: r for r in L.side_by_side(coefs, [0, 2, 3]).collect()}
    assert wide["a"].segment_0 is not None and wide["a"].segment_3 is None


def lasso_data(seed=0, n=400, p=12):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, p)) @ rng.normal(size=(p, p))
    x[:, 3] = x[:, 2]  # a copied and a constant column
    x[:, 4] = 1.0
    y = x[:, :3] @ [1.0, -2.0, 0.5] + rng.normal(size=n)
    m = gram.PairMoments.of(np.column_stack([x, y]))
    return x, y, L._moments([f"f{i}" for i in range(p)], m)


def kkt_gap(x, y, fit, alpha):
    """How far the optimality conditions are from holding."""
    gradient = (x - x.mean(0)).T @ (y - x @ fit.coef - fit.intercept) / len(y)
    return max(max(abs(g) - alpha, 0.0) if b == 0 else abs(g - alpha * np.sign(b)) for g, b in zip(gradient, fit.coef))


@pytest.mark.parametrize("alpha", [3.0, 0.3, 0.01, 0.0])
def test_lasso_is_optimal(alpha):
    x, y, m = lasso_data()
    fit = L.lasso_of(m, alpha)
    assert kkt_gap(x, y, fit, alpha) < 1e-9 and fit.coef[4] == 0.0
    assert abs(np.mean(y - x @ fit.coef - fit.intercept)) < 1e-9


def test_lasso_path_equals_single_fits_and_ends_empty():
    x, y, m = lasso_data(1)
    top = np.abs(m.sxy / m.n).max()
    alphas = [top * 1.01, top * 0.5, top * 0.1, top * 0.01]
    for alpha, fit in zip(alphas, L.lasso_path(m, alphas)):
        assert kkt_gap(x, y, fit, alpha) < 1e-9
    assert not L.lasso_path(m, alphas)[0].coef.any()
