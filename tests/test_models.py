"""Fitted models against closed forms computed with numpy."""

import hashlib

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from salescope.functions.student import t_quantile, two_sided_p
from salescope.operators import linear as L
from salescope.operators import segments as G
from salescope.operators import selection as X
from salescope.operators import trees as T
from salescope.operators.features import FeatureBundle, assemble_features

NAMES = ["a", "b", "c", "d"]


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(600, 4)) * [1.0, 2.0, 0.5, 1.0] + [0, 3, 0, 0]
    x[:, 3] = (x[:, 3] > 0).astype(float)
    y = 1.5 + x @ [2.0, -1.0, 0.0, 0.7] + rng.normal(size=600)
    split = np.array(["train", "train", "train", "val", "test"])[np.arange(600) % 5]
    rows = [(i, s, float(t), *map(float, v)) for i, (s, t, v) in enumerate(zip(split, y, x))]
    df = spark.createDataFrame(rows, "id int, split string, label double, " + ", ".join(f"z_{n} double" for n in NAMES))
    df = VectorAssembler(inputCols=[f"z_{n}" for n in NAMES], outputCol="features").transform(df).cache()
    tr = split == "train"
    return FeatureBundle(df, NAMES, None), x, y, tr


def test_ols_table(spark, data):
    bundle, x, y, tr = data
    design = np.column_stack([np.ones(tr.sum()), x[tr]])
    beta = np.linalg.solve(design.T @ design, design.T @ y[tr])
    res = y[tr] - design @ beta
    dof = tr.sum() - 5
    se = np.sqrt(res @ res / dof * np.diag(np.linalg.inv(design.T @ design)))
    got = {r.feature: r for r in L.ols_inference(spark, L.moments(bundle.part("train"), NAMES)).collect()}
    for name, b, s in zip(["const", *NAMES], beta, se):
        assert got[name].coef == pytest.approx(b, rel=1e-8, abs=1e-9)
        assert got[name].std_err == pytest.approx(s, rel=1e-8)
        assert got[name].ci_high == pytest.approx(b + t_quantile(0.975, dof) * s, rel=1e-8)


def test_ols_survives_collinear_and_constant_columns(spark, data):
    bundle, x, y, tr = data
    df = bundle.part("train").withColumns({"z_e": F.col("z_a") + F.col("z_b"), "z_k": F.lit(1.0)})
    fit = L.ols(L.moments(df, [*NAMES, "e", "k"]))
    base = L.ols(L.moments(df, NAMES))
    diff = df.select(F.max(F.abs(fit.column() - base.column()))).first()[0]
    assert diff < 1e-8


def test_ridge_closed_form(data):
    bundle, x, y, tr = data
    xc, yc = x[tr] - x[tr].mean(0), y[tr] - y[tr].mean()
    want = np.linalg.solve(xc.T @ xc + 3.0 * np.eye(4), xc.T @ yc)
    fit = L.ridge(L.moments(bundle.part("train"), NAMES), 3.0)
    assert fit.coef == pytest.approx(want, rel=1e-8)


def test_lasso_optimality(data):
    bundle, x, y, tr = data
    fit = L.lasso(bundle, 0.3)
    res = y[tr] - x[tr] @ fit.coef - fit.intercept
    grad = (x[tr] - x[tr].mean(0)).T @ res / tr.sum()
    for g, b in zip(grad, fit.coef):
        if b == 0:
            assert abs(g) <= 0.3 + 1e-4
        else:
            assert g == pytest.approx(0.3 * np.sign(b), abs=1e-4)
    assert fit.coef[2] == 0.0


def test_pca_ridge_matches_explicit_scores(data):
    bundle, x, y, tr = data
    m = L.moments(bundle.part("train"), NAMES)
    z = (x[tr] - x[tr].mean(0)) / x[tr].std(0)
    values, axes = np.linalg.eigh(np.cov(z.T, ddof=0))
    axes = axes[:, np.argsort(values)[::-1]][:, :2]
    scores = z @ axes
    weights = np.linalg.solve(scores.T @ scores + np.eye(2), scores.T @ (y[tr] - y[tr].mean()))
    want = axes @ weights / x[tr].std(0)
    assert L.pca_ridge(m, 2, 1.0).coef == pytest.approx(want, rel=1e-7)
    assert L.principal_components(m).ratio == pytest.approx(np.sort(values)[::-1] / values.sum(), rel=1e-8)


def test_pca_threshold_not_reached_is_null(spark, data):
    m = L.moments(data[0].part("train"), NAMES)
    assert L.pca_variance(spark, m, 1.5).first().n_for_threshold is None
    assert L.pca_variance(spark, m, 1.0).first().n_for_threshold == 4


def test_student_tails():
    assert two_sided_p(2.2281388519862744, 10) == pytest.approx(0.05, abs=1e-12)
    assert t_quantile(0.975, 10) == pytest.approx(2.2281388519862744, abs=1e-10)
    assert two_sided_p(1.959963984540054, 1e7) == pytest.approx(0.05, abs=1e-6)


def test_effect_sides(spark):
    table = spark.createDataFrame([("p", 0.2, 0.1, 2.0, 0.04, 0.0, 0.4)],
                                  "feature string, coef double, std_err double, t_stat double, p_value double, ci_low double, ci_high double")
    left = L.ols_effect_tests(table, "p", "left").first()
    assert left.p_side == pytest.approx(0.98) and left.reject == 0
    assert L.ols_effect_tests(table, "p", "right").first().reject == 1
    assert L.ols_effect_tests(table, "p", "two").first().multiplier == pytest.approx(np.exp(0.2))


def test_baseline_and_unknown_feature(data):
    bundle = data[0]
    rows = {r.model: r for r in L.baseline_table(bundle).collect()}
    assert rows["LinearRegression"].val_R2_log > 0.7 > 0.1 > rows["MeanPredictor"].val_R2_log
    with pytest.raises(KeyError):
        bundle.select(["nope"])


def test_rfe_keeps_the_informative_features(spark, data):
    bundle = data[0]
    make = lambda: T.random_forest(trees=5, depth=4)
    ranking = {r.feature: r for r in X.rfe_fixed(bundle, make, keep=2, step=1).collect()}
    assert {n for n, r in ranking.items() if r.selected} == {"a", "b"}
    assert sorted(r.ranking for r in ranking.values()) == [1, 1, 2, 3]
    table, final = X.rfe_cv(bundle, "id", make, min_features=1, step=2)
    sizes = [r.n_features for r in table.collect()]
    assert sizes == [1, 2, 4] and table.where("chosen_by_min").count() == 1 == table.where("chosen_by_1se").count()
    top = X.top_n_from_ranking(final, 3).orderBy("place").collect()
    assert len(top) == 3 and top[0].selected


def test_score_table_picks(spark):
    long = spark.createDataFrame(
        [(f, n, v) for n, vs in {5: (1.0, 1.2), 7: (0.9, 1.1), 9: (0.95, 1.05)}.items() for f, v in enumerate(vs)],
        "fold int, n_features int, rmse double")
    rows = {r.n_features: r for r in X.score_table(long, 2).collect()}
    assert rows[7].chosen_by_min and rows[5].chosen_by_1se


def test_gbt_curve_and_truncation(data):
    model, curve, best = T.gbt_early_stop(data[0], iterations=6, rate=0.3, depth=3, patience=2)
    rows = curve.orderBy("iteration").collect()
    assert len(rows) == 6 and rows[best].is_best and model.getNumTrees == best + 1


def test_a_cut_model_scores_as_its_point_of_the_curve(data, tmp_path):
    """Cutting refits nothing; the kept trees give the error of their iteration, also after a save."""
    full, curve, _ = T.gbt_early_stop(data[0], iterations=6, rate=0.3, depth=3, truncate=False)
    val, rows = data[0].part("val"), curve.orderBy("iteration").collect()
    for n in (1, 4, 6):
        cut = T.first_trees(full, n)
        error = cut.transform(val).agg(F.sqrt(F.avg((F.col("prediction") - F.col("label")) ** 2))).first()[0]
        assert cut.getNumTrees == n and error == pytest.approx(rows[n - 1].val_rmse, rel=1e-9)
    T.first_trees(full, 2).save(str(tmp_path / "m"))
    assert type(full).load(str(tmp_path / "m")).getNumTrees == 2
    with pytest.raises(ValueError):
        T.first_trees(full, 7)


def test_kmeans_finds_separated_blobs(spark):
    rng = np.random.default_rng(1)
    pts = np.concatenate([rng.normal(size=(n, 2)) * 0.1 + c for n, c in ((60, (0, 0)), (40, (5, 5)), (20, (0, 9)))])
    df = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(pts)], "id int, a double, b double")
    df = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df)
    _, labelled, inertia = G.fit_kmeans(df, 3, n_init=4)
    assert [r["count"] for r in labelled.groupBy("cluster").count().orderBy("cluster").collect()] == [60, 40, 20]
    z = (pts - pts.mean(0)) / pts.std(0)
    groups = np.repeat([0, 1, 2], [60, 40, 20])
    want = sum(((z[groups == g] - z[groups == g].mean(0)) ** 2).sum() for g in range(3))
    assert inertia == pytest.approx(want, rel=1e-6)


def lloyd(x, centres):
    for _ in range(300):
        label = ((x[:, None] - centres[None]) ** 2).sum(-1).argmin(1)
        moved = np.array([x[label == j].mean(0) if (label == j).any() else c for j, c in enumerate(centres)])
        if np.abs(moved - centres).max() < 1e-12:
            return ((x - centres[label]) ** 2).sum()
        centres = moved


def plain_starts(x, keys, k, n_init, seed=42):
    """Sequences of rows, each the least of the hashed waiting times over its distance."""
    out = []
    for s in range(n_init):
        rows = []
        for step in range(k):
            u = np.array([int(hashlib.md5(f"{seed}:{s}:{step}:{q}".encode()).hexdigest()[:13], 16) / 2**52 for q in keys])
            wait = -np.log(u)
            if rows:
                near = ((x[:, None] - x[rows][None]) ** 2).sum(-1).min(1)
                wait = np.where(near > 1e-12, wait / np.maximum(near, 1e-300), np.inf)
            rows.append(int(wait.argmin()))
        out.append(rows)
    return out


def test_all_runs_of_the_elbow_match_a_plain_version(spark, monkeypatch):
    rng = np.random.default_rng(4)
    pts = rng.normal(size=(150, 3)) + rng.integers(0, 4, (150, 1)) * 3
    df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(pts)], "id int, a double, b double, c double")
    df = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df)
    scans = []
    inner = G._lloyd
    monkeypatch.setattr(G, "_lloyd", lambda rows, runs, *a: scans.append(len(runs)) or inner(rows, runs, *a))
    got = {r.k: r.inertia for r in G.kmeans_elbow(df, range(2, 6), n_init=3, key="id").collect()}
    z = (pts - pts.mean(0)) / pts.std(0)
    starts = plain_starts(z, range(150), 5, 3)
    assert scans == [12]  # every k and start in one stack
    assert got == pytest.approx({k: min(lloyd(z, z[s[:k]]) for s in starts) for k in range(2, 6)}, rel=1e-9)


def test_labels_are_the_nearest_centres(spark, data):
    centres, labelled, inertia = G.fit_kmeans(data[0].part("train"), 4, n_init=3, key="id")
    rows = labelled.select("scaled", "cluster").collect()
    x = np.array([r.scaled for r in rows])
    d = ((x[:, None] - centres[None]) ** 2).sum(-1)
    assert [r.cluster for r in rows] == d.argmin(1).tolist() and inertia == pytest.approx(d.min(1).sum(), rel=1e-9)
    sizes = np.bincount([r.cluster for r in rows])
    assert sorted(sizes, reverse=True) == sizes.tolist()


def test_bundle_statistics_come_from_training_rows(spark):
    rows = [(i, float(i % 7), None if i % 5 == 0 else float(i), i % 2, float(i)) for i in range(400)]
    df = spark.createDataFrame(rows, "id int, a double, b double, has_x int, y double")
    bundle = assemble_features(df, ["a", "b", "has_x"], "id", "y", stratum=None, prefixes=("has_",))
    assert bundle.names == ["a", "b", "has_x"]
    train = bundle.part("train").agg(F.avg("z_b"), F.stddev_pop("z_b"), F.count("*")).first()
    assert train[0] == pytest.approx(0, abs=1e-12) and train[1] == pytest.approx(1) and train[2] == 280
    assert bundle.select(["b"]).data.first().features.size == 1


def test_r2_of_constant_and_single_rows(spark):
    from salescope.operators.evaluate import dual_scale_metrics
    rows = [("off", 2.0, 1.0), ("off", 2.0, 3.0), ("exact", 2.0, 2.0), ("exact", 2.0, 2.0), ("one", 2.0, 2.5)]
    df = spark.createDataFrame(rows, "g string, y_true double, y_pred double")
    got = {r.g: r.r2_log for r in dual_scale_metrics(df, ["g"]).collect()}
    assert got == {"off": 0.0, "exact": 1.0, "one": None}


def test_centres_of_several_runs_share_a_scan(spark):
    """Sizes, sums and costs against numpy, equally near centres included; iterations ask for no cost."""
    import numpy as np

    from salescope.operators import segments as G

    x = np.array([[0.0, 0.0], [1.0, 0.0], [2.0, 0.0], [5.0, 1.0]] * 300)
    rows = spark.createDataFrame([(r.tolist(),) for r in x], "scaled array<double>")
    runs = [np.array([[0.0, 0.0], [2.0, 0.0]]), np.array([[5.0, 1.0], [0.0, 0.0], [0.0, 0.0]])]
    for exact in (False, True):
        sizes, sums, costs = G._assigned(rows, runs, exact)
        assert sizes.tolist() == [600, 600, 300, 900, 0]
        assert sums.tolist() == [[300, 0], [2100, 300], [1500, 300], [900, 0], [0, 0]]
        assert costs.tolist() == ([300, 3000, 0, 1500, 0] if exact else [0] * 5)
