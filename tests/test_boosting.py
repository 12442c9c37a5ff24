"""Newton boosting against its loss in numpy, and what each loss is for."""

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler

from salescope.operators import boosting as B


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(4)
    x = rng.uniform(size=(1200, 2))
    y = np.where(rng.uniform(size=1200) < 0.2, 0.0, rng.gamma(2.0, np.exp(1 + 2 * (x[:, 0] > 0.5))))
    y[5] = 1e4
    df = spark.createDataFrame([(*map(float, a), float(b), i % 4 == 0) for i, (a, b) in enumerate(zip(x, y))], "a double, b double, y double, v boolean")
    return VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df)


LOSSES = {
    "tweedie": (B.tweedie(1.3), lambda y, m: np.exp(0.7 * m) / 0.7 + y * np.exp(-0.3 * m) / 0.3),
    "gamma": (B.gamma(), lambda y, m: y * np.exp(-m) + m),
    "huber": (B.pseudo_huber(2.0), lambda y, m: 4 * (np.sqrt(1 + ((m - y) / 2) ** 2) - 1)),
    "quantile": (B.quantile(0.8), lambda y, m: np.maximum(0.8 * (y - m), -0.2 * (y - m))),
}


@pytest.mark.parametrize("name", LOSSES)
def test_derivatives_are_those_of_the_loss(spark, name):
    from pyspark.sql import functions as F

    loss, plain = LOSSES[name]
    grid = [(float(y), float(m)) for y in (0.1, 1.0, 7.0) for m in (-1.5, 0.3, 2.2)]
    y, m = F.col("y"), F.col("m")
    got = spark.createDataFrame(grid, "y double, m double").select(
        "y", "m", loss.value(y, m).alias("v"), loss.gradient(y, m).alias("g"), loss.curvature(y, m).alias("h")).collect()
    for r in got:
        e = 1e-4
        assert r.v == pytest.approx(plain(r.y, r.m))
        assert r.g == pytest.approx((plain(r.y, r.m + e) - plain(r.y, r.m - e)) / (2 * e), abs=1e-5)
        second = (plain(r.y, r.m + e) - 2 * plain(r.y, r.m) + plain(r.y, r.m - e)) / e**2
        if name in ("tweedie", "gamma"):
            assert r.h == pytest.approx(second, abs=1e-4)
        if name == "huber":  # the parabola with this curvature and slope lies above the loss everywhere
            far = np.linspace(-30, 30, 601)
            above = r.v + r.g * (far - r.m) + r.h / 2 * (far - r.m) ** 2
            assert r.h >= second - 1e-4 and (plain(r.y, far) <= above + 1e-9).all()


def test_one_full_step_gives_the_newton_leaf(rows):
    """A stump at rate 1 puts -sum(g) / sum(h) on either side of its cut."""
    data = rows.where("y < 100")
    model = B.newton_boost(data, data, B.tweedie(1.5), "y", iterations=1, rate=1.0, depth=1, subsample=1.0, column_share=1.0)
    got = model.transform(data).select("a", "y", "prediction").toPandas()
    y, p = got.y.to_numpy(), got.prediction.to_numpy()
    start = np.log(y.mean())
    assert len(set(p.round(9))) == 2
    for value in set(p):
        side = y[p == value]
        g, h = np.exp(0.5 * start) - side * np.exp(-0.5 * start), 0.5 * np.exp(0.5 * start) + 0.5 * side * np.exp(-0.5 * start)
        assert np.log(value) - start == pytest.approx(-g.sum() / h.sum(), rel=1e-6)


def test_curve_matches_the_cut_model(rows):
    train, val = rows.where("not v and y < 100"), rows.where("v and y < 100")
    model = B.newton_boost(train, val, B.tweedie(1.3), "y", iterations=6, rate=0.3, depth=2, write_every=2)
    curve = model.curve.collect()
    assert curve[-1].train_loss < curve[0].train_loss and [r.iteration for r in curve if r.is_best] == [model.best]
    got = model.transform(val).select("y", "prediction").toPandas()
    own = LOSSES["tweedie"][1](got.y.to_numpy(), np.log(got.prediction.to_numpy())).mean()
    assert own == pytest.approx(curve[model.best].val_loss) and own == pytest.approx(min(r.val_loss for r in curve))


def test_huber_falls_every_round(rows):
    model = B.newton_boost(rows, rows, B.pseudo_huber(), "y", iterations=6, rate=0.5, depth=2)
    losses = [r.train_loss for r in model.curve.orderBy("iteration").collect()]
    assert losses == sorted(losses, reverse=True) and losses[-1] < losses[0]


def test_quantile_covers_its_share(rows):
    data = rows.where("y < 100")
    model = B.newton_boost(data, data, B.quantile(0.8), "y", iterations=10, rate=2.0, depth=2)
    got = model.transform(data).select("y", "prediction").toPandas()
    assert 0.7 < (got.y <= got.prediction).mean() < 0.9


def test_gamma_steps_stay_between_the_targets(spark):
    """A leaf of targets far under the mean once took a step that ended in NaN."""
    df = spark.createDataFrame([(float(i % 50 == 0), 1.0 if i % 50 == 0 else 1e6 + i) for i in range(500)], "a double, y double")
    data = VectorAssembler(inputCols=["a"], outputCol="features").transform(df)
    model = B.newton_boost(data, data, B.gamma(), "y", iterations=6, rate=1.0, depth=1, subsample=1.0, column_share=1.0)
    losses = [r.train_loss for r in model.curve.orderBy("iteration").collect()]
    assert np.isfinite(losses).all() and (np.diff(losses) <= 1e-9).all()
    got = model.transform(data).select("y", "prediction").toPandas()
    assert got.prediction.between(0.9, got.y.max()).all()
