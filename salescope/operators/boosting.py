"""Boosted trees for losses that Spark ML's own boosting lacks.

Each round is one Newton step: with gradient g and curvature h of the loss at the present
margin, a tree fitted to -g / h with row weight h has leaves of -sum(g) / sum(h). A loss
whose curvature vanishes on one side of the target gives a larger h for the step.
The margin is a column beside the features; a round reads the rows, fits one tree on the
executors, and adds its output by a projection. Every ``write_every`` rounds the rows are
written, so neither the plan nor the work lost with an executor grows with the rounds; the
losses of these rounds are taken in one pass.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark import SparkContext
from pyspark.ml.regression import GBTRegressionModel, RandomForestRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salescope.session import materialize


@dataclass(frozen=True)
class Loss:
    """A loss of target ``y`` and margin ``m``: its value, derivative, curvature, first margin, and the prediction of a margin.

    The curvature is the second derivative, or a bound of it from above.
    """

    value: Callable[[Column, Column], Column]
    gradient: Callable[[Column, Column], Column]
    curvature: Callable[[Column, Column], Column]
    start: Callable[[Column], Column]
    prediction: Callable[[Column], Column] = lambda m: m
    #: The h of a step in place of the curvature.
    damped: Callable[[Column, Column], Column] | None = None


def tweedie(power: float = 1.5) -> Loss:
    """Deviance of a Tweedie law between Poisson (1) and gamma (2) with a log link; targets of 0 and more."""
    if not 1 < power < 2:
        raise ValueError("the power lies between 1 and 2")
    a, b = 1 - power, 2 - power
    return Loss(
        lambda y, m: F.exp(b * m) / b - y * F.exp(a * m) / a,
        lambda y, m: F.exp(b * m) - y * F.exp(a * m),
        lambda y, m: b * F.exp(b * m) - a * y * F.exp(a * m),
        lambda y: F.log(F.avg(y)), F.exp)


def gamma() -> Loss:
    """Deviance of a gamma law with a log link; targets above 0.

    Far above the target the curvature falls as exp(-m) while the slope stays near 1, so a
    Newton step from there grows without bound. There h is the chord of the slope from the
    margin to the row's best, log y; a leaf then moves no further than its furthest row asks.
    """
    def damped(y, m):
        x = F.log(y) - m
        return F.when(x < -1e-6, F.expm1(x) / x).otherwise(F.exp(x))

    return Loss(
        lambda y, m: y * F.exp(-m) + m, lambda y, m: 1 - y * F.exp(-m), lambda y, m: y * F.exp(-m),
        lambda y: F.log(F.avg(y)), F.exp, damped)


def pseudo_huber(slope: float = 1.0) -> Loss:
    """Smooth Huber loss, squared near 0 and linear beyond ``slope``.

    The second derivative vanishes far from the target, where a Newton step would leap past
    it; in its place stands the curvature of the parabola that touches the loss from above,
    so a leaf never overshoots.
    """
    def root(y, m):
        return F.sqrt(1 + F.pow((m - y) / slope, 2))

    return Loss(
        lambda y, m: slope**2 * (root(y, m) - 1), lambda y, m: (m - y) / root(y, m), lambda y, m: 1 / root(y, m), F.avg)


def quantile(alpha: float = 0.5) -> Loss:
    """Pinball loss, whose curvature is taken as 1."""
    return Loss(
        lambda y, m: F.greatest(alpha * (y - m), (alpha - 1) * (y - m)),
        lambda y, m: F.when(m < y, -alpha).otherwise(1 - alpha), lambda y, m: F.lit(1.0),
        lambda y: F.percentile_approx(y, F.lit(alpha)).cast("double"))


@dataclass(frozen=True)
class BoostedModel:
    """``start`` plus the weighted outputs of the trees, through the link of the loss; ``curve`` has one row a round."""

    loss: Loss
    start: float
    trees: GBTRegressionModel
    best: int
    curve: DataFrame

    def transform(self, df: DataFrame, prediction: str = "prediction") -> DataFrame:
        out = self.trees.copy({self.trees.predictionCol: prediction}).transform(df)
        return out.withColumn(prediction, self.loss.prediction(F.col(prediction) + self.start))


def _ensemble(trees: list, rate: float, features: str) -> GBTRegressionModel:
    gateway = SparkContext._active_spark_context._gateway
    ml = gateway.jvm.org.apache.spark.ml.regression
    kept, shares = gateway.new_array(ml.DecisionTreeRegressionModel, len(trees)), gateway.new_array(gateway.jvm.double, len(trees))
    for i, t in enumerate(trees):
        kept[i], shares[i] = t._java_obj, float(rate)
    out = GBTRegressionModel(ml.GBTRegressionModel(f"newton_{trees[0].uid}", kept, shares))
    out._set(featuresCol=features, predictionCol="prediction")
    return out


def newton_boost(
    train: DataFrame, val: DataFrame, loss: Loss, label: str = "label", features: str = "features", iterations: int = 500,
    rate: float = 0.05, depth: int = 6, min_leaf: int = 1, subsample: float = 0.8, column_share: float = 0.8,
    patience: int = 50, write_every: int = 10, seed: int = 42,
) -> BoostedModel:
    """Trees up to the round with the least validation loss, sought until ``patience`` rounds bring no lower one.

    Rows without a label are left out. ``curve`` has (iteration, train_loss, val_loss, is_best).
    """
    y, m = F.col("__y"), F.col("__m")

    def rows_of(df: DataFrame, part: str) -> DataFrame:
        return df.select(F.lit(part).alias("__part"), F.col(label).cast("double").alias("__y"), features).where("__y is not null")

    rows = materialize(rows_of(train, "train").unionByName(rows_of(val, "val")), "boost")
    start = rows.where("__part = 'train'").agg(loss.start(y)).first()[0]
    rows = rows.withColumn("__m", F.lit(float(start)))
    trees, losses, best, ended = [], [], 0, False
    while not ended and len(trees) < iterations:
        i = len(trees)
        h = F.greatest((loss.damped or loss.curvature)(y, m), F.lit(1e-6))
        work = rows.where("__part = 'train'").select(features, (-loss.gradient(y, m) / h).alias("__t"), h.alias("__h"))
        tree = RandomForestRegressor(
            numTrees=1, bootstrap=False, subsamplingRate=subsample, featureSubsetStrategy=str(column_share), maxDepth=depth,
            minInstancesPerNode=min_leaf, featuresCol=features, labelCol="__t", weightCol="__h", predictionCol="__p",
            maxMemoryInMB=1024, seed=seed + i).fit(work).trees[0]
        trees.append(tree)
        rows = tree.copy({tree.featuresCol: features, tree.predictionCol: "__p"}).transform(rows)
        margins = [F.col(f"__m{j}") for j in range(len(losses), i)]
        rows = rows.select("__part", "__y", features, *margins, (m + rate * F.col("__p")).alias("__m"))
        rows = rows.withColumn(f"__m{i}", m)
        written = (i + 1) % write_every == 0
        # losses are taken for many rounds in one pass: when the rows are written, and where the search could end
        if not (written or i + 1 == iterations or i - best >= patience):
            continue
        if written:
            rows = materialize(rows, "boost")
        rounds = range(len(losses), i + 1)
        got = {r["__part"]: r for r in rows.groupBy("__part").agg(
            *[F.avg(loss.value(y, F.col(f"__m{j}"))).alias(f"v{j}") for j in rounds]).collect()}
        rows = rows.drop(*[f"__m{j}" for j in rounds])
        for j in rounds:
            losses.append((j, *(got[part][f"v{j}"] if part in got else None for part in ("train", "val"))))
            if losses[j][2] is None or losses[j][2] < losses[best][2]:
                best = j
        ended = i - best >= patience
    curve = train.sparkSession.createDataFrame(
        [(*r, r[0] == best) for r in losses], "iteration int, train_loss double, val_loss double, is_best boolean")
    return BoostedModel(loss, float(start), _ensemble(trees[: best + 1], rate, features), best, curve)
