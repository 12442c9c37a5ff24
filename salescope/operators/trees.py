"""Tree ensembles on a feature bundle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import partial

from pyspark import SparkContext
from pyspark.ml.regression import (
    GBTRegressionModel, GBTRegressor, GeneralizedLinearRegression, LinearRegression, RandomForestRegressor,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescope.operators.boosting import BoostedModel, Loss, gamma, newton_boost, pseudo_huber, quantile, tweedie
from salescope.operators.evaluate import dual_scale_metrics, split_summary
from salescope.operators.features import FeatureBundle
from salescope.session import at_once, checkpoint_dir


def random_forest(trees: int = 300, min_leaf: int = 5, depth: int = 30, seed: int = 42) -> RandomForestRegressor:
    return RandomForestRegressor(
        numTrees=trees, minInstancesPerNode=min_leaf, maxDepth=depth, featureSubsetStrategy="all",
        seed=seed, maxMemoryInMB=1024,
    )


def boosted_trees(iterations: int = 500, rate: float = 0.05, depth: int = 6, subsample: float = 0.8,
                  column_share: float = 0.8, seed: int = 42, **extra) -> GBTRegressor:
    return GBTRegressor(
        maxIter=iterations, stepSize=rate, maxDepth=depth, subsamplingRate=subsample,
        featureSubsetStrategy=str(column_share), seed=seed, maxMemoryInMB=1024, **extra,
    )


def first_trees(model: GBTRegressionModel, n: int) -> GBTRegressionModel:
    """The boosted model of the first ``n`` trees, which boosting makes the same whatever follows."""
    if not 1 <= n <= model.getNumTrees:
        raise ValueError(f"cannot keep {n} of {model.getNumTrees} trees")
    full = model._java_obj
    trees, weights = full.trees(), full.treeWeights()
    jvm = SparkContext._active_spark_context._gateway
    kept = jvm.new_array(jvm.jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, n)
    shares = jvm.new_array(jvm.jvm.double, n)
    for i in range(n):
        kept[i], shares[i] = trees[i], weights[i]
    cut = jvm.jvm.org.apache.spark.ml.regression.GBTRegressionModel(full.uid(), kept, shares)
    out = GBTRegressionModel(cut)
    for param in ("featuresCol", "labelCol", "predictionCol"):
        out._set(**{param: model.getOrDefault(param)})
    return out


def gbt_early_stop(bundle: FeatureBundle, patience: int = 50, truncate: bool = True, **params):
    """Boosting with a validation curve. Returns (model, curve, best iteration).

    ``curve`` has the train and validation error after each iteration (RMSE for the
    squared loss): a scan of either part scores every prefix of the ensemble by the
    running sum of its trees. The best iteration is the lowest validation error seen
    before ``patience`` iterations pass without a lower one. Spark's own validation stop
    gives up at the first small gain, so the full path is fitted once; ``truncate`` keeps
    its first ``best + 1`` trees.
    """
    train, val = bundle.part("train"), bundle.part("val")
    estimator = boosted_trees(**params)
    context = bundle.data.sparkSession.sparkContext
    if context.getCheckpointDir() is None:  # without one the lineage of the residuals is never cut
        context.setCheckpointDir(checkpoint_dir(bundle.data.sparkSession))
    model = estimator.fit(train)
    loss = estimator.getLossType()
    errors = at_once(bundle.data.sparkSession, [partial(model.evaluateEachIteration, part, loss) for part in (train, val)])
    curves = [[v ** 0.5 if loss == "squared" else v for v in e] for e in errors]
    best = 0
    for i, v in enumerate(curves[1]):
        if v < curves[1][best]:
            best = i
        if i - best >= patience:
            break
    rows = [(i, float(t), float(v), i == best) for i, (t, v) in enumerate(zip(*curves))]
    curve = bundle.data.sparkSession.createDataFrame(
        rows, "iteration int, train_rmse double, val_rmse double, is_best boolean")
    return first_trees(model, best + 1) if truncate else model, curve, best


def importances(spark, model, names: Sequence[str], top: int = 30) -> DataFrame:
    values = model.featureImportances.toArray()
    rows = sorted(((n, float(v)) for n, v in zip(names, values)), key=lambda r: (-r[1], r[0]))
    return spark.createDataFrame(rows[:top], "feature string, importance double")


def predict(bundle: FeatureBundle, models: Mapping[str, object]) -> DataFrame:
    """Long table ``(model, split, y_true, y_pred)``; the models share one scan."""
    out = bundle.data.select("split", F.col("label").alias("y_true"), "features")
    for i, m in enumerate(models.values()):
        out = m.copy({m.predictionCol: f"__p{i}"}).transform(out)
    return out.select("split", "y_true", F.explode(F.array(*[
        F.struct(F.lit(name).alias("model"), F.col(f"__p{i}").alias("y_pred")) for i, name in enumerate(models)
    ])).alias("p")).select("p.model", "split", "y_true", "p.y_pred")


def tree_table(bundle: FeatureBundle, estimators: Mapping[str, object]) -> DataFrame:
    """Fit each estimator on the training rows; metrics per split."""
    train = bundle.part("train")
    models = at_once(train.sparkSession, [partial(e.fit, train) for e in estimators.values()])
    fitted = dict(zip(estimators, models))
    return split_summary(dual_scale_metrics(predict(bundle, fitted), ["model", "split"]))


def skew_aware_losses(bundle: FeatureBundle, raw_target: str, iterations: int = 500, depth: int = 6, rate: float = 0.05,
                      tweedie_power: float = 1.5, huber_slope: float = 1.0, alpha: float = 0.5, ridge: float = 0.01) -> DataFrame:
    """Boosted trees with robust losses on the log target and distribution losses on the raw one.

    The gamma family needs a positive target and is fitted on target + 1. The models named
    ``linear_...`` are the same families as linear models, for comparison; their log link
    is regularised to keep the tail from diverging.
    """
    data = bundle.data.withColumn("raw_plus", F.col(raw_target).cast("double") + 1.0)
    train, val = data.where(F.col("split") == "train"), data.where(F.col("split") == "val")

    def boost(loss: Loss, label: str):
        return partial(newton_boost, train, val, loss, label, iterations=iterations, depth=depth, rate=rate)

    def linear(family: str, label: str, **params):
        return partial(GeneralizedLinearRegression(family=family, regParam=ridge, labelCol=label, maxIter=50, **params).fit, train)

    fits = {
        "absolute": partial(boosted_trees(iterations, rate, depth, lossType="absolute").fit, train),
        "huber": boost(pseudo_huber(huber_slope), "label"),
        f"quantile{alpha:g}": boost(quantile(alpha), "label"),
        "linear_huber": partial(LinearRegression(loss="huber", epsilon=1.35, maxIter=200).fit, train),
        f"tweedie{tweedie_power:g}": boost(tweedie(tweedie_power), raw_target),
        "gamma": boost(gamma(), "raw_plus"),
        f"linear_tweedie{tweedie_power:g}": linear("tweedie", raw_target, variancePower=tweedie_power, linkPower=0.0),
        "linear_gamma": linear("gamma", "raw_plus", link="log"),
    }
    fitted = dict(zip(fits, at_once(data.sparkSession, list(fits.values()))))
    # the raw scale: what is taken off the prediction
    shifts = {f"tweedie{tweedie_power:g}": 0.0, "gamma": 1.0, f"linear_tweedie{tweedie_power:g}": 0.0, "linear_gamma": 1.0}
    logged = {n: m for n, m in fitted.items() if n not in shifts}
    raw = {n: (fitted[n], shift) for n, shift in shifts.items()}

    def stacked(models: dict, target: str) -> DataFrame:
        out, columns = data.select("split", F.col(target).cast("double").alias("y_true"), "features"), {}
        for i, (name, (model, shift)) in enumerate(models.items()):
            p = f"__p{i}"
            out = model.transform(out, p) if isinstance(model, BoostedModel) else model.copy({model.predictionCol: p}).transform(out)
            columns[name] = F.col(p) - shift
        return out.select("split", "y_true", F.explode(F.array(*[
            F.struct(F.lit(n).alias("model"), c.alias("y_pred")) for n, c in columns.items()
        ])).alias("p")).select("p.model", "split", "y_true", "p.y_pred")

    logs = dual_scale_metrics(stacked({n: (m, 0.0) for n, m in logged.items()}, "label"), ["model", "split"])
    return split_summary(logs.unionByName(dual_scale_metrics(stacked(raw, raw_target), ["model", "split"], scale="raw")))


def feature_toggle_ab(bundle: FeatureBundle, arms: Mapping[str, Sequence[str]], make) -> DataFrame:
    """The same estimators with features left out per arm; ``make()`` gives them."""
    def table(arm: str, left_out: Sequence[str]) -> DataFrame:
        names = [n for n in bundle.names if n not in set(left_out)]
        return tree_table(bundle.select(names), make()).withColumns({"arm": F.lit(arm), "n_features": F.lit(len(names))})

    tables = at_once(bundle.data.sparkSession, [partial(table, *arm) for arm in arms.items()])
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    return out.orderBy("val_RMSE_log", "arm", "model")


def step_size_sweep(bundle: FeatureBundle, rates: Sequence[float] = (0.01, 0.05, 0.1, 0.3), **params) -> DataFrame:
    """Learning-rate grid judged on the fixed validation split; the best is marked."""
    table = tree_table(bundle, {f"{r:g}": boosted_trees(rate=r, **params) for r in rates})
    best = table.agg(F.min_by("model", F.struct("val_RMSE_log", "model"))).scalar()
    return table.select(F.col("model").cast("double").alias("rate"), "train_RMSE_log", "val_RMSE_log", "test_RMSE_log",
                        (F.col("model") == best).alias("is_best"))
