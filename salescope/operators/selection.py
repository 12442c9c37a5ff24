"""Recursive feature elimination around a Spark ML estimator.

Only feature names and importances live on the driver; every fit and every score
is a Spark job over the written bundle.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import partial

from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from salescope.operators.features import FeatureBundle, kfold_assign
from salescope.session import at_once, materialize

RANKING_SCHEMA = "feature string, ranking int, selected boolean, importance_in_final double"


def _vectors(df: DataFrame, names: Sequence[str]) -> DataFrame:
    columns = [f"z_{n}" for n in names]
    return VectorAssembler(inputCols=columns, outputCol="features").transform(df.select("label", *columns))


def elimination_path(train: DataFrame, names: Sequence[str], make: Callable, keep: int, step: int):
    """Yield ``(names, model, importances)`` per size, from all features down to ``keep``.

    Each round drops the ``step`` least important (name order breaks ties), and
    never goes under ``keep``.
    """
    current = list(names)
    while True:
        model = make().fit(_vectors(train, current))
        weights = dict(zip(current, model.featureImportances.toArray()))
        yield list(current), model, weights
        if len(current) <= keep:
            return
        drop = min(step, len(current) - keep)
        worst = set(sorted(current, key=lambda n: (weights[n], n))[:drop])
        current = [n for n in current if n not in worst]


def _ranking(spark, path: list, keep: int) -> DataFrame:
    """Rank 1 for survivors; features dropped earlier rank higher."""
    survivors, _, weights = path[-1]
    rows = [(n, 1, True, float(weights[n])) for n in survivors]
    for back, (before, after) in enumerate(zip(path[-2::-1], path[:0:-1])):
        rows += [(n, back + 2, False, 0.0) for n in before[0] if n not in set(after[0])]
    rows.sort(key=lambda r: (not r[2], -r[3], r[1], r[0]))
    return spark.createDataFrame(rows, RANKING_SCHEMA)


def rfe_fixed(bundle: FeatureBundle, make: Callable, keep: int, step: int = 2) -> DataFrame:
    """Ranking after eliminating down to a fixed number of features."""
    path = list(elimination_path(bundle.part("train"), bundle.names, make, keep, step))
    return _ranking(bundle.data.sparkSession, path, keep)


def rfe_cv(bundle: FeatureBundle, key: str, make: Callable, min_features: int = 5, step: int = 2,
           folds: int = 3, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Score every subset size on held-out folds. Returns (score table, ranking).

    The table marks the size of least mean error and the smallest size whose mean
    error is within one fold deviation of it. The ranking comes from a final
    elimination on all training rows down to the size of least error.
    """
    spark = bundle.data.sparkSession
    train = materialize(kfold_assign(bundle.part("train"), key, folds, seed), "folds")
    judge = RegressionEvaluator(metricName="rmse")

    def scores(f: int) -> list:
        held_out = train.where(F.col("fold") == f)
        return [(f, len(names), float(judge.evaluate(model.transform(_vectors(held_out, names)))))
                for names, model, _ in elimination_path(train.where(F.col("fold") != f), bundle.names, make, min_features, step)]

    rows = [r for fold in at_once(spark, [partial(scores, f) for f in range(folds)]) for r in fold]
    long = spark.createDataFrame(rows, "fold int, n_features int, rmse double")
    table = score_table(long, folds)
    best = table.where("chosen_by_min").first().n_features
    path = list(elimination_path(train, bundle.names, make, best, step))
    return table, _ranking(spark, path, best)


def score_table(long: DataFrame, folds: int) -> DataFrame:
    """Mean and deviation per subset size, with the two picks."""
    sizes = long.groupBy("n_features").agg(
        F.avg("rmse").alias("mean_cv_rmse_log"), F.stddev_pop("rmse").alias("std_cv_rmse_log"),
        *[F.max(F.when(F.col("fold") == f, F.col("rmse"))).alias(f"split{f}_cv_rmse_log") for f in range(folds)],
    )
    best = sizes.agg(F.min(F.struct("mean_cv_rmse_log", "n_features", "std_cv_rmse_log"))).scalar()
    limit = best["mean_cv_rmse_log"] + best["std_cv_rmse_log"]
    thrifty = sizes.where(F.col("mean_cv_rmse_log") <= limit).agg(F.min("n_features")).scalar()
    return sizes.withColumns({
        "chosen_by_min": F.col("n_features") == best["n_features"],
        "chosen_by_1se": F.col("n_features") == thrifty,
    }).orderBy("n_features")


def top_n_from_ranking(ranking: DataFrame, n: int) -> DataFrame:
    """Survivors by importance, then eliminated features by rank; first ``n`` with their place."""
    order = [F.desc("selected"),
             F.when(F.col("selected"), F.col("importance_in_final")).desc_nulls_last(),
             F.col("ranking"), F.col("feature")]
    top = ranking.orderBy(*order).limit(n)
    # At most n rows, the caller's report size.
    return top.withColumn("place", F.row_number().over(Window.orderBy(*order)))
