"""Prediction quality on the log and the raw scale, and slices of the error.

Input rows hold ``y_true_log`` and ``y_pred_log`` beside a key and attributes.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salescope.functions import vocab
from salescope.functions.parsing import band
from salescope.operators.order_stats import with_quantiles
from salescope.operators.profile import melt_row, sample_rows


def on_both_scales(df: DataFrame, y_true: str, y_pred: str, scale: str = "log") -> DataFrame:
    """Add both scales. Raw-trained predictions are floored at 0 before the log."""
    t, p = F.col(y_true).cast("double"), F.col(y_pred).cast("double")
    if scale == "log":
        return df.withColumns({"y_true_log": t, "y_pred_log": p, "y_true_raw": F.expm1(t), "y_pred_raw": F.expm1(p)})
    if scale != "raw":
        raise ValueError(f"scale must be 'log' or 'raw', got {scale!r}")

    def floored(c: Column) -> Column:
        return F.log1p(F.when(c < 0, 0.0).otherwise(c))

    return df.withColumns({"y_true_raw": t, "y_pred_raw": p, "y_true_log": floored(t), "y_pred_log": floored(p)})


def dual_scale_metrics(df: DataFrame, by: Sequence[str], y_true: str = "y_true", y_pred: str = "y_pred",
                       scale: str = "log") -> DataFrame:
    """RMSE, MAE and R2 on the log scale, RMSE and MAE on the raw scale, per group.

    R2 of a constant actual is 1 for a perfect fit and 0 otherwise; one row has none.
    """
    both = on_both_scales(df, y_true, y_pred, scale).where(
        F.col("y_true_log").isNotNull() & F.col("y_pred_log").isNotNull()
    )
    d = F.col("y_pred_log") - F.col("y_true_log")
    r = F.col("y_pred_raw") - F.col("y_true_raw")
    total = F.var_pop("y_true_log") * F.count("*")
    return both.groupBy(*by).agg(
        F.count("*").alias("n"),
        F.sqrt(F.avg(d * d)).alias("rmse_log"),
        F.avg(F.abs(d)).alias("mae_log"),
        F.when(F.count("*") >= 2, F.coalesce(
            1 - F.sum(d * d) / F.nullif(total, F.lit(0.0)), F.when(F.sum(d * d) == 0, 1.0).otherwise(0.0)
        )).alias("r2_log"),
        F.sqrt(F.avg(r * r)).alias("rmse_raw"),
        F.avg(F.abs(r)).alias("mae_raw"),
    )


def compare_models(metrics: DataFrame) -> DataFrame:
    return metrics.orderBy("rmse_log", "model")


def split_summary(metrics: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    """One row per model from rows keyed by (model, split)."""
    def at(split: str, column: str) -> Column:
        return F.max(F.when(F.col("split") == split, F.col(column)))

    return metrics.groupBy(*by).agg(
        at("train", "rmse_log").alias("train_RMSE_log"), at("val", "rmse_log").alias("val_RMSE_log"),
        at("test", "rmse_log").alias("test_RMSE_log"), at("val", "mae_log").alias("val_MAE_log"),
        at("val", "r2_log").alias("val_R2_log"), at("val", "rmse_raw").alias("val_RMSE_raw"),
        at("val", "mae_raw").alias("val_MAE_raw"),
    )


def residual_table(predictions: DataFrame, key: str, metadata: DataFrame | None = None) -> DataFrame:
    """Residual, absolute residual and the raw-scale pair; metadata joined by key."""
    d = F.col("y_pred_log") - F.col("y_true_log")
    out = predictions.withColumns({
        "residual": d, "abs_residual": F.abs(d),
        "y_true_raw": F.expm1("y_true_log"), "y_pred_raw": F.expm1("y_pred_log"),
    })
    return out if metadata is None else out.join(metadata, key, "left")


def residual_moments(residuals: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Mean residual with the population and the sample deviation."""
    return residuals.groupBy(*by).agg(
        F.count("residual").alias("n"), F.avg("residual").alias("mean"),
        F.stddev_pop("residual").alias("std_population"), F.stddev("residual").alias("std_sample"),
    )


def quantile_rmse(df: DataFrame, quantiles: Sequence[float] = (0.25, 0.5, 0.75, 0.9, 0.95)) -> DataFrame:
    """RMSE at or below, and above, each quantile of the actual value."""
    names = {f"q{i}": ("y_true_log", q) for i, q in enumerate(quantiles)}
    edges = with_quantiles(df.agg(F.count("*").alias("n")), df, [], names)
    edge = edges.select(F.array(*list(names)).alias("e")).scalar()
    d2 = F.pow(F.col("y_pred_log") - F.col("y_true_log"), 2)
    aggs = []
    for i in range(len(quantiles)):
        low = F.col("y_true_log") <= edge[i]
        aggs += [F.count_if(low).alias(f"n{i}"), F.sqrt(F.avg(F.when(low, d2))).alias(f"b{i}"),
                 F.sqrt(F.avg(F.when(~low, d2))).alias(f"a{i}")]
    return melt_row(df.agg(*aggs), [{
        "percentile": F.lit(int(round(q * 100))), "n": F.col(f"n{i}"),
        "rmse_log_below": F.col(f"b{i}"), "rmse_log_above": F.col(f"a{i}"),
    } for i, q in enumerate(quantiles)])


_MEDIANS = {
    "median_actual": ("y_true_raw", 0.5), "median_predicted": ("y_pred_raw", 0.5), "median_ae_raw": ("ae_raw", 0.5),
}


def error_by(residuals: DataFrame, keys: Sequence[str],
             medians: Sequence[str] = ("median_actual", "median_predicted", "median_ae_raw")) -> DataFrame:
    """The error statistics of one slice: size, medians, mean errors, bias."""
    src = residuals.withColumn("ae_raw", F.abs(F.col("y_pred_raw") - F.col("y_true_raw")))
    base = src.groupBy(*keys).agg(
        F.count("*").alias("n"),
        F.avg("ae_raw").alias("mean_ae_raw"),
        F.sqrt(F.avg(F.col("residual") * F.col("residual"))).alias("rmse_log"),
        F.avg("abs_residual").alias("mae_log"),
        F.avg("residual").alias("mean_residual"),
    )
    return with_quantiles(base, src, keys, {m: _MEDIANS[m] for m in medians})


def error_overall(residuals: DataFrame) -> DataFrame:
    return error_by(residuals, [], ["median_ae_raw"])


def error_by_target_bucket(residuals: DataFrame) -> DataFrame:
    # The raw value comes back from a log, so it is rounded before it meets an edge.
    bucket = band(F.round("y_true_raw", 3), vocab.TARGET_EDGES, vocab.TARGET_LABELS)
    return error_by(residuals.withColumn("bucket", bucket), ["bucket"])


def error_by_age_bucket(residuals: DataFrame, age: str) -> DataFrame:
    return error_by(residuals.withColumn("bucket", band(F.col(age), vocab.AGE_EDGES, vocab.AGE_LABELS)), ["bucket"])


def error_by_label(residuals: DataFrame, flags: Mapping[str, str]) -> DataFrame:
    """One row per label flag, hardest first; a row counts under each label it has."""
    labels = F.array_compact(F.array(*[F.when(F.col(c) == 1, label) for c, label in flags.items()]))
    slim = residuals.select("y_true_raw", "y_pred_raw", "residual", "abs_residual", F.explode(labels).alias("label"))
    return error_by(slim, ["label"]).orderBy(F.desc("rmse_log"), "label")


def quantile_bins(df: DataFrame, column: str, labels: Sequence[str]) -> Column:
    """Right-closed bins at the exact quantile edges of a column."""
    k = len(labels)
    names = {f"q{i}": (column, i / k) for i in range(1, k)}
    edges = with_quantiles(df.agg(F.count("*").alias("n")), df, [], names)
    edge = edges.select(F.array(*list(names)).alias("e")).scalar()
    expr = F.lit(labels[-1])
    for i in reversed(range(k - 1)):
        expr = F.when(F.col(column) <= edge[i], labels[i]).otherwise(expr)
    return F.when(F.col(column).isNotNull(), expr)


def error_by_length_quintile(residuals: DataFrame, length: str) -> DataFrame:
    bins = quantile_bins(residuals, length, vocab.LENGTH_LABELS)
    return error_by(residuals.withColumn("bucket", bins), ["bucket"])


def worst_predictions(residuals: DataFrame, key: str, columns: Sequence[str], k: int = 15) -> DataFrame:
    """The ``k`` largest over-predictions and the ``k`` largest under-predictions."""
    slim = residuals.select(key, *columns, "y_true_raw", "y_pred_raw", "residual")
    over = slim.orderBy(F.desc("residual"), key).limit(k).withColumn("kind", F.lit("over"))
    under = slim.orderBy("residual", key).limit(k).withColumn("kind", F.lit("under"))
    return over.unionByName(under)


def prediction_sample(predictions: DataFrame, key: str, n: int = 20, seed: int = 42) -> DataFrame:
    """``n`` random rows: actual, predicted, residual, absolute error to 4 places."""
    d = F.col("y_pred_log") - F.col("y_true_log")
    return sample_rows(predictions, key, n, seed).select(
        key, F.round("y_true_log", 4).alias("actual"), F.round("y_pred_log", 4).alias("predicted"),
        F.round(d, 4).alias("residual"), F.round(F.abs(d), 4).alias("abs_error"),
    ).orderBy(key)
