"""Linear models and principal components from one distributed moment pass.

Spark sums the centred cross products of the features and the label over Arrow
batches (nothing but p x p numbers reaches the driver). OLS, ridge, lasso, PCA and
PCA + ridge for every component count then follow from that matrix, and predicting is
a plain column expression. Models per segment take the moments of all segments in the
same single pass and are solved on the executors, so the number of segments is free.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salescope.functions.parsing import slug
from salescope.functions.student import t_quantile, two_sided_p
from salescope.operators.evaluate import dual_scale_metrics, split_summary
from salescope.operators.features import FeatureBundle
from salescope.operators.gram import PairMoments, group_moments, per_group, whole_moments
from salescope.operators.order_stats import null_safe
from salescope.session import materialize


@dataclass(frozen=True)
class Moments:
    """Row count, means and centred cross products of named features and a label."""

    names: list[str]
    n: int
    x_mean: np.ndarray
    y_mean: float
    sxx: np.ndarray
    sxy: np.ndarray
    syy: float


def _moments(names: Sequence[str], m: PairMoments) -> Moments:
    """The features' part and the label's part, the label being the last column."""
    p = len(names)
    return Moments(list(names), int(m.n[p, p]), np.diag(m.mean)[:p], float(m.mean[p, p]), m.cross[:p, :p], m.cross[:p, p],
                   float(m.cross[p, p]))


def moments(df: DataFrame, names: Sequence[str], label: str = "label", prefix: str = "z_") -> Moments:
    """Moments of a table without gaps; no rows, or a null or NaN in a feature or the label, raise."""
    columns = [prefix + n for n in names] + [label]
    m = whole_moments(df, columns)
    if not m.n.any():
        raise ValueError("no rows to fit on")
    if not m.complete:
        have = np.diag(m.n)
        raise ValueError(f"null or NaN in {[c for c, n in zip(columns, have) if n < have.max()] or columns}")
    return _moments(names, m)


@dataclass(frozen=True)
class LinearFit:
    names: list[str]
    coef: np.ndarray
    intercept: float

    def column(self, prefix: str = "z_") -> Column:
        expr = F.lit(float(self.intercept))
        for n, b in zip(self.names, self.coef):
            if b != 0.0:
                expr = expr + F.col(prefix + n) * F.lit(float(b))
        return expr


def _fit(m: Moments, coef: np.ndarray) -> LinearFit:
    return LinearFit(m.names, coef, float(m.y_mean - m.x_mean @ coef))


def ols(m: Moments) -> LinearFit:
    return _fit(m, np.linalg.pinv(m.sxx, hermitian=True, rcond=1e-10) @ m.sxy)


def ridge(m: Moments, alpha: float = 1.0) -> LinearFit:
    """Penalty ``alpha * |w|^2`` on the summed squared error; free intercept."""
    return _fit(m, np.linalg.solve(m.sxx + alpha * np.eye(len(m.names)), m.sxy))


def _soft(x: float, by: float) -> float:
    return float(np.sign(x)) * max(abs(x) - by, 0.0)


def lasso_path(m: Moments, alphas: Sequence[float], tol: float = 1e-13, sweeps: int = 100_000) -> list[LinearFit]:
    """Lasso fits along ``alphas``, each started from the one before.

    Coordinate descent with covariance updates: the gradient of all coefficients is kept
    and moved by one column of the moment matrix per changed coefficient, so no step
    touches a row. Sweeps run over the nonzero coefficients until they settle, then over
    all of them, and end when a whole sweep changes nothing more than ``tol``.
    """
    gram, target = m.sxx / m.n, m.sxy / m.n
    diag = np.diag(gram)
    w, gradient = np.zeros(len(m.names)), target.copy()
    scale = tol * max(np.sqrt(m.syy / m.n), 1e-300)
    usable = [j for j in range(len(w)) if diag[j] > 0.0]
    fits = []
    for alpha in alphas:
        active = usable
        for _ in range(sweeps):
            moved = 0.0
            for j in active:
                new = _soft(gradient[j] + diag[j] * w[j], alpha) / diag[j]
                if new != w[j]:
                    step = new - w[j]
                    gradient -= gram[:, j] * step
                    w[j] = new
                    moved = max(moved, abs(step) * np.sqrt(diag[j]))
            if moved <= scale:
                if active is usable:
                    break
                active = usable
            else:
                active = [j for j in usable if w[j] != 0.0] or usable
        gradient = target - gram @ w  # the next fit starts without the rounding of this one
        fits.append(_fit(m, w.copy()))
    return fits


def lasso_of(m: Moments, alpha: float, steps: int = 20) -> LinearFit:
    """The fit at ``alpha``, reached from the least penalty that zeroes every coefficient."""
    top = float(np.abs(m.sxy / m.n).max(initial=0.0))
    path = np.geomspace(top, alpha, steps)[1:-1].tolist() if 0.0 < alpha < top else []
    return lasso_path(m, [*path, alpha])[-1]


def lasso(bundle: FeatureBundle, alpha: float = 0.01) -> LinearFit:
    """Penalty ``alpha * |w|_1`` on half the mean squared error; free intercept."""
    return lasso_of(moments(bundle.part("train"), bundle.names), alpha)


def ols_inference(spark, m: Moments, level: float = 0.95) -> DataFrame:
    """Coefficient table with standard errors, t, p and confidence bounds, by p.

    Collinear columns share their effect through the pseudo-inverse.
    """
    inverse = np.linalg.pinv(m.sxx, hermitian=True, rcond=1e-10)
    coef = inverse @ m.sxy
    dof = int(m.n - np.linalg.matrix_rank(m.sxx, hermitian=True) - 1)
    variance = max(m.syy - coef @ m.sxy, 0.0) / dof
    se = np.sqrt(variance * np.concatenate([
        [1.0 / m.n + m.x_mean @ inverse @ m.x_mean], np.clip(np.diag(inverse), 0.0, None)
    ]))
    beta = np.concatenate([[m.y_mean - m.x_mean @ coef], coef])
    reach = t_quantile(0.5 + level / 2, dof)
    rows = []
    for name, b, s in zip(["const", *m.names], beta, se):
        t = float(b / s) if s > 0 else None
        p = float(two_sided_p(t, dof)) if t is not None else None
        rows.append((name, float(b), float(s), t, p, float(b - reach * s), float(b + reach * s)))
    rows.sort(key=lambda r: (r[4] is None, r[4] or 0.0, r[0]))
    return spark.createDataFrame(
        rows, "feature string, coef double, std_err double, t_stat double, p_value double, ci_low double, ci_high double"
    )


def ols_effect_tests(table: DataFrame, feature: str, side: str = "left", alpha: float = 0.05) -> DataFrame:
    """Decision on one coefficient: left-, right- or two-sided, with its multiplier."""
    p, t = F.col("p_value"), F.col("t_stat")
    one_sided = {
        "left": F.when(t > 0, 1 - p / 2).otherwise(p / 2),
        "right": F.when(t > 0, p / 2).otherwise(1 - p / 2),
        "two": p,
    }[side]
    agrees = {"left": F.col("coef") < 0, "right": F.col("coef") > 0, "two": F.lit(True)}[side]
    return table.where(F.col("feature") == feature).select(
        "feature", "coef", "std_err", "t_stat", "p_value", "ci_low", "ci_high", F.lit(side).alias("side"),
        one_sided.alias("p_side"), F.exp("coef").alias("multiplier"),
        ((one_sided < alpha) & agrees).cast("int").alias("reject"),
    )


def ranked_coefficients(spark, fit: LinearFit, nonzero_only: bool = False, top: int | None = None) -> DataFrame:
    """Coefficients by absolute value, with the number the fit set to zero."""
    zeroed = int(np.sum(fit.coef == 0.0))
    rows = [(n, float(c), abs(float(c)), zeroed) for n, c in zip(fit.names, fit.coef) if c != 0.0 or not nonzero_only]
    rows.sort(key=lambda r: (-r[2], r[0]))
    return spark.createDataFrame(rows[:top], "feature string, coef double, abs_coef double, n_zeroed int")


def mean_predictor(df: DataFrame, label: str = "label") -> DataFrame:
    """Predict the training mean on every row."""
    mean = df.where(F.col("split") == "train").agg(F.avg(label)).scalar()
    return df.withColumn("prediction", mean)


def stacked_predictions(data: DataFrame, columns: Mapping[str, Column], keep: Sequence[str] = ("split",)) -> DataFrame:
    """Long table ``(model, keep..., y_true, y_pred)`` from one scan of the bundle."""
    return data.select(*keep, F.col("label").alias("y_true"), F.explode(F.array(*[
        F.struct(F.lit(m).alias("model"), c.cast("double").alias("y_pred")) for m, c in columns.items()
    ])).alias("__p")).select("__p.model", *keep, "y_true", "__p.y_pred")


def baseline_table(bundle: FeatureBundle, alpha_ridge: float = 1.0, alpha_lasso: float = 0.01) -> DataFrame:
    """Mean, OLS, ridge and lasso on every split."""
    m = moments(bundle.part("train"), bundle.names)
    columns = {
        "MeanPredictor": F.lit(m.y_mean),
        "LinearRegression": ols(m).column(),
        f"Ridge({alpha_ridge:g})": ridge(m, alpha_ridge).column(),
        f"Lasso({alpha_lasso:g})": lasso_of(m, alpha_lasso).column(),
    }
    return split_summary(dual_scale_metrics(stacked_predictions(bundle.data, columns), ["model", "split"]))


@dataclass(frozen=True)
class Components:
    """Principal axes of the standardized features, largest variance first."""

    scale: np.ndarray
    values: np.ndarray
    axes: np.ndarray

    @property
    def ratio(self) -> np.ndarray:
        return self.values / self.values.sum()


def principal_components(m: Moments) -> Components:
    scale = np.sqrt(np.diag(m.sxx) / m.n)
    scale[scale == 0.0] = 1.0
    values, axes = np.linalg.eigh(m.sxx / m.n / np.outer(scale, scale))
    order = np.argsort(values)[::-1]
    values, axes = np.clip(values[order], 0.0, None), axes[:, order]
    signs = np.sign(axes[np.abs(axes).argmax(axis=0), range(axes.shape[1])])
    return Components(scale, values, axes * np.where(signs == 0, 1.0, signs))


def pca_ridge(m: Moments, k: int, alpha: float = 1.0, pcs: Components | None = None) -> LinearFit:
    """Ridge on the first ``k`` component scores, folded back onto the features.

    Scores are uncorrelated, so each component's ridge weight is a quotient.
    """
    pcs = pcs or principal_components(m)
    axes, values = pcs.axes[:, :k], pcs.values[:k]
    score_y = axes.T @ (m.sxy / pcs.scale)
    return _fit(m, (axes @ (score_y / (m.n * values + alpha))) / pcs.scale)


def pca_variance(spark, m: Moments, threshold: float = 0.95) -> DataFrame:
    """Explained and cumulative variance per component, and the smallest count that
    reaches the threshold (null when none does)."""
    ratio = principal_components(m).ratio
    cumulative = np.cumsum(ratio)
    reached = np.flatnonzero(cumulative >= threshold - 1e-12)
    needed = int(reached[0]) + 1 if len(reached) else None
    rows = [(i + 1, float(r), float(c), needed) for i, (r, c) in enumerate(zip(ratio, cumulative))]
    return spark.createDataFrame(
        rows, "component int, variance_ratio double, cumulative double, n_for_threshold int")


def pca_sweep(bundle: FeatureBundle, ks: Sequence[int] = (5, 10, 15, 20, 30, 40, 50), alpha: float = 1.0) -> DataFrame:
    """Train and validation metrics per component count: one moment pass, one scoring scan."""
    m = moments(bundle.part("train"), bundle.names)
    pcs = principal_components(m)
    ks = [k for k in ks if k <= len(bundle.names)]
    columns = {str(k): pca_ridge(m, k, alpha, pcs).column() for k in ks}
    scored = stacked_predictions(bundle.data.where(F.col("split") != "test"), columns)
    metrics = dual_scale_metrics(scored, ["model", "split"])

    def at(split: str, c: str) -> Column:
        return F.max(F.when(F.col("split") == split, F.col(c)))

    share = np.cumsum(pcs.ratio)
    explained = F.create_map(*[x for k in ks for x in (F.lit(k), F.lit(float(share[k - 1])))])
    return (
        metrics.groupBy(F.col("model").cast("int").alias("n_components"))
        .agg(at("train", "r2_log").alias("train_r2"), at("train", "rmse_log").alias("train_rmse"),
             at("val", "r2_log").alias("val_r2"), at("val", "rmse_log").alias("val_rmse"))
        .withColumn("explained_variance", explained[F.col("n_components")]).orderBy("n_components")
    )


def fits_by_segment(data: DataFrame, names: Sequence[str], segment: str, solve, fields: str = "") -> DataFrame:
    """One row per segment with ``coef`` (an array in the order of ``names``) and ``intercept``.

    The moments of all segments come from one scan and are solved where they are merged.
    ``solve`` turns :class:`Moments` into a :class:`LinearFit` and the values of ``fields``,
    or None to leave the segment out. A gap in a feature or the label raises.
    """
    names = list(names)
    columns = [f"z_{n}" for n in names] + ["label"]
    states = group_moments(data.where(F.col(segment).isNotNull()), columns, segment)

    def rows(m: PairMoments):
        if not m.complete:
            raise ValueError("null or NaN in a feature or the label")
        got = solve(_moments(names, m))
        if got is not None:
            fit, *more = got
            yield fit.coef.tolist(), fit.intercept, *more

    found = per_group(states, len(columns), rows, "coef array<double>, intercept double" + (f", {fields}" if fields else ""))
    return materialize(found.withColumnRenamed("key", segment), "segment-fits")


def predicted_by_segment(data: DataFrame, fits: DataFrame, names: Sequence[str], segment: str) -> DataFrame:
    """``data`` with ``y_true`` and the prediction ``y_pred`` of its segment's fit, null where there is none."""
    known = data.where(F.col(segment).isNotNull()).withColumn("y_true", F.col("label"))
    joined = known.join(fits.select(F.col(segment).alias("__of"), "coef", "intercept"), F.col(segment) == F.col("__of"), "left")
    value = F.col("intercept")
    for i, n in enumerate(names):
        value = value + F.col(f"z_{n}") * F.col("coef")[i]
    return joined.withColumn("y_pred", value).drop("__of", "coef", "intercept")


def pca_by_segment(bundle: FeatureBundle, segment: str, n_components: int = 10, alpha: float = 1.0,
                   min_rows: int = 10) -> DataFrame:
    """PCA + ridge per segment on its own rows; small segments are skipped."""
    def solve(m: Moments):
        if m.n < min_rows:
            return None
        k = min(n_components, len(m.names), max(1, m.n // 10))
        pcs = principal_components(m)
        return pca_ridge(m, k, alpha, pcs), k, float(np.cumsum(pcs.ratio)[k - 1])

    fits = fits_by_segment(bundle.data, bundle.names, segment, solve, "n_components int, explained_variance double")
    scored = predicted_by_segment(bundle.data, fits, bundle.names, segment)
    metrics = dual_scale_metrics(scored, [segment]).select(
        segment, "n", F.col("r2_log").alias("train_r2"), F.col("rmse_log").alias("train_rmse"))
    return null_safe(metrics, fits.select(segment, "n_components", "explained_variance"), [segment])


def pca_projection(bundle: FeatureBundle, key: str, k: int = 2) -> tuple[DataFrame, np.ndarray]:
    """First ``k`` component scores of every row and the variance share of each."""
    m = moments(bundle.data, bundle.names)
    pcs = principal_components(m)
    scores = []
    for j in range(k):
        weights = pcs.axes[:, j] / pcs.scale
        fit = LinearFit(m.names, weights, float(-(m.x_mean @ weights)))
        scores.append(fit.column().alias(f"pc{j + 1}"))
    return bundle.data.select(key, *scores), pcs.ratio[:k]


def segment_ols(data: DataFrame, names: Sequence[str], segment: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """One OLS per segment on its own split, all from one scan of the training rows.

    Returns the metrics per segment and pooled, the coefficients as ``(segment, feature,
    coef)`` with the intercept among them, and every prediction. ``data`` carries
    ``split`` drawn inside each segment.
    """
    def solve(m: Moments):
        return (ols(m),)

    fits = fits_by_segment(data.where(F.col("split") == "train"), names, segment, solve)
    scored = predicted_by_segment(data, fits, names, segment)
    named = scored.withColumn("segment", F.col(segment).cast("string"))
    both = named.select("split", "y_true", "y_pred", F.explode(F.array("segment", F.lit("Combined"))).alias("segment"))
    metrics = dual_scale_metrics(both, ["segment", "split"])
    table = split_summary(metrics, ["segment"])
    labels = F.array(*[F.lit(n) for n in names], F.lit("intercept"))
    pairs = F.arrays_zip(labels.alias("feature"), F.concat("coef", F.array("intercept")).alias("coef"))
    coefs = fits.select(F.col(segment).alias("segment"), F.explode(pairs).alias("p")).select("segment", "p.feature", "p.coef")
    return table, coefs, scored


def side_by_side(coefs: DataFrame, segments: Sequence) -> DataFrame:
    """The coefficients of the named segments as columns, null for one without a fit."""
    return coefs.groupBy("feature").agg(*[
        F.max(F.when(F.col("segment") == s, F.col("coef"))).alias(f"segment_{slug(str(s))}") for s in segments
    ])
