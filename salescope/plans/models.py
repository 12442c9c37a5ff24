"""Model queries. Fitted models are checked by rows here and by closed forms in tests."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from salescope.functions import parsing as P
from salescope.operators import linear as L
from salescope.operators import selection as X
from salescope.operators import trees as T
from salescope.operators.evaluate import dual_scale_metrics, split_summary
from salescope.operators.features import FeatureBundle, stratified_split
from salescope.operators.preprocess import add_log_target, encode_class, log_skewed, preprocess
from salescope.operators.profile import corr_with_target
from salescope.plans.entity import ALL_COLUMNS, entity_table
from salescope.plans.evaluation import SPLIT_SQL, predictions
from salescope.plans.features import launch_bundle
from salescope.plans.registry import ENTITY, pre_sql, query, rounded
from salescope.session import materialize, new_table_path
from salescope.sources.sinks import load_model, save_model


def _forest():
    return T.random_forest(trees=10, depth=6)


@query("mean_predictor", pre_sql(SPLIT_SQL + """
  SELECT entity_id, split, round(log_copies_sold, 6) AS label,
         (SELECT round(avg(log_copies_sold), 6) FROM split WHERE split = 'train') AS prediction FROM split"""))
def _(spark, sf):
    df = materialize(predictions(spark, sf).select("entity_id", "split", F.col("y_true_log").alias("label")), "labels")
    return rounded(L.mean_predictor(df))


_SINGLE = SPLIT_SQL + """
  , t AS (SELECT log_copies_sold AS y, price AS x FROM split WHERE split = 'train'),
  m AS (SELECT count(*) AS n, regr_slope(y, x) AS b, regr_intercept(y, x) AS a, regr_sxx(y, x) AS sxx,
               regr_syy(y, x) AS syy, regr_sxy(y, x) AS sxy, avg(x) AS mx, avg(y) AS my FROM t),
  s AS (SELECT *, (syy - b * sxy) / (n - 2) AS v FROM m)"""


def _single_rows(spark, sf):
    """One-predictor rows with their split: log price against the log target."""
    df = entity_table(spark, sf, ["entity_id", "publisher_class", "copies_sold", "price"]).where(
        F.col("copies_sold").isNotNull())
    df = add_log_target(log_skewed(encode_class(df, ENTITY), ENTITY), ENTITY).select(
        "entity_id", "publisher_class_ord", F.col("price").alias("z_price"), F.col("log_copies_sold").alias("label"))
    split = stratified_split(materialize(df, "single"), "entity_id", ["publisher_class_ord"])
    return materialize(split, "single-split")


def _single(spark, sf):
    return L.moments(_single_rows(spark, sf).where(F.col("split") == "train"), ["price"])


@query("model_save_load", pre_sql(_SINGLE + """
  SELECT entity_id, split.split, round(log_copies_sold, 6) AS label, round(a + b * price, 6) AS prediction FROM split, s"""))
def _(spark, sf):
    data = _single_rows(spark, sf)
    pipeline = Pipeline(stages=[VectorAssembler(inputCols=["z_price"], outputCol="features"), LinearRegression()])
    path = new_table_path(spark, "model")
    save_model(pipeline.fit(data.where(F.col("split") == "train")), path)
    return rounded(load_model(path).transform(data).select("entity_id", "split", "label", "prediction"))


@query("lasso_single", pre_sql(_SINGLE + """
  SELECT 'price' AS feature, round(sign(sxy) * greatest(abs(sxy) / n - 0.05, 0) / (sxx / n), 4) + 0.0::DOUBLE AS coef FROM s"""))
def _(spark, sf):
    data = VectorAssembler(inputCols=["z_price"], outputCol="features").transform(_single_rows(spark, sf))
    fit = L.lasso(FeatureBundle(data, ["price"], None), 0.05)
    return rounded(spark.createDataFrame([("price", float(fit.coef[0]))], "feature string, coef double"), 4)


@query("ols_single", pre_sql(_SINGLE + """
  SELECT 'price' AS feature, round(b, 6) AS coef, round(sqrt(v / sxx), 6) AS std_err, round(b / sqrt(v / sxx), 6) AS t_stat FROM s
  UNION ALL SELECT 'const', round(a, 6), round(sqrt(v * (1.0::DOUBLE / n + mx * mx / sxx)), 6),
    round(a / sqrt(v * (1.0::DOUBLE / n + mx * mx / sxx)), 6) FROM s"""))
def _(spark, sf):
    return rounded(L.ols_inference(spark, _single(spark, sf)).select("feature", "coef", "std_err", "t_stat"))


@query("ridge_single", pre_sql(_SINGLE + """
  SELECT 'price' AS feature, round(sxy / (sxx + 25.0::DOUBLE), 6) AS coef,
         round(my - mx * sxy / (sxx + 25.0::DOUBLE), 6) AS intercept FROM s"""))
def _(spark, sf):
    fit = L.ridge(_single(spark, sf), 25.0)
    return rounded(spark.createDataFrame([("price", float(fit.coef[0]), fit.intercept)],
                                         "feature string, coef double, intercept double"))


@query("ols_inference")
def _(spark, sf):
    bundle = launch_bundle(spark, sf)
    return rounded(L.ols_inference(spark, L.moments(bundle.part("train"), bundle.names)), 4)


@query("ols_effect_tests")
def _(spark, sf):
    bundle = launch_bundle(spark, sf)
    table = L.ols_inference(spark, L.moments(bundle.part("train"), bundle.names))
    price = L.ols_effect_tests(table, "price", "left")
    return rounded(price.unionByName(L.ols_effect_tests(table, "publisher_class_ord", "two")), 4)


@query("ridge")
def _(spark, sf):
    bundle = launch_bundle(spark, sf)
    return rounded(L.ranked_coefficients(spark, L.ridge(L.moments(bundle.part("train"), bundle.names))), 4)


@query("lasso_select")
def _(spark, sf):
    bundle = launch_bundle(spark, sf)
    return rounded(L.ranked_coefficients(spark, L.lasso(bundle), nonzero_only=True, top=30), 4)


@query("baseline_table")
def _(spark, sf):
    return rounded(L.baseline_table(launch_bundle(spark, sf)), 4)


@query("pca_ridge")
def _(spark, sf):
    bundle = launch_bundle(spark, sf)
    m = L.moments(bundle.part("train"), bundle.names)
    scored = L.stacked_predictions(bundle.data, {"PCA20+Ridge": L.pca_ridge(m, 20).column()})
    return rounded(split_summary(dual_scale_metrics(scored, ["model", "split"])), 4)


@query("pca_variance")
def _(spark, sf):
    bundle = launch_bundle(spark, sf)
    return rounded(L.pca_variance(spark, L.moments(bundle.part("train"), bundle.names)), 4)


@query("pca_variance_pair", pre_sql("""
  , r AS (SELECT abs(corr(price, achievements)) AS r FROM pre)
  SELECT CAST(1 AS INTEGER) AS component, round((1 + r) / 2, 6) AS variance_ratio, round((1 + r) / 2, 6) AS cumulative,
         CAST(2 AS INTEGER) AS n_for_threshold FROM r
  UNION ALL SELECT 2, round((1 - r) / 2, 6), 1.0::DOUBLE, 2 FROM r"""))
def _(spark, sf):
    df = entity_table(spark, sf, ["copies_sold", "price", "achievements"]).where(F.col("copies_sold").isNotNull())
    df = materialize(df.select(P.log1p_floor(F.col("price")).alias("z_price"),
                               P.log1p_floor(F.col("achievements")).alias("z_achievements"),
                               F.log1p("copies_sold").alias("label")), "pair")
    return rounded(L.pca_variance(spark, L.moments(df, ["price", "achievements"])))


@query("pca_sweep")
def _(spark, sf):
    return rounded(L.pca_sweep(launch_bundle(spark, sf)), 4)


@query("pca_by_segment")
def _(spark, sf):
    bundle = launch_bundle(spark, sf, keep=["publisher_class_ord"])
    return rounded(L.pca_by_segment(bundle, "publisher_class_ord"), 4)


@query("random_forest")
def _(spark, sf):
    bundle = launch_bundle(spark, sf)
    return rounded(T.importances(spark, T.random_forest().fit(bundle.part("train")), bundle.names), 4)


@query("gbt_early_stop")
def _(spark, sf):
    _, curve, _ = T.gbt_early_stop(launch_bundle(spark, sf))
    return rounded(curve, 4)


@query("gbt_best")
def _(spark, sf):
    """Metrics of the boosted model cut at its best iteration."""
    bundle = launch_bundle(spark, sf)
    model, _, best = T.gbt_early_stop(bundle, iterations=12, rate=0.1, depth=4)
    metrics = split_summary(dual_scale_metrics(T.predict(bundle, {"BoostedTrees": model}), ["model", "split"]))
    return rounded(metrics.withColumn("n_trees", F.lit(best + 1)), 4)


@query("tree_table")
def _(spark, sf):
    return rounded(T.tree_table(launch_bundle(spark, sf), {
        "RandomForest": _forest(), "BoostedTrees": T.boosted_trees(8, rate=0.2, depth=4)}), 4)


@query("skew_aware_losses")
def _(spark, sf):
    return rounded(T.skew_aware_losses(launch_bundle(spark, sf, keep=["copies_sold"]), "copies_sold",
                                       iterations=8, depth=4, rate=0.2), 4)


@query("feature_toggle_ab")
def _(spark, sf):
    bundle = launch_bundle(spark, sf, use_year=True)
    arms = {"year_only": ["entity_age"], "age_only": ["release_year"]}
    return rounded(T.feature_toggle_ab(
        bundle, arms, lambda: {"RandomForest": _forest(), "BoostedTrees": T.boosted_trees(8, rate=0.2, depth=4)}), 4)


@query("step_size_sweep")
def _(spark, sf):
    return rounded(T.step_size_sweep(launch_bundle(spark, sf), (0.01, 0.05, 0.1, 0.3), iterations=6, depth=4), 4)


@query("rfe_fixed")
def _(spark, sf):
    return rounded(X.rfe_fixed(launch_bundle(spark, sf), _forest, keep=10, step=8), 4)


def _rfe_cv(spark, sf):
    return X.rfe_cv(launch_bundle(spark, sf), "entity_id", _forest, min_features=5, step=10)


@query("rfe_cv")
def _(spark, sf):
    table, _ = _rfe_cv(spark, sf)
    return rounded(table, 4)


@query("rfe_cv_ranking")
def _(spark, sf):
    """The ranking that ends at the size of least cross-validated error."""
    _, ranking = _rfe_cv(spark, sf)
    return rounded(ranking, 4)


_RANKED = ["price", "publisher_class_ord", "tag_count", "achievements", "entity_age", "language_count", "developer_freq"]
_RANKING_SQL = pre_sql(", c AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, abs(corr(CAST({c} AS DOUBLE), log_copies_sold)) AS r FROM pre" for c in _RANKED) + """),
  placed AS (SELECT *, row_number() OVER (ORDER BY r DESC) AS p FROM c),
  ranking AS (SELECT feature, CAST(greatest(p - 2, 1) AS INTEGER) AS ranking, p <= 3 AS selected,
                     CASE WHEN p <= 3 THEN r ELSE 0 END AS importance_in_final FROM placed)
  SELECT feature, ranking, selected, round(importance_in_final, 6) AS importance_in_final,
         CAST(row_number() OVER (ORDER BY selected DESC, importance_in_final DESC, ranking, feature) AS INTEGER) AS place
  FROM ranking ORDER BY place LIMIT 5""")


@query("topn_selection", _RANKING_SQL)
def _(spark, sf):
    df = preprocess(entity_table(spark, sf, ALL_COLUMNS), ENTITY)
    corr = corr_with_target(df, _RANKED, "log_copies_sold", len(_RANKED)).collect()
    rows = [(r.feature, max(i - 1, 1), i < 3, abs(r["corr"]) if i < 3 else 0.0) for i, r in enumerate(corr)]
    return rounded(X.top_n_from_ranking(spark.createDataFrame(rows, X.RANKING_SCHEMA), 5))


@query("topn_refit")
def _(spark, sf):
    bundle = launch_bundle(spark, sf)
    _, ranking = X.rfe_cv(bundle, "entity_id", _forest, min_features=5, step=12)
    chosen = [r.feature for r in X.top_n_from_ranking(ranking, 12).collect()]
    out = T.tree_table(bundle.select(chosen), {"RandomForest": _forest(), "BoostedTrees": T.boosted_trees(8, rate=0.2, depth=4)})
    return rounded(out.withColumn("n_features", F.lit(len(chosen))), 4)
