"""Evaluation queries over a deterministic predictor.

The predictor is the training mean of the log target per class and price kind,
so the SQL side can build the very same prediction table.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from salescope.functions import parsing as P
from salescope.operators import evaluate as V
from salescope.operators import preprocess as S
from salescope.operators.features import stratified_split
from salescope.operators.order_stats import null_safe
from salescope.operators.relational import union_summaries
from salescope.plans.entity import entity_table
from salescope.plans.registry import ENTITY, SEGMENT_WORDS, pre_sql, query, rounded
from salescope.session import materialize

SPLIT_SQL = """
  , numbered AS (
    SELECT *, row_number() OVER (PARTITION BY publisher_class_ord ORDER BY md5('42:' || entity_id)) AS rk,
           (count(*) OVER (PARTITION BY publisher_class_ord) * 15 + 50) // 100 AS share FROM pre
  ), split AS (
    SELECT *, CASE WHEN rk <= share THEN 'test' WHEN rk <= 2 * share THEN 'val' ELSE 'train' END AS split
    FROM numbered
  )"""

_PRED = SPLIT_SQL + """
  , fit AS (
    SELECT publisher_class_ord, is_free_to_play, round(avg(log_copies_sold), 6) AS y_pred_log
    FROM split WHERE split = 'train' GROUP BY ALL
  ), pred AS (
    SELECT s.*, log_copies_sold AS y_true_log,
           coalesce(f.y_pred_log, (SELECT round(avg(log_copies_sold), 6) FROM split WHERE split = 'train')) AS y_pred_log
    FROM split s LEFT JOIN fit f ON s.publisher_class_ord = f.publisher_class_ord AND s.is_free_to_play = f.is_free_to_play
  ), res AS (
    SELECT *, y_pred_log - y_true_log AS residual, abs(y_pred_log - y_true_log) AS abs_residual,
           exp(y_true_log) - 1 AS y_true_raw, exp(y_pred_log) - 1 AS y_pred_raw,
           abs(exp(y_pred_log) - exp(y_true_log)) AS ae_raw
    FROM pred
  ), test AS (SELECT * FROM res WHERE split = 'test')
"""


def pred_sql(body: str) -> str:
    return pre_sql(_PRED + body)


def predictions(spark, sf, *extra):
    """Key, split, both log values and the requested context columns."""
    raw = {"entity_id", "copies_sold", "publisher_class", "price"}
    derived = {
        "entity_age": ("first_release", lambda: P.entity_age(F.year(P.parse_utc(F.col("first_release"))), ENTITY.ref_year)),
        "description_length": ("about", lambda: P.text_length(F.col("about"))),
        "tag_count": ("tags", lambda: F.size(P.tag_list(F.col("tags")))),
        "language_count": ("languages", lambda: P.list_string_count(F.col("languages"))),
        "name": ("name", lambda: F.col("name")),
    }
    sources = {derived[c][0] for c in extra if c in derived} | ({"genres"} if "genre" in extra else set())
    df = entity_table(spark, sf, sorted(raw | sources)).where(F.col("copies_sold").isNotNull())
    df = S.encode_class(df, ENTITY).withColumn("is_free_to_play", P.flag(F.col("price") == 0))
    if "genre" in extra:
        df = S.parse_genres(df, ENTITY)
    genre = ["genre_" + g.lower() for g in SEGMENT_WORDS] if "genre" in extra else []
    df = materialize(df.select(
        "entity_id", F.log1p(F.col("copies_sold").cast("double")).alias("y_true_log"),
        "publisher_class_ord", "is_free_to_play", *genre,
        *[derived[c][1]().alias(c) for c in extra if c in derived],
    ), "cleaned")
    split = stratified_split(df, "entity_id", ["publisher_class_ord"])
    train = split.where(F.col("split") == "train")
    cells = ["publisher_class_ord", "is_free_to_play"]
    fit = train.groupBy(*cells).agg(F.round(F.avg("y_true_log"), 6).alias("__fit"))
    overall = train.agg(F.round(F.avg("y_true_log"), 6)).scalar()
    return null_safe(split, fit, cells, "left").withColumn(
        "y_pred_log", F.coalesce("__fit", overall)).drop("__fit")


def residuals(spark, sf, *extra):
    """Residual table of the test rows, written once because slices read it twice."""
    test = predictions(spark, sf, *extra).where(F.col("split") == "test")
    return materialize(V.residual_table(test, "entity_id"), "residuals")


_METRICS = """count(*) AS n, round(sqrt(avg(residual * residual)), 6) AS rmse_log, round(avg(abs_residual), 6) AS mae_log,
  round(1 - sum(residual * residual) / (var_pop(y_true_log) * count(*)), 6) AS r2_log,
  round(sqrt(avg(ae_raw * ae_raw)), 4) AS rmse_raw, round(avg(ae_raw), 4) AS mae_raw"""


def _metrics(df):
    return rounded(df.withColumns({c: F.round(c, 4) for c in ("rmse_raw", "mae_raw")}))


@query("dual_scale_metrics", pred_sql(f"SELECT split, {_METRICS} FROM res GROUP BY split"))
def _(spark, sf):
    return _metrics(V.dual_scale_metrics(predictions(spark, sf), ["split"], "y_true_log", "y_pred_log"))


@query("dual_scale_metrics_raw", pred_sql("""
  , shifted AS (SELECT split, y_true_raw AS t, y_pred_raw - 500 AS p FROM res),
  scaled AS (SELECT split, t, p, ln(1 + t) AS tl, ln(1 + greatest(p, 0)) AS pl FROM shifted)
  SELECT split, count(*) AS n, round(sqrt(avg((pl - tl) * (pl - tl))), 6) AS rmse_log, round(avg(abs(pl - tl)), 6) AS mae_log,
         round(1 - sum((pl - tl) * (pl - tl)) / (var_pop(tl) * count(*)), 6) AS r2_log,
         round(sqrt(avg((p - t) * (p - t))), 4) AS rmse_raw, round(avg(abs(p - t)), 4) AS mae_raw
  FROM scaled GROUP BY split"""))
def _(spark, sf):
    raw = predictions(spark, sf).select(
        "split", F.expm1("y_true_log").alias("t"), (F.expm1("y_pred_log") - 500.0).alias("p"))
    return _metrics(V.dual_scale_metrics(raw, ["split"], "t", "p", scale="raw"))


_STACKED = "residual, abs(residual) AS abs_residual, abs(exp(y_true_log + residual) - exp(y_true_log)) AS ae_raw"


@query("union_summaries", pred_sql(f"""
  , models AS (
    SELECT 'cell_mean' AS model, split, y_true_log, y_pred_log AS p FROM res
    UNION ALL SELECT 'train_mean', split, y_true_log,
      (SELECT avg(log_copies_sold) FROM split WHERE split = 'train') FROM res
  ), diff AS (SELECT model, split, y_true_log, p - y_true_log AS residual FROM models WHERE split = 'val'
  ), stacked AS (SELECT model, split, y_true_log, {_STACKED} FROM diff)
  SELECT model, split, {_METRICS} FROM stacked GROUP BY model, split"""))
def _(spark, sf):
    df = materialize(predictions(spark, sf), "predictions")
    mean = df.where(F.col("split") == "train").agg(F.avg("y_true_log")).scalar()
    val = df.where(F.col("split") == "val")
    tables = {
        "cell_mean": V.dual_scale_metrics(val, ["split"], "y_true_log", "y_pred_log"),
        "train_mean": V.dual_scale_metrics(val.withColumn("p", mean), ["split"], "y_true_log", "p"),
    }
    return _metrics(union_summaries(tables, "rmse_log", tag="model"))


@query("residual_table", pred_sql("""
  SELECT entity_id, split, name, tag_count, round(y_true_log, 6) AS y_true_log, round(y_pred_log, 6) AS y_pred_log,
         round(residual, 6) AS residual, round(abs_residual, 6) AS abs_residual,
         round(y_true_raw, 3) AS y_true_raw, round(y_pred_raw, 3) AS y_pred_raw FROM res"""))
def _(spark, sf):
    meta = entity_table(spark, sf, ["entity_id", "name", "tags"]).select(
        "entity_id", "name", F.size(P.tag_list(F.col("tags"))).alias("tag_count"))
    out = V.residual_table(predictions(spark, sf).drop("publisher_class_ord", "is_free_to_play"), "entity_id", meta)
    return rounded(out.withColumns({c: F.round(c, 3) for c in ("y_true_raw", "y_pred_raw")}))


@query("residual_moments", pred_sql("""
  SELECT split, count(*) AS n, round(avg(residual), 6) + 0.0::DOUBLE AS mean, round(stddev_pop(residual), 6) AS std_population,
         round(stddev_samp(residual), 6) AS std_sample FROM res GROUP BY split"""))
def _(spark, sf):
    return rounded(V.residual_moments(V.residual_table(predictions(spark, sf), "entity_id"), ["split"]))


_QS = (0.25, 0.5, 0.75, 0.9, 0.95)


@query("quantile_rmse", pred_sql(" UNION ALL ".join(f"""
  SELECT {int(q * 100)} AS percentile, count(*) FILTER (WHERE y_true_log <= t) AS n,
    round(sqrt(avg(residual * residual) FILTER (WHERE y_true_log <= t)), 6) AS rmse_log_below,
    round(sqrt(avg(residual * residual) FILTER (WHERE y_true_log > t)), 6) AS rmse_log_above
  FROM test, (SELECT quantile_cont(y_true_log, {q}) AS t FROM test)""" for q in _QS)))
def _(spark, sf):
    return rounded(V.quantile_rmse(residuals(spark, sf), _QS))


_ERR = """count(*) AS n, round(avg(ae_raw), 3) AS mean_ae_raw, round(sqrt(avg(residual * residual)), 6) AS rmse_log,
  round(avg(abs_residual), 6) AS mae_log, round(avg(residual), 6) AS mean_residual"""
_MED = """round(quantile_cont(y_true_raw, 0.5), 3) AS median_actual,
  round(quantile_cont(y_pred_raw, 0.5), 3) AS median_predicted, round(quantile_cont(ae_raw, 0.5), 3) AS median_ae_raw"""


def _err(df):
    raw = [c for c in ("mean_ae_raw", "median_actual", "median_predicted", "median_ae_raw") if c in df.columns]
    return rounded(df.withColumns({c: F.round(c, 3) for c in raw}))


@query("error_overall", pred_sql(
    f"SELECT {_ERR}, round(quantile_cont(ae_raw, 0.5), 3) AS median_ae_raw FROM test"))
def _(spark, sf):
    return _err(V.error_overall(residuals(spark, sf)))


@query("error_by_target_bucket", pred_sql(f"""
  SELECT CASE WHEN y <= 100 THEN '<=100' WHEN y <= 1000 THEN '100-1k' WHEN y <= 10000 THEN '1k-10k'
    WHEN y <= 100000 THEN '10k-100k' WHEN y <= 1000000 THEN '100k-1M' ELSE '>1M' END AS bucket, {_ERR}, {_MED}
  FROM (SELECT *, copies_sold AS y FROM test) GROUP BY 1"""))
def _(spark, sf):
    return _err(V.error_by_target_bucket(residuals(spark, sf)))


@query("error_by_category", pred_sql(f"SELECT publisher_class_ord, {_ERR}, {_MED} FROM test GROUP BY 1"))
def _(spark, sf):
    return _err(V.error_by(residuals(spark, sf), ["publisher_class_ord"]))


@query("error_by_monetisation", pred_sql(f"SELECT is_free_to_play, {_ERR}, {_MED} FROM test GROUP BY 1"))
def _(spark, sf):
    return _err(V.error_by(residuals(spark, sf), ["is_free_to_play"]))


@query("error_by_age_bucket", pred_sql(f"""
  SELECT CASE WHEN entity_age <= 0 THEN '0' WHEN entity_age <= 1 THEN '1' WHEN entity_age <= 3 THEN '2-3'
    WHEN entity_age <= 5 THEN '4-5' WHEN entity_age <= 10 THEN '6-10' WHEN entity_age > 10 THEN '>10' END AS bucket,
    {_ERR}, {_MED} FROM test GROUP BY 1"""))
def _(spark, sf):
    return _err(V.error_by_age_bucket(residuals(spark, sf, "entity_age"), "entity_age"))


@query("error_by_label", pred_sql(" UNION ALL ".join(
    f"SELECT '{g.lower()}' AS label, {_ERR}, {_MED} FROM test WHERE genre_{g.lower()} = 1" for g in SEGMENT_WORDS)))
def _(spark, sf):
    flags = {"genre_" + g.lower(): g.lower() for g in SEGMENT_WORDS}
    return _err(V.error_by_label(residuals(spark, sf, "genre"), flags))


@query("error_by_length_quintile", pred_sql(f"""
  , edges AS (SELECT quantile_cont(description_length::DOUBLE, 0.2) AS a, quantile_cont(description_length::DOUBLE, 0.4) AS b,
      quantile_cont(description_length::DOUBLE, 0.6) AS c, quantile_cont(description_length::DOUBLE, 0.8) AS d FROM test)
  SELECT CASE WHEN description_length <= a THEN 'very_short' WHEN description_length <= b THEN 'short'
    WHEN description_length <= c THEN 'medium' WHEN description_length <= d THEN 'long' ELSE 'very_long' END AS bucket,
    {_ERR}, {_MED} FROM test, edges GROUP BY 1"""))
def _(spark, sf):
    return _err(V.error_by_length_quintile(residuals(spark, sf, "description_length"), "description_length"))


_CONTEXT = ["publisher_class_ord", "is_free_to_play", "name", "tag_count", "language_count", "entity_age"]


@query("worst_predictions", pred_sql(" UNION ALL ".join(f"""
  (SELECT entity_id, {', '.join(_CONTEXT)}, round(y_true_raw, 3) AS y_true_raw, round(y_pred_raw, 3) AS y_pred_raw,
          round(residual, 6) AS residual, '{kind}' AS kind FROM test ORDER BY test.residual {way}, entity_id LIMIT 15)"""
    for kind, way in (("over", "DESC"), ("under", "ASC")))))
def _(spark, sf):
    res = residuals(spark, sf, "name", "tag_count", "language_count", "entity_age")
    out = V.worst_predictions(res, "entity_id", _CONTEXT)
    return rounded(out.withColumns({c: F.round(c, 3) for c in ("y_true_raw", "y_pred_raw")}))


@query("prediction_sample", pred_sql("""
  SELECT entity_id, round(y_true_log, 4) AS actual, round(y_pred_log, 4) AS predicted, round(residual, 4) AS residual,
         round(abs_residual, 4) AS abs_error FROM (SELECT * FROM test ORDER BY md5('42:' || entity_id), entity_id LIMIT 20)"""))
def _(spark, sf):
    test = predictions(spark, sf).where(F.col("split") == "test")
    return rounded(V.prediction_sample(test, "entity_id"))
