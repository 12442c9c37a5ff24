"""Segmentation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from salescope.operators import linear as L
from salescope.operators import preprocess as S
from salescope.operators import segments as G
from salescope.operators.features import segment_split
from salescope.operators.preprocess import preprocess
from salescope.plans.entity import ALL_COLUMNS, entity_sql, entity_table
from salescope.plans.features import launch_bundle
from salescope.plans.registry import ENTITY, PRE_FEATURES, pre_sql, query, rounded
from salescope.session import materialize

_BAND_SQL = """CASE WHEN price < 5 THEN '[0,5)' WHEN price < 20 THEN '[5,20)'
  WHEN price < 60 THEN '[20,60)' WHEN price < 1000 THEN '[60,1000)' END"""
_STATS = """count(*) AS n, round(100.0::DOUBLE * count(*) / (SELECT count(*) FROM banded), 6) AS pct,
  round(avg(copies_sold), 4) AS mean, round(quantile_cont(copies_sold::DOUBLE, 0.5), 4) AS median,
  round(stddev_samp(copies_sold), 3) AS std, CAST(min(copies_sold) AS DOUBLE) AS min, CAST(max(copies_sold) AS DOUBLE) AS max"""


def _stats(df, segment):
    out = G.segment_stats(df, segment, "copies_sold")
    return rounded(out.withColumns({c: F.round(c, 3 if c == "std" else 4) for c in ("mean", "median", "std")}))


@query("segment_by_class", pre_sql("""
  SELECT entity_id, CASE publisher_class_ord WHEN 0 THEN 'Hobbyist' WHEN 1 THEN 'Indie' WHEN 2 THEN 'AA' WHEN 3 THEN 'AAA' END AS segment,
    CASE publisher_class_ord WHEN 0 THEN 'Hobbyist' WHEN 1 THEN 'Indie' WHEN 2 THEN 'AA_AAA' WHEN 3 THEN 'AA_AAA' END AS merged
  FROM pre"""))
def _(spark, sf):
    df = entity_table(spark, sf, ["entity_id", "publisher_class", "copies_sold"]).where(F.col("copies_sold").isNotNull())
    code = F.col("publisher_class_ord")
    return S.encode_class(df, ENTITY).select(
        "entity_id", G.segment_by_class(code).alias("segment"), G.segment_by_class(code, G.MERGED_CLASSES).alias("merged"))


@query("segment_by_price", entity_sql(f"SELECT entity_id, price, {_BAND_SQL} AS segment FROM entity"))
def _(spark, sf):
    return entity_table(spark, sf, ["entity_id", "price"]).withColumn("segment", G.segment_by_price(F.col("price")))


@query("segment_stats", entity_sql(f"""
  , banded AS (SELECT publisher_class AS segment, copies_sold FROM entity)
  SELECT segment, {_STATS} FROM banded WHERE segment IS NOT NULL GROUP BY segment"""))
def _(spark, sf):
    df = S.encode_class(entity_table(spark, sf, ["publisher_class", "copies_sold"]), ENTITY)
    df = df.select("copies_sold", G.segment_by_class(F.col("publisher_class_ord")).alias("segment"))
    return _stats(materialize(df, "segments"), "segment")


@query("segment_stats_price", entity_sql(f"""
  , banded AS (SELECT {_BAND_SQL} AS segment, copies_sold FROM entity)
  SELECT segment, {_STATS} FROM banded WHERE segment IS NOT NULL GROUP BY segment"""))
def _(spark, sf):
    df = entity_table(spark, sf, ["price", "copies_sold"])
    df = df.select("copies_sold", G.segment_by_price(F.col("price")).alias("segment"))
    return _stats(materialize(df, "segments"), "segment")


_PROFILE = ["price", "is_free_to_play", "tag_count", "achievements"]


def _labelled(spark, sf):
    """Entity rows with a fixed label column, the class code."""
    df = entity_table(spark, sf, ["publisher_class", "copies_sold", "price", "tags", "achievements"])
    df = S.parse_tags(df.where(F.col("copies_sold").isNotNull()), ENTITY).withColumn(
        "is_free_to_play", (F.col("price") == 0).cast("int"))
    df = S.encode_class(df, ENTITY).withColumnRenamed("publisher_class_ord", "cluster")
    return materialize(S.log_skewed(df, ENTITY).select("cluster", "copies_sold", *_PROFILE), "labelled")


@query("cluster_profile", pre_sql(f"""
  SELECT publisher_class_ord AS cluster, count(*) AS n, round(100.0::DOUBLE * count(*) / (SELECT count(*) FROM pre), 6) AS pct,
    round(avg(copies_sold), 4) AS mean_target, round(quantile_cont(copies_sold::DOUBLE, 0.5), 4) AS median_target,
    CAST(max(copies_sold) AS DOUBLE) AS max_target, {', '.join(f'round(avg({c}), 6) AS avg_{c}' for c in _PROFILE)}
  FROM pre GROUP BY 1"""))
def _(spark, sf):
    out = G.cluster_profile(_labelled(spark, sf), "cluster", "copies_sold", _PROFILE)
    return rounded(out.withColumns({c: F.round(c, 4) for c in ("mean_target", "median_target")}))


_DESCRIBED = [c for c in PRE_FEATURES if c != "publisher_class_ord"]


@query("cluster_top_features", pre_sql(f"""
  , means AS ({' UNION ALL '.join(f"SELECT publisher_class_ord AS cluster, '{c}' AS feature, abs(avg(CAST({c} AS DOUBLE))) AS s FROM pre GROUP BY 1" for c in _DESCRIBED)}),
  placed AS (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY round(s, 9) DESC, feature) AS p FROM means),
  top AS (SELECT cluster, string_agg(feature, ', ' ORDER BY p) AS top_features FROM placed WHERE p <= 3 GROUP BY cluster)
  SELECT publisher_class_ord AS cluster, count(*) AS n, round(100.0::DOUBLE * count(*) / (SELECT count(*) FROM pre), 6) AS pct,
    round(avg(copies_sold), 4) AS mean_target, round(quantile_cont(copies_sold::DOUBLE, 0.5), 4) AS median_target,
    round(stddev_samp(copies_sold), 3) AS std_target, any_value(top_features) AS top_features
  FROM pre JOIN top ON publisher_class_ord = top.cluster GROUP BY 1"""))
def _(spark, sf):
    df = preprocess(entity_table(spark, sf, ALL_COLUMNS), ENTITY, post_release=True)
    df = df.withColumnRenamed("publisher_class_ord", "cluster").select(
        "cluster", "copies_sold", *[F.col(c).cast("double").alias(c) for c in _DESCRIBED])
    out = G.cluster_top_features(materialize(df, "described"), "cluster", "copies_sold", _DESCRIBED)
    return rounded(out.withColumns({
        "mean_target": F.round("mean_target", 4), "median_target": F.round("median_target", 4),
        "std_target": F.round("std_target", 3)}))


@query("kmeans")
def _(spark, sf):
    bundle = launch_bundle(spark, sf, keep=["copies_sold"])
    _, labelled, inertia = G.fit_kmeans(bundle.part("train"), k=3, n_init=10, key="entity_id")
    out = G.cluster_profile(labelled, "cluster", "copies_sold", ["z_price", "z_achievements"])
    return rounded(out.withColumn("inertia", F.lit(float(inertia))), 4)


@query("kmeans_top_features")
def _(spark, sf):
    """The fitted clusters, each with its strongest scaled features."""
    bundle = launch_bundle(spark, sf, keep=["copies_sold"])
    _, labelled, _ = G.fit_kmeans(bundle.part("train"), k=3, n_init=10, key="entity_id")
    scaled = [c for c in labelled.columns if c.startswith("z_")]
    return rounded(G.cluster_top_features(labelled, "cluster", "copies_sold", scaled), 4)


@query("segment_ols_predictions")
def _(spark, sf):
    """Each row's prediction by the model of its segment."""
    bundle, data = _segment_bundle(spark, sf)
    _, _, predicted = L.segment_ols(data, bundle.names, "class_name")
    return rounded(predicted.select("entity_id", "class_name", "split", "y_true", "y_pred"), 4)


@query("kmeans_elbow")
def _(spark, sf):
    return rounded(G.kmeans_elbow(launch_bundle(spark, sf).part("train"), range(2, 11), n_init=10, key="entity_id"), 4)


@query("pca_2d")
def _(spark, sf):
    scores, ratio = L.pca_projection(launch_bundle(spark, sf), "entity_id")
    return rounded(scores.withColumns({"share1": F.lit(float(ratio[0])), "share2": F.lit(float(ratio[1]))}), 4)


def _segment_bundle(spark, sf):
    """The launch-time bundle, split again inside each merged class."""
    bundle = launch_bundle(spark, sf, keep=["publisher_class_ord"])
    code = F.col("publisher_class_ord")
    data = bundle.data.drop("split").withColumn("class_name", G.segment_by_class(code, G.MERGED_CLASSES))
    return bundle, materialize(segment_split(data.where(F.col("class_name").isNotNull()), "entity_id", "class_name"), "by-segment")


@query("segment_ols")
def _(spark, sf):
    bundle, data = _segment_bundle(spark, sf)
    table, _, _ = L.segment_ols(data, bundle.names, "class_name")
    return rounded(table, 4)


_SEG_METRICS = ", ".join(
    f"round(max(CASE WHEN split = '{split}' THEN {m} END), 6) AS {split}_{name}"
    for split, m, name in (("train", "rmse", "RMSE_log"), ("val", "rmse", "RMSE_log"), ("test", "rmse", "RMSE_log"),
                           ("val", "mae", "MAE_log"), ("val", "r2", "R2_log")))


@query("segment_ols_single", pre_sql(f"""
  , t AS (SELECT entity_id, price AS x, log_copies_sold AS y,
      CASE publisher_class_ord WHEN 0 THEN 'Hobbyist' WHEN 1 THEN 'Indie' ELSE 'AA_AAA' END AS segment
      FROM pre WHERE publisher_class_ord >= 0),
  numbered AS (SELECT *, row_number() OVER (PARTITION BY segment ORDER BY md5('42:' || entity_id)) AS rk,
      (count(*) OVER (PARTITION BY segment) * 15 + 50) // 100 AS share FROM t),
  s AS (SELECT *, CASE WHEN rk <= share THEN 'test' WHEN rk <= 2 * share THEN 'val' ELSE 'train' END AS split FROM numbered),
  f AS (SELECT segment, regr_slope(y, x) AS b, regr_intercept(y, x) AS a FROM s WHERE split = 'train' GROUP BY segment),
  p AS (SELECT s.segment, split, y, a + b * x - y AS d FROM s JOIN f USING (segment)),
  m AS (SELECT segment, split, sqrt(avg(d * d)) AS rmse, avg(abs(d)) AS mae,
      CASE WHEN count(*) < 2 THEN NULL WHEN var_pop(y) = 0 THEN CAST(sum(d * d) = 0 AS DOUBLE)
           ELSE 1 - sum(d * d) / (var_pop(y) * count(*)) END AS r2
      FROM (SELECT * FROM p UNION ALL SELECT 'Combined', split, y, d FROM p) GROUP BY segment, split)
  SELECT segment, {_SEG_METRICS} FROM m GROUP BY segment"""))
def _(spark, sf):
    df = entity_table(spark, sf, ["entity_id", "publisher_class", "copies_sold", "price"]).where(
        F.col("copies_sold").isNotNull())
    df = S.add_log_target(S.log_skewed(S.encode_class(df, ENTITY), ENTITY), ENTITY).select(
        "entity_id", F.col("price").alias("z_price"), F.col("log_copies_sold").alias("label"),
        G.segment_by_class(F.col("publisher_class_ord"), G.MERGED_CLASSES).alias("class_name"))
    known = materialize(df.where(F.col("class_name").isNotNull()), "single")
    data = materialize(segment_split(known, "entity_id", "class_name"), "by-segment")
    table, _, _ = L.segment_ols(data, ["price"], "class_name")
    return rounded(table.drop("val_RMSE_raw", "val_MAE_raw"))


@query("segment_ols_coefficients")
def _(spark, sf):
    bundle, data = _segment_bundle(spark, sf)
    _, coefs, _ = L.segment_ols(data.withColumn("class_code", F.col("publisher_class_ord")),
                                bundle.names, "class_code")
    return rounded(L.side_by_side(coefs, sorted(ENTITY.class_order.values())), 4)
