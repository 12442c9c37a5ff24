"""Profiling queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from salescope.functions import parsing as P
from salescope.operators import profile as E
from salescope.operators.preprocess import parse_categories, parse_genres, preprocess
from salescope.plans.entity import ALL_COLUMNS, entity_sql, entity_table
from salescope.plans.registry import ENTITY, LINE_GROUPS, PRE_FEATURES, SEGMENT_WORDS, pre_sql, query, rounded
from salescope.session import materialize

_CLASSES = ["Hobbyist", "Indie", "AA", "AAA"]


def _q(col: str, q: float) -> str:
    return f"round(quantile_cont(CAST({col} AS DOUBLE), {q}), 6)"


@query("null_profile", entity_sql(
    "SELECT * FROM (" + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", round(avg(CASE WHEN {c} IS NULL THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) * 100, 4) AS null_pct FROM entity"
        for c in ALL_COLUMNS) + ") WHERE null_pct > 0"))
def _(spark, sf):
    return E.null_profile(entity_table(spark, sf, ALL_COLUMNS))


_TYPES = {
    "entity_id": "bigint", "price": "double", "copies_sold": "bigint", "positive": "bigint", "negative": "bigint",
    "required_age": "int", "windows": "boolean", "mac": "boolean", "linux": "boolean", "early_access": "boolean",
    "dlc_count": "bigint", "achievements": "bigint", "score": "int",
}
_AUDIT = {c: _TYPES.get(c, "string") for c in ALL_COLUMNS}


@query("column_audit", entity_sql(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", '{t}' AS dtype, round(100.0::DOUBLE * (count(*) - count({c})) / count(*), 2) AS null_pct, "
    f"count({c}) AS non_null, CAST(min({c}) AS VARCHAR) AS sample, count(DISTINCT {c}) AS n_distinct FROM entity"
    for c, t in _AUDIT.items())))
def _(spark, sf):
    return E.column_audit(materialize(entity_table(spark, sf, list(_AUDIT)), "audit"))


_NUMERIC = ["copies_sold", "price", "achievements", "score"]


@query("describe_numeric", entity_sql(" UNION ALL ".join(
    f"SELECT publisher_class, '{c}' AS \"column\", count({c}) AS \"count\", round(avg({c}), 6) AS mean, "
    f"round(stddev_samp({c}), 4) AS std, CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max, "
    f"{_q(c, .25)} AS p25, {_q(c, .5)} AS p50, {_q(c, .75)} AS p75 FROM entity GROUP BY publisher_class"
    for c in _NUMERIC)))
def _(spark, sf):
    df = materialize(entity_table(spark, sf, ["publisher_class", *_NUMERIC]), "describe")
    return rounded(E.describe_numeric(df, _NUMERIC, ["publisher_class"]).withColumn("std", F.round("std", 4)))


_TARGET_QS = [0.5, 0.75, 0.9, 0.95, 0.99, 0.995]


@query("target_quantiles", entity_sql(" UNION ALL ".join(
    f"SELECT {q}::DOUBLE AS quantile, {_q('copies_sold', q)} AS value FROM entity" for q in _TARGET_QS)))
def _(spark, sf):
    df = materialize(entity_table(spark, sf, ["copies_sold"]), "target")
    return rounded(E.target_quantiles(df, "copies_sold", _TARGET_QS))


@query("target_skew", entity_sql(
    "SELECT count(copies_sold) AS n, round(skewness(copies_sold), 6) AS skewness FROM entity"))
def _(spark, sf):
    return rounded(E.target_skew(entity_table(spark, sf, ["copies_sold"]), "copies_sold"))


@query("value_counts", entity_sql(
    "SELECT publisher_class, count(*) AS n FROM entity WHERE publisher_class IS NOT NULL GROUP BY 1"))
def _(spark, sf):
    return E.value_counts(entity_table(spark, sf, ["publisher_class"]), "publisher_class", _CLASSES)


@query("group_median", entity_sql(
    f"SELECT publisher_class, count(copies_sold) AS n, {_q('copies_sold', .25)} AS q1, {_q('copies_sold', .5)} AS median, "
    f"{_q('copies_sold', .75)} AS q3 FROM entity WHERE publisher_class IS NOT NULL GROUP BY 1"))
def _(spark, sf):
    df = materialize(entity_table(spark, sf, ["publisher_class", "copies_sold"]), "class-target")
    return rounded(E.group_median(df, "publisher_class", "copies_sold", _CLASSES))


@query("group_mean_topk", pre_sql(
    "SELECT tag_count, round(avg(log_copies_sold), 6) AS mean FROM pre GROUP BY tag_count ORDER BY tag_count LIMIT 15"))
def _(spark, sf):
    df = entity_table(spark, sf, ["tags", "copies_sold"]).where(F.col("copies_sold").isNotNull()).select(
        F.size(P.tag_list(F.col("tags"))).alias("tag_count"), F.log1p("copies_sold").alias("log_copies_sold"))
    return rounded(E.group_mean_topk(df, "tag_count", "log_copies_sold"))


@query("two_population_summary", entity_sql(
    f"SELECT CAST(price = 0 AS INTEGER) AS holds, count(*) AS n, round(avg(copies_sold), 6) AS mean, "
    f"round(stddev_samp(copies_sold), 4) AS std, {_q('copies_sold', .5)} AS median FROM entity GROUP BY 1"))
def _(spark, sf):
    df = materialize(entity_table(spark, sf, ["price", "copies_sold"]), "price-target")
    out = E.two_population_summary(df, F.col("price") == 0, "copies_sold")
    return rounded(out.withColumn("std", F.round("std", 4)))


@query("explode_counts", entity_sql(
    "SELECT label, count(*) AS n FROM (SELECT unnest(string_split(tags, ',')) AS label FROM entity) "
    "GROUP BY label ORDER BY n DESC, label LIMIT 15"))
def _(spark, sf):
    return E.explode_counts(entity_table(spark, sf, ["tags"]), "tags", 15)


@query("yearly_trend", pre_sql(
    f"SELECT release_year, count(*) AS n, {_q('copies_sold', .5)} AS median FROM flagged "
    "WHERE release_year BETWEEN 1996 AND 2000 GROUP BY 1"))
def _(spark, sf):
    df = entity_table(spark, sf, ["first_release", "copies_sold"]).where(F.col("copies_sold").isNotNull()).select(
        F.year(P.parse_utc(F.col("first_release"))).alias("release_year"), "copies_sold")
    return rounded(E.yearly_trend(materialize(df, "years"), "release_year", "copies_sold", 1996, 2000))


_CORR = ["copies_sold", "price", "positive", "negative", "score", "dlc_count", "achievements", "log_copies"]


@query("corr_matrix", entity_sql(
    ", num AS (SELECT *, ln(1 + copies_sold) AS log_copies FROM entity) " + " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, round(corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)), 6) AS corr FROM num"
        for a in _CORR for b in _CORR)))
def _(spark, sf):
    df = entity_table(spark, sf, _CORR[:-1]).withColumn("log_copies", F.log1p("copies_sold"))
    return rounded(E.corr_matrix(df, _CORR))


#: Every numeric column of the cleaned table but the key and the target.
_CORR_FEATURES = PRE_FEATURES


@query("corr_with_target", pre_sql(
    "SELECT * FROM (" + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, CASE WHEN var_pop({c}) > 0 THEN round(corr(CAST({c} AS DOUBLE), log_copies_sold), 6) END AS corr FROM pre"
        for c in _CORR_FEATURES) + ") ORDER BY abs(round(corr, 9)) DESC NULLS LAST, feature LIMIT 10"))
def _(spark, sf):
    df = preprocess(entity_table(spark, sf, ALL_COLUMNS), ENTITY, post_release=True)
    return rounded(E.corr_with_target(df, _CORR_FEATURES, "log_copies_sold", 10))


@query("histogram", entity_sql("""
  , v AS (SELECT least(price, 40.0::DOUBLE) AS x FROM entity WHERE price > 0),
  b AS (SELECT min(x) AS lo, max(x) AS hi FROM v)
  SELECT CAST(least(floor((x - lo) / (hi - lo) * 60), 59) AS INTEGER) AS bin, count(*) AS n FROM v, b GROUP BY 1"""))
def _(spark, sf):
    paid = entity_table(spark, sf, ["price"]).where(F.col("price") > 0)
    return E.histogram(paid, F.col("price"), 60, clip=40.0)


@query("histogram_log_target", entity_sql("""
  , v AS (SELECT ln(1 + copies_sold) AS x FROM entity WHERE copies_sold IS NOT NULL),
  b AS (SELECT min(x) AS lo, max(x) AS hi FROM v)
  SELECT CAST(least(floor((x - lo) / (hi - lo) * 80), 79) AS INTEGER) AS bin, count(*) AS n FROM v, b GROUP BY 1"""))
def _(spark, sf):
    return E.histogram(entity_table(spark, sf, ["copies_sold"]), F.log1p("copies_sold"), 80)


_FLAGS = ["genre_" + g.lower() for g in SEGMENT_WORDS] + list(LINE_GROUPS)


@query("flag_totals", pre_sql(" UNION ALL ".join(
    f"SELECT '{c}' AS flag, CAST(sum({c}) AS BIGINT) AS total FROM pre" for c in _FLAGS)))
def _(spark, sf):
    df = entity_table(spark, sf, ["genres", "categories", "copies_sold"]).where(F.col("copies_sold").isNotNull())
    return E.flag_totals(parse_categories(parse_genres(df, ENTITY), ENTITY), _FLAGS)


@query("sample_rows", entity_sql("""
  SELECT entity_id, score, copies_sold FROM entity WHERE score IS NOT NULL AND copies_sold IS NOT NULL
  ORDER BY md5('42:' || entity_id), entity_id LIMIT 50"""))
def _(spark, sf):
    df = entity_table(spark, sf, ["entity_id", "score", "copies_sold"])
    return E.sample_rows(df, "entity_id", 50, not_null=["score", "copies_sold"])
