"""Parsing and feature-derivation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from salescope.functions import parsing as P
from salescope.operators import preprocess as S
from salescope.plans.entity import ALL_COLUMNS, entity_table
from salescope.plans.registry import ENTITY, LINE_GROUPS, SEGMENT_WORDS, pre_sql, query, rounded
from salescope.plans.tables import LAUNCH_COLUMNS, LAUNCH_SELECT


def _sold(spark, sf, *columns):
    """Requested columns of the rows with a known target."""
    return entity_table(spark, sf, ["entity_id", *columns, "copies_sold"]).where(F.col("copies_sold").isNotNull())


@query("date_parts", pre_sql("SELECT entity_id, release_year, release_month, release_quarter FROM flagged"))
def _(spark, sf):
    return _sold(spark, sf, "first_release").select("entity_id", *[
        c.alias(n) for n, c in P.date_parts(F.col("first_release")).items()])


@query("entity_age", pre_sql("SELECT entity_id, entity_age FROM flagged"))
def _(spark, sf):
    year = P.date_parts(F.col("first_release"))["release_year"]
    return _sold(spark, sf, "first_release").select("entity_id", P.entity_age(year, ENTITY.ref_year).alias("entity_age"))


@query("list_string_count", pre_sql("SELECT entity_id, language_count FROM flagged"))
def _(spark, sf):
    return _sold(spark, sf, "languages").select(
        "entity_id", P.list_string_count(F.col("languages")).alias("language_count"))


@query("range_midpoint", pre_sql("SELECT entity_id, estimated_owners_midpoint FROM flagged"))
def _(spark, sf):
    return _sold(spark, sf, "estimated_owners").select(
        "entity_id", P.range_midpoint(F.col("estimated_owners")).alias("estimated_owners_midpoint"))


@query("multilabel_flags", pre_sql(
    "SELECT entity_id, " + ", ".join("genre_" + g.lower() for g in SEGMENT_WORDS) + " FROM flagged"))
def _(spark, sf):
    return S.parse_genres(_sold(spark, sf, "genres"), ENTITY).drop("copies_sold")


@query("keyword_group_flags", pre_sql("SELECT entity_id, " + ", ".join(LINE_GROUPS) + " FROM flagged"))
def _(spark, sf):
    return S.parse_categories(_sold(spark, sf, "categories"), ENTITY).drop("copies_sold")


@query("tag_count", pre_sql("SELECT entity_id, tag_count FROM flagged"))
def _(spark, sf):
    return _sold(spark, sf, "tags").select("entity_id", F.size(P.tag_list(F.col("tags"))).alias("tag_count"))


@query("topn_tag_flags", pre_sql("""
  , top AS (SELECT tag FROM (SELECT unnest(string_split(tags, ',')) AS tag FROM flagged)
            GROUP BY tag ORDER BY count(*) DESC, tag LIMIT 5)
  SELECT entity_id, 'tag_' || lower(tag) AS tag,
         CAST(coalesce(list_contains(string_split(tags, ','), tag), FALSE) AS INTEGER) AS flag
  FROM flagged, top"""))
def _(spark, sf):
    wide = S.parse_tags(_sold(spark, sf, "tags"), ENTITY).drop("copies_sold", "tag_count")
    flags = [c for c in wide.columns if c != "entity_id"]
    return wide.unpivot("entity_id", flags, "tag", "flag")


@query("review_ratio", pre_sql("SELECT entity_id, total_reviews, review_ratio FROM flagged"))
def _(spark, sf):
    return _sold(spark, sf, "positive", "negative").select("entity_id", *[
        c.alias(n) for n, c in P.review_columns(F.col("positive"), F.col("negative")).items()])


@query("threshold_flags", pre_sql(
    "SELECT entity_id, is_free_to_play, required_age_flag, has_dlc, early_flag AS early_access FROM flagged"))
def _(spark, sf):
    return _sold(spark, sf, "price", "required_age", "dlc_count", "early_access").select(
        "entity_id", P.flag(F.col("price") == 0).alias("is_free_to_play"),
        P.positive_flag(F.col("required_age")).alias("required_age_flag"),
        P.positive_flag(F.col("dlc_count")).alias("has_dlc"),
        P.loose_bool(F.col("early_access")).alias("early_access"))


@query("platform_count", pre_sql("SELECT entity_id, windows, mac, linux, platform_count FROM pre"))
def _(spark, sf):
    parts = {c: P.loose_bool(F.col(c)) for c in ENTITY.platforms}
    return _sold(spark, sf, *ENTITY.platforms).select(
        "entity_id", *[c.alias(n) for n, c in parts.items()],
        sum(parts.values(), F.lit(0)).alias("platform_count"))


@query("text_length", pre_sql("SELECT entity_id, description_length FROM flagged"))
def _(spark, sf):
    return _sold(spark, sf, "about").select("entity_id", P.text_length(F.col("about")).alias("description_length"))


@query("sparse_score_flag", pre_sql("SELECT entity_id, has_score, score_filled AS score FROM flagged"))
def _(spark, sf):
    return S.handle_score(_sold(spark, sf, "score"), ENTITY).drop("copies_sold")


@query("ordinal_encode", pre_sql("SELECT entity_id, publisher_class_ord FROM flagged"))
def _(spark, sf):
    return S.encode_class(_sold(spark, sf, "publisher_class"), ENTITY).drop("copies_sold")


@query("frequency_encode", pre_sql("SELECT entity_id, developer_freq, publisher_freq FROM flagged"))
def _(spark, sf):
    return S.encode_studios(_sold(spark, sf, "developer", "publisher"), ENTITY).drop("copies_sold")


@query("log1p_columns", pre_sql("""
  SELECT entity_id, round(log_price, 6) AS price, round(log_positive, 6) AS positive,
         round(log_negative, 6) AS negative, round(log_dlc, 6) AS dlc_count,
         round(log_achievements, 6) AS achievements FROM flagged"""))
def _(spark, sf):
    df = _sold(spark, sf, "price", "positive", "negative", "dlc_count", "achievements").drop("copies_sold")
    return rounded(S.log_skewed(df, ENTITY))


@query("log_target", pre_sql("""
  SELECT entity_id, round(log_copies_sold, 6) AS log_copies_sold,
         round(exp(log_copies_sold) - 1, 2) AS copies_back FROM flagged"""))
def _(spark, sf):
    df = S.add_log_target(_sold(spark, sf), ENTITY)
    return rounded(df.select("entity_id", "log_copies_sold", F.round(F.expm1("log_copies_sold"), 2).alias("copies_back")))


@query("preprocess_pipeline", pre_sql(f"SELECT {LAUNCH_SELECT} FROM pre"))
def _(spark, sf):
    df = S.preprocess(entity_table(spark, sf, ALL_COLUMNS), ENTITY)
    return rounded(df.select(*LAUNCH_COLUMNS))
