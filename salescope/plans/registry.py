"""The query registry: a name, a Spark plan, and its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salescope.operators.preprocess import CatalogConfig
from salescope.plans.entity import REF_YEAR, entity_sql

Plan = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Plan] = {}
SQL: dict[str, str] = {}

SEGMENT_WORDS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
LINE_GROUPS = {
    "has_returns": ["R-F", "R-O"],
    "has_open_lines": ["N-O", "A-O", "R-O"],
    "has_billed_lines": ["A-F", "N-F"],
}

ENTITY = CatalogConfig(
    key="entity_id", name="name", target="copies_sold", log_target="log_copies_sold",
    release="first_release", spare_release="release_text", languages="languages",
    owners="estimated_owners", genres="genres", categories="categories", tags="tags",
    positive="positive", negative="negative", price="price",
    platforms=("windows", "mac", "linux"), about="about", required_age="required_age",
    dlc="dlc_count", early_access="early_access", score="score",
    publisher_class="publisher_class", developer="developer", publisher="publisher",
    age="entity_age", score_flag="has_score", ref_year=REF_YEAR, top_tags=5,
    genre_words=SEGMENT_WORDS, category_groups=LINE_GROUPS,
    log_columns=["price", "positive", "negative", "total_reviews", "dlc_count",
                 "achievements", "estimated_owners_midpoint"],
    post_outcome=["positive", "negative", "total_reviews", "review_ratio", "score",
                  "has_score", "estimated_owners_midpoint"],
    binary_prefixes=("genre_", "category_", "has_", "tag_", "is_free", "early_access",
                     "required_age", "windows", "mac", "linux"),
)


def query(name: str, sql: str | None = None) -> Callable[[Plan], Plan]:
    """Register a plan; the session reads times as UTC while it is built."""
    def register(plan: Plan) -> Plan:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return plan(spark, sf_dir)
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return plan
    return register


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    """Round every double; adding 0.0 turns a negative zero into zero."""
    return df.select(*[
        (F.round(f.name, places) + F.lit(0.0)).alias(f.name) if f.dataType.typeName() == "double"
        else F.col(f.name) for f in df.schema.fields
    ])


_GENRE_SQL = ",\n    ".join(
    f"CAST(coalesce(list_contains(string_split(genres, ','), '{g}'), FALSE) AS INTEGER) AS genre_{g.lower()}"
    for g in SEGMENT_WORDS
)
_GROUP_SQL = ",\n    ".join(
    f"CAST(coalesce(list_has_any(string_split(categories, ','), {words!r}), FALSE) AS INTEGER) AS {name}"
    for name, words in LINE_GROUPS.items()
)

_PRE = f""", parsed AS (
  SELECT *, try_strptime(first_release, '%Y-%m-%dT%H:%M:%S.%gZ') AS ts FROM entity
  WHERE copies_sold IS NOT NULL
), flagged AS (
  SELECT *,
    CAST(year(ts) AS INTEGER) AS release_year, CAST(month(ts) AS INTEGER) AS release_month,
    CAST(quarter(ts) AS INTEGER) AS release_quarter,
    CAST(CASE WHEN {REF_YEAR} - year(ts) < 0 THEN 0 ELSE {REF_YEAR} - year(ts) END AS INTEGER) AS entity_age,
    CAST(coalesce(len(regexp_extract_all(languages, $$['"]([^'"]+)['"]$$)), 0) AS INTEGER) AS language_count,
    CASE WHEN estimated_owners <> '0 - 0' THEN
      (CAST(split_part(estimated_owners, ' - ', 1) AS DOUBLE) + CAST(split_part(estimated_owners, ' - ', 2) AS DOUBLE)) / 2 END
      AS estimated_owners_midpoint,
    {_GENRE_SQL},
    {_GROUP_SQL},
    CAST(coalesce(len(list_filter(string_split(tags, ','), lambda t: t <> '')), 0) AS INTEGER) AS tag_count,
    CAST(coalesce(positive, 0) + negative AS BIGINT) AS total_reviews,
    round_even(coalesce(positive, 0)::DOUBLE / (coalesce(positive, 0) + negative + 1), 4) AS review_ratio,
    CAST(coalesce(price = 0, FALSE) AS INTEGER) AS is_free_to_play,
    CAST(coalesce(windows, TRUE) AS INTEGER) AS windows_flag, CAST(coalesce(mac, TRUE) AS INTEGER) AS mac_flag,
    CAST(coalesce(linux, TRUE) AS INTEGER) AS linux_flag,
    CAST(length(coalesce(about, '')) AS INTEGER) AS description_length,
    CAST(required_age > 0 AS INTEGER) AS required_age_flag, CAST(dlc_count > 0 AS INTEGER) AS has_dlc,
    CAST(coalesce(early_access, TRUE) AS INTEGER) AS early_flag,
    CAST(coalesce(score, 0) > 0 AS INTEGER) AS has_score, CAST(coalesce(score, 0) AS DOUBLE) AS score_filled,
    CAST(CASE publisher_class WHEN 'Hobbyist' THEN 0 WHEN 'Indie' THEN 1 WHEN 'AA' THEN 2 WHEN 'AAA' THEN 3 ELSE -1 END
      AS INTEGER) AS publisher_class_ord,
    CAST(count(*) OVER (PARTITION BY coalesce(developer, 'Unknown')) AS INTEGER) AS developer_freq,
    CAST(count(*) OVER (PARTITION BY coalesce(publisher, 'Unknown')) AS INTEGER) AS publisher_freq,
    ln(1 + price) AS log_price, ln(1 + coalesce(positive, 0)::DOUBLE) AS log_positive,
    ln(1 + negative::DOUBLE) AS log_negative,
    ln(1 + (coalesce(positive, 0) + negative)::DOUBLE) AS log_reviews, ln(1 + dlc_count::DOUBLE) AS log_dlc,
    ln(1 + achievements::DOUBLE) AS log_achievements,
    ln(1 + copies_sold::DOUBLE) AS log_copies_sold
  FROM parsed
), pre AS (
  SELECT entity_id, name, copies_sold, release_year, release_month, release_quarter, entity_age, language_count,
    ln(1 + coalesce(estimated_owners_midpoint, 0)) AS estimated_owners_midpoint,
    {', '.join('genre_' + g.lower() for g in SEGMENT_WORDS)}, {', '.join(LINE_GROUPS)}, tag_count, tags,
    log_reviews AS total_reviews, review_ratio, is_free_to_play,
    windows_flag AS windows, mac_flag AS mac, linux_flag AS linux,
    CAST(windows_flag + mac_flag + linux_flag AS INTEGER) AS platform_count, description_length,
    required_age, required_age_flag, has_dlc, early_flag AS early_access, has_score, score_filled AS score,
    publisher_class_ord, developer_freq, publisher_freq, log_price AS price, log_positive AS positive,
    log_negative AS negative, log_dlc AS dlc_count, log_achievements AS achievements, log_copies_sold
  FROM flagged
)
"""


PRE_FEATURES = [
    "release_year", "release_month", "release_quarter", "entity_age", "language_count", "estimated_owners_midpoint",
    *("genre_" + g.lower() for g in SEGMENT_WORDS), *LINE_GROUPS, "tag_count", "total_reviews", "review_ratio",
    "is_free_to_play", "windows", "mac", "linux", "platform_count", "description_length", "required_age",
    "required_age_flag", "has_dlc", "early_access", "has_score", "score", "publisher_class_ord", "developer_freq",
    "publisher_freq", "price", "positive", "negative", "dlc_count", "achievements",
]


def pre_sql(body: str) -> str:
    """SQL over ``pre``, the fully cleaned table (without the chosen-tag flags);
    ``flagged`` holds the same rows before the log scale."""
    return entity_sql(_PRE + body)
