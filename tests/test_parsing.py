"""Literal edge cases of every column expression."""

import math

import pytest
from pyspark.sql import functions as F

from salescope.functions import parsing as P
from salescope.functions import vocab
from salescope.operators.segments import segment_by_price


def values(spark, expr, rows, type_="string"):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"i int, x {type_}")
    return [r.v for r in df.select("i", expr(F.col("x")).alias("v")).orderBy("i").collect()]


def test_date_parts(spark):
    parts = P.date_parts(F.col("x"))
    df = spark.createDataFrame([(0, "2021-12-08T05:00:00.000Z"), (1, "x"), (2, None)], "i int, x string")
    got = df.select("i", *[c.alias(n) for n, c in parts.items()]).orderBy("i").collect()
    assert [tuple(r)[1:] for r in got] == [(2021, 12, 4), (None,) * 3, (None,) * 3]


def test_date_parts_read_as_utc_in_any_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        assert values(spark, lambda c: F.year(P.parse_utc(c)), ["2021-01-01T05:00:00.000Z"]) == [2021]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_entity_age(spark):
    assert values(spark, lambda c: P.entity_age(c, 2026), [2030, 2020, None], "int") == [0, 6, None]


@pytest.mark.parametrize("text,n", [
    ("['English', 'Spanish']", 2), ("[]", 0), (None, 0), ('["it\'s", "b"]', 2), ("['a\\'b', 'c']", 2),
    ("['a', 1, None]", 3), ("['a',]", 1), ("'x' and \"y\"", 2), ("plain", 0), ("['a' 'b", 1),
])
def test_list_string_count(spark, text, n):
    assert values(spark, P.list_string_count, [text]) == [n]


def test_list_string_count_of_a_very_long_list(spark):
    assert values(spark, P.list_string_count, ["[" + ", ".join(["'word'"] * 50_000) + "]"]) == [50_000]


def test_range_midpoint(spark):
    got = values(spark, P.range_midpoint, ["200000 - 500000", "0 - 0", "abc", None, "5", "1 - x"])
    assert got == [350000.0, None, None, None, None, None]


def test_multilabel_flags(spark):
    def has(word):
        return lambda c: P.label_flags(P.split_labels(c), vocab.GENRES, "genre_")["genre_" + word]
    rows = ["Action, Indie", "Indies", None, " Action\t,RPG "]
    assert values(spark, has("action"), rows) == [1, 0, 0, 1]
    assert values(spark, has("indie"), rows) == [1, 0, 0, 0]
    assert values(spark, has("early_access"), ["Early Access"]) == [1]


def test_keyword_group_flags(spark):
    def has(name):
        return lambda c: P.group_flags(P.split_labels(c), vocab.CATEGORY_GROUPS)[name]
    rows = ["Online PvP", "Co-op,VR Only", None]
    assert values(spark, has("has_multiplayer"), rows) == [1, 0, 0]
    assert values(spark, has("has_coop"), rows) == [0, 1, 0]
    assert values(spark, has("has_vr"), rows) == [0, 1, 0]


def test_tag_count(spark):
    assert values(spark, lambda c: F.size(P.tag_list(c)), ["A,,A, ", None, ""]) == [2, 0, 0]


def test_review_columns(spark):
    df = spark.createDataFrame([(3, 1), (None, 2)], "p bigint, n bigint")
    got = df.select(*[c.alias(n) for n, c in P.review_columns(F.col("p"), F.col("n")).items()]).collect()
    assert [tuple(r) for r in got] == [(4, 0.6), (2, 0.0)]


def test_threshold_flags(spark):
    assert values(spark, lambda c: P.flag(c == 0), [0.0, 1.0, None], "double") == [1, 0, 0]
    assert values(spark, P.loose_bool, [True, False, None], "boolean") == [1, 0, 1]


def test_text_length(spark):
    assert values(spark, P.text_length, ["é😀", None]) == [2, 0]


def test_ordinal_code(spark):
    assert values(spark, lambda c: P.ordinal_code(c, vocab.CLASS_ORDER), ["AAA", "Other", None]) == [3, -1, -1]


def test_log1p_floor(spark):
    assert values(spark, P.log1p_floor, [-5.0, None, math.e - 1], "double") == [0.0, 0.0, 1.0]


def test_price_bands(spark):
    got = values(spark, segment_by_price, [0.0, 4.99, 5.0, 60.0, 1000.0], "double")
    assert got == ["[0,5)", "[0,5)", "[5,20)", "[60,1000)", None]


def test_band_is_right_closed(spark):
    got = values(spark, lambda c: P.band(c, vocab.TARGET_EDGES, vocab.TARGET_LABELS), [100.0, 100.5, 2e6, None], "double")
    assert got == ["<=100", "100-1k", ">1M", None]


def test_slug():
    assert P.slug("Shared/Split Screen!") == "shared_split_screen"
