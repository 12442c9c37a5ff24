"""Split, fold, role, imputation, scaling and bundle queries."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from salescope.functions import parsing as P
from salescope.operators import features as B
from salescope.operators import preprocess as S
from salescope.operators.relational import leakage_gate
from salescope.operators.segments import segment_by_price
from salescope.plans.entity import ALL_COLUMNS, entity_table
from salescope.plans.evaluation import SPLIT_SQL
from salescope.plans.registry import ENTITY, LINE_GROUPS, SEGMENT_WORDS, pre_sql, query, rounded
from salescope.session import materialize


def launch_bundle(spark, sf, *, keep=(), use_age=True, use_year=False):
    """The launch-time feature bundle of the entity table."""
    cleaned = S.preprocess(entity_table(spark, sf, ALL_COLUMNS), ENTITY)
    names = leakage_gate(cleaned, ENTITY.metadata, ENTITY.post_outcome, age_column="entity_age",
                         year_column="release_year", use_age=use_age, use_year=use_year)
    return B.assemble_features(cleaned, names, "entity_id", "log_copies_sold", stratum="publisher_class_ord",
                               prefixes=ENTITY.binary_prefixes, keep=keep)


def _classed(spark, sf, *columns):
    df = entity_table(spark, sf, ["entity_id", "publisher_class", "copies_sold", *columns])
    return S.encode_class(df.where(F.col("copies_sold").isNotNull()), ENTITY)


@query("stratified_split", pre_sql(SPLIT_SQL + "SELECT entity_id, publisher_class_ord, split FROM split"))
def _(spark, sf):
    df = materialize(_classed(spark, sf).drop("copies_sold"), "classed")
    return B.stratified_split(df, "entity_id", ["publisher_class_ord"])


_BANDS = """CASE WHEN raw_price < 5 THEN '[0,5)' WHEN raw_price < 20 THEN '[5,20)'
  WHEN raw_price < 60 THEN '[20,60)' WHEN raw_price < 1000 THEN '[60,1000)' END"""


@query("segment_split", pre_sql(f"""
  , banded AS (SELECT entity_id, {_BANDS} AS segment FROM (SELECT entity_id, price AS raw_price FROM flagged)),
  numbered AS (SELECT *, row_number() OVER (PARTITION BY segment ORDER BY md5('42:' || entity_id)) AS rk,
      (count(*) OVER (PARTITION BY segment) * 15 + 50) // 100 AS share FROM banded)
  SELECT entity_id, segment,
    CASE WHEN rk <= share THEN 'test' WHEN rk <= 2 * share THEN 'val' ELSE 'train' END AS split FROM numbered"""))
def _(spark, sf):
    df = entity_table(spark, sf, ["entity_id", "price", "copies_sold"]).where(F.col("copies_sold").isNotNull())
    df = df.select("entity_id", segment_by_price(F.col("price")).alias("segment"))
    return B.segment_split(df, "entity_id", "segment")


@query("kfold_assign", pre_sql("""
  , numbered AS (SELECT entity_id, row_number() OVER (ORDER BY md5('42:' || entity_id)) AS rk, count(*) OVER () AS n FROM pre)
  SELECT entity_id, CAST(CASE WHEN rk <= n // 3 + least(1, n % 3) THEN 0
    WHEN rk <= 2 * (n // 3) + least(2, n % 3) THEN 1 ELSE 2 END AS INTEGER) AS fold FROM numbered"""))
def _(spark, sf):
    df = entity_table(spark, sf, ["entity_id", "copies_sold"]).where(F.col("copies_sold").isNotNull())
    return B.kfold_assign(df.select("entity_id"), "entity_id", 3)


_ROLE_COLUMNS = ["release_year", "tag_count", "has_dlc", "has_returns", "genre_building", "is_free_to_play",
                 "early_access", "required_age", "required_age_flag", "windows", "linux", "platform_count",
                 "publisher_class_ord", "price", "achievements"]


@query("column_roles", pre_sql(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", "
    + ("'ordinal'" if c == "publisher_class_ord" else
       f"CASE WHEN bool_and({c} IN (0, 1)) THEN 'binary' ELSE 'continuous' END"
       if c.startswith(ENTITY.binary_prefixes) else "'continuous'")
    + " AS role FROM pre" for c in _ROLE_COLUMNS).replace(
        "'ordinal' AS role FROM pre", "'ordinal' AS role").replace("'continuous' AS role FROM pre", "'continuous' AS role")))
def _(spark, sf):
    df = S.preprocess(entity_table(spark, sf, ALL_COLUMNS), ENTITY)
    return B.column_roles(df, _ROLE_COLUMNS, ENTITY.binary_prefixes, ["publisher_class_ord"])


_DATES = ["release_year", "release_month", "release_quarter"]


@query("impute_median", pre_sql(SPLIT_SQL + "SELECT entity_id, split, " + ", ".join(
    f"round(coalesce(CAST({c} AS DOUBLE), (SELECT quantile_cont(CAST({c} AS DOUBLE), 0.5) FROM split WHERE split = 'train')), 6) AS {c}"
    for c in _DATES) + " FROM split"))
def _(spark, sf):
    df = _classed(spark, sf, "first_release")
    parts = P.date_parts(F.col("first_release"))
    df = materialize(df.select("entity_id", "publisher_class_ord", *[c.alias(n) for n, c in parts.items()]), "dates")
    split = B.stratified_split(df, "entity_id", ["publisher_class_ord"])
    fills = B.fit_medians(split.where(F.col("split") == "train"), _DATES)
    return rounded(B.impute(split.drop("publisher_class_ord"), fills))


_MODE_SQL = """
  , raw AS (SELECT s.entity_id, s.split, CAST(CAST(e.early_access AS INTEGER) AS DOUBLE) AS early_access,
      CAST(e.score AS DOUBLE) AS score FROM split s JOIN entity e USING (entity_id))
  SELECT entity_id, split, """


@query("impute_mode", pre_sql(SPLIT_SQL + _MODE_SQL + ", ".join(
    f"coalesce({c}, (SELECT {c} FROM raw WHERE split = 'train' AND {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)) AS {c}"
    for c in ("early_access", "score")) + " FROM raw"))
def _(spark, sf):
    df = materialize(_classed(spark, sf, "early_access", "score").select(
        "entity_id", "publisher_class_ord", F.col("early_access").cast("int").alias("early_access"), "score"), "modes")
    split = B.stratified_split(df, "entity_id", ["publisher_class_ord"])
    fills = B.fit_modes(split.where(F.col("split") == "train"), ["early_access", "score"])
    return B.impute(split.drop("publisher_class_ord"), fills)


@query("standardize", pre_sql(SPLIT_SQL + "SELECT entity_id, split, " + ", ".join(
    f"round(({c} - (SELECT avg({c}) FROM split WHERE split = 'train')) / (SELECT stddev_pop({c}) FROM split WHERE split = 'train'), 6) AS {c}"
    for c in ("price", "achievements")) + " FROM split"))
def _(spark, sf):
    df = materialize(_classed(spark, sf, "price", "achievements").select(
        "entity_id", "publisher_class_ord", P.log1p_floor(F.col("price")).alias("price"),
        P.log1p_floor(F.col("achievements")).alias("achievements")), "scaled")
    split = B.stratified_split(df, "entity_id", ["publisher_class_ord"])
    train = split.where(F.col("split") == "train")
    scale = B.fit_scale(train, {c: F.col(c) for c in ("price", "achievements")})
    return rounded(B.standardize(split.drop("publisher_class_ord"), scale))


_CONTINUOUS = ["release_month", "release_quarter", "entity_age", "language_count", "tag_count", "platform_count",
               "description_length", "required_age", "developer_freq", "publisher_freq", "price", "dlc_count",
               "achievements"]
_PASSTHROUGH = ["genre_" + g.lower() for g in SEGMENT_WORDS] + list(LINE_GROUPS) + [
    "is_free_to_play", "windows", "mac", "linux", "required_age_flag", "has_dlc", "early_access",
    "publisher_class_ord"]


def _z(c: str) -> str:
    filled = f"coalesce(CAST({c} AS DOUBLE), (SELECT quantile_cont(CAST({c} AS DOUBLE), 0.5) FROM train))"
    return (f"({filled} - (SELECT avg({filled}) FROM train)) / "
            f"(SELECT coalesce(nullif(stddev_pop({filled}), 0), 1) FROM train)")


@query("assemble_features", pre_sql(SPLIT_SQL + ", train AS (SELECT * FROM split WHERE split = 'train') SELECT entity_id, split, "
    + ", ".join(f"round({_z(c)}, 6) + 0.0::DOUBLE AS {c}" for c in _CONTINUOUS)
    + ", " + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in _PASSTHROUGH) + " FROM split"))
def _(spark, sf):
    bundle = launch_bundle(spark, sf)
    place = {n: i for i, n in enumerate(bundle.names)}
    values = vector_to_array("features")
    return rounded(bundle.data.select("entity_id", "split", *[
        values[place[c]].alias(c) for c in [*_CONTINUOUS, *_PASSTHROUGH]]))
