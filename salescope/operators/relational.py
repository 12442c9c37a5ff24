"""Joins, validation, projection and unions over catalogue tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def left_join_enrich(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    right_columns: Sequence[str],
    third: str,
) -> DataFrame:
    """Keep every left row, add the chosen right columns, and put ``third`` third.

    The right side is pruned before the join. No broadcast is forced: Catalyst
    broadcasts a side only under its size threshold, and otherwise the adaptive
    skew join splits a hot key.
    """
    slim = right.select(F.col(right_key).alias("__rk"), *right_columns)
    joined = left.join(slim, left[left_key] == slim["__rk"], "left").drop("__rk")
    rest = [c for c in joined.columns if c != third]
    return joined.select(*rest[:2], third, *rest[2:])


def join_match_audit(left: DataFrame, right: DataFrame, left_key: str, right_key: str, probe: str) -> DataFrame:
    """Left rows, right rows, joined rows, and joined rows with and without ``probe``."""
    slim = right.select(F.col(right_key).alias("__rk"), F.col(probe).alias("__probe"))
    joined = left.select(left_key).join(slim, F.col(left_key) == F.col("__rk"), "left")
    sizes = left.agg(F.count("*").alias("left_rows")), right.agg(F.count("*").alias("right_rows"))
    return joined.agg(
        F.count("*").alias("merged_rows"),
        F.count("__probe").alias("matched_rows"),
        F.count_if(F.col("__probe").isNull()).alias("unmatched_rows"),
    ).select(sizes[0].scalar().alias("left_rows"), sizes[1].scalar().alias("right_rows"), "*")


def validate_required(
    df: DataFrame, required: Sequence[str], key: str, target: str, max_null_targets: int = 50
) -> DataFrame:
    """One report row of null targets and repeated keys; a missing column raises."""
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    per_key = df.groupBy(key).agg(
        F.count("*").alias("c"), F.count_if(F.col(target).isNull()).alias("nulls")
    )
    return per_key.agg(
        F.sum("c").alias("n_rows"),
        F.sum("nulls").alias("null_targets"),
        F.sum(F.col("c") - 1).alias("duplicate_keys"),
    ).withColumn("null_warning", (F.col("null_targets") > max_null_targets).cast("int"))


def drop_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.drop(*[c for c in names if c in df.columns])


def filter_null_target(df: DataFrame, target: str) -> DataFrame:
    return df.where(F.col(target).isNotNull())


def leakage_gate(
    df: DataFrame,
    metadata: Sequence[str],
    post_outcome: Sequence[str],
    *,
    post_release: bool = False,
    age_column: str | None = None,
    year_column: str | None = None,
    use_age: bool = True,
    use_year: bool = True,
) -> list[str]:
    """Feature names allowed by the framing; outcome-time columns are cut for launch-time."""
    cut = set(metadata)
    if not post_release:
        cut |= set(post_outcome)
    if not use_age:
        cut.add(age_column)
    if not use_year:
        cut.add(year_column)
    return [c for c in df.columns if c not in cut]


def union_summaries(tables: Mapping[str, DataFrame], order_by: str, tag: str | None = None) -> DataFrame:
    """Stack result tables by name, best first; ``tag`` adds the table's name."""
    parts = [t.withColumn(tag, F.lit(n)) if tag else t for n, t in tables.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts).orderBy(order_by)
