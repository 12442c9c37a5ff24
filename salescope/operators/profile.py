"""Profiling and exploratory aggregates. Wide statistics come from one scan."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from salescope.functions.hashing import md5_of
from salescope.functions.parsing import binary_round, split_labels
from salescope.operators.gram import PairMoments, group_moments, per_group
from salescope.operators.order_stats import null_safe, with_quantiles


def melt_row(df: DataFrame, records: Sequence[Mapping[str, Column]]) -> DataFrame:
    """Turn a one-row aggregate into one row per record."""
    return df.select(F.explode(F.array(*[
        F.struct(*[c.alias(n) for n, c in r.items()]) for r in records
    ])).alias("r")).select("r.*")


def null_profile(df: DataFrame, above: float = 0.0) -> DataFrame:
    """Percent null per column, largest first."""
    one = df.agg(*[F.avg(F.isnull(c).cast("int")).alias(f"c{i}") for i, c in enumerate(df.columns)])
    return (
        melt_row(one, [{"column": F.lit(c), "null_pct": binary_round(F.col(f"c{i}") * 100, 4)}
                       for i, c in enumerate(df.columns)])
        .where(F.col("null_pct") > above)
        .orderBy(F.desc("null_pct"), "column")
    )


def column_audit(df: DataFrame, approximate: bool = False) -> DataFrame:
    """Type, null share, distinct count and smallest value of every column.

    Exact distinct counts are taken over (column, value) pairs: equal pairs merge
    on the map side and the shuffle is spread by value, in place of the row
    expansion that many ``count(DISTINCT)`` aggregates cause.
    """
    names = df.columns
    one = df.agg(
        F.count("*").alias("rows"),
        *[F.count(c).alias(f"n{i}") for i, c in enumerate(names)],
        *[F.min(c).cast("string").alias(f"m{i}") for i, c in enumerate(names)],
        *([F.approx_count_distinct(c).alias(f"d{i}") for i, c in enumerate(names)] if approximate else []),
    )
    types = dict(df.dtypes)
    base = melt_row(one, [{
        "column": F.lit(c),
        "dtype": F.lit(types[c]),
        "null_pct": binary_round((F.col("rows") - F.col(f"n{i}")) / F.col("rows") * 100, 2),
        "non_null": F.col(f"n{i}"),
        "sample": F.col(f"m{i}"),
        **({"n_distinct": F.col(f"d{i}")} if approximate else {}),
    } for i, c in enumerate(names)])
    if not approximate:
        pairs = df.select(F.explode(F.array(*[
            F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("v")) for c in names
        ])).alias("p")).select("p.*")
        distinct = pairs.groupBy("column", "v").agg(F.lit(1)).groupBy("column").agg(
            F.count("v").alias("n_distinct")
        )
        base = null_safe(base, distinct, ["column"], "left")
    return base.orderBy(F.desc("null_pct"), "column")


def describe_numeric(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """count, mean, std, min, exact quartiles, max per column (and per group)."""
    long = df.select(*keys, F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns
    ])).alias("e")).select(*keys, "e.column", "e.value")
    by = [*keys, "column"]
    stats = long.groupBy(*by).agg(
        F.count("value").alias("count"), F.avg("value").alias("mean"), F.stddev("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"),
    )
    return with_quantiles(stats, long, by, {
        "p25": ("value", 0.25), "p50": ("value", 0.5), "p75": ("value", 0.75),
    })


def target_quantiles(df: DataFrame, target: str, qs: Sequence[float]) -> DataFrame:
    names = {f"q{i}": (target, q) for i, q in enumerate(qs)}
    wide = with_quantiles(df.agg(F.count(target).alias("n")), df, [], names)
    return melt_row(wide, [{"quantile": F.lit(float(q)), "value": F.col(f"q{i}")} for i, q in enumerate(qs)])


def target_skew(df: DataFrame, target: str) -> DataFrame:
    """Bias-corrected sample skewness."""
    n = F.col("n").cast("double")
    return df.agg(F.count(target).alias("n"), F.skewness(target).alias("g1")).select(
        "n", F.when(n > 2, F.col("g1") * F.sqrt(n * (n - 1)) / (n - 2)).alias("skewness")
    )


def value_counts(df: DataFrame, column: str, order: Sequence[str] | None = None) -> DataFrame:
    """Frequency of each non-null value, most frequent first or in a fixed order."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    if order is None:
        return counts.orderBy(F.desc("n"), column)
    return counts.orderBy(position(F.col(column), order), column)


def position(c: Column, order: Sequence[str]) -> Column:
    return F.coalesce(F.nullif(F.array_position(F.array(*[F.lit(o) for o in order]), c), F.lit(0)),
                      F.lit(len(order) + 1))


def group_median(df: DataFrame, key: str, target: str, order: Sequence[str]) -> DataFrame:
    """Median and box-plot quartiles of the target per category, in the given order."""
    known = df.where(F.col(key).isin(list(order)))
    base = known.groupBy(key).agg(F.count(target).alias("n"))
    return with_quantiles(base, known, [key], {
        "q1": (target, 0.25), "median": (target, 0.5), "q3": (target, 0.75),
    }).orderBy(position(F.col(key), order))


def group_mean_topk(df: DataFrame, key: str, target: str, k: int = 15) -> DataFrame:
    """Mean target of the first ``k`` keys in key order."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.avg(target).alias("mean")).orderBy(key).limit(k)


def two_population_summary(df: DataFrame, condition: Column, target: str) -> DataFrame:
    """Size, median, mean, std of the target where a condition holds and where not."""
    src = df.withColumn("holds", F.coalesce(condition, F.lit(False)).cast("int"))
    base = src.groupBy("holds").agg(
        F.count("*").alias("n"), F.avg(target).alias("mean"), F.stddev(target).alias("std")
    )
    return with_quantiles(base, src, ["holds"], {"median": (target, 0.5)})


def explode_counts(df: DataFrame, column: str, k: int = 15) -> DataFrame:
    """Most frequent labels of a comma-separated column."""
    labels = df.where(F.col(column).isNotNull()).select(F.explode(split_labels(F.col(column))).alias("label"))
    return labels.groupBy("label").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "label").limit(k)


def yearly_trend(df: DataFrame, year: str, target: str, first: int, last: int) -> DataFrame:
    src = df.where(F.col(year).between(first, last))
    base = src.groupBy(year).agg(F.count("*").alias("n"))
    return with_quantiles(base, src, [year], {"median": (target, 0.5)}).orderBy(year)


def corr_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair, with nulls dropped pair by pair, in one scan.

    Both triangles are returned; the diagonal is 1 where a column varies, and a pair
    with a side that is constant over the shared rows is null. NaN counts as null. An empty table
    has no pairs.
    """
    names = list(columns)

    def rows(m: PairMoments):
        r = m.correlation()
        for i, a in enumerate(names):
            for j, b in enumerate(names):
                value = float(r[i, j])
                yield a, b, None if value != value else 1.0 if i == j else value

    states = group_moments(df, names)
    return per_group(states, len(names), rows, "a string, b string, corr double").drop("key")


def corr_with_target(df: DataFrame, columns: Sequence[str], target: str, k: int) -> DataFrame:
    """Features by absolute correlation with the target; constant ones come last."""
    names = list(columns)

    def rows(m: PairMoments):
        for name, value in zip(names, m.correlation()[:-1, -1].tolist()):
            yield name, None if value != value else value

    states = group_moments(df, [*names, target])
    return (
        per_group(states, len(names) + 1, rows, "feature string, corr double").drop("key")
        .orderBy(F.expr("abs(round(corr, 9))").desc_nulls_last(), "feature").limit(k)
    )


def histogram(df: DataFrame, value: Column, bins: int, clip: float | None = None) -> DataFrame:
    """Equal-width bin counts between the smallest and largest value; last bin closed."""
    x = F.least(value, F.lit(clip)) if clip is not None else value
    src = df.select(x.cast("double").alias("x")).where(F.col("x").isNotNull())
    edges = src.agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    lo, hi = edges.select("lo").scalar(), edges.select("hi").scalar()
    bucket = F.least(F.floor((F.col("x") - lo) / F.nullif(hi - lo, F.lit(0.0)) * bins), F.lit(bins - 1))
    return (
        src.select(F.coalesce(bucket, F.lit(0)).cast("int").alias("bin"))
        .groupBy("bin").agg(F.count("*").alias("n")).orderBy("bin")
    )


def flag_totals(df: DataFrame, flags: Sequence[str]) -> DataFrame:
    one = df.agg(*[F.sum(F.col(c).cast("bigint")).alias(f"s{i}") for i, c in enumerate(flags)])
    return melt_row(one, [{"flag": F.lit(c), "total": F.col(f"s{i}")} for i, c in enumerate(flags)]).orderBy(
        F.desc("total"), "flag"
    )


def sample_rows(df: DataFrame, key: str, n: int, seed: int = 42, not_null: Sequence[str] = ()) -> DataFrame:
    """A seeded sample of ``n`` rows that every engine reproduces."""
    keep = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in not_null], F.lit(True))
    return df.where(keep).orderBy(md5_of(seed, F.col(key)), key).limit(n)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]
