"""Exact order statistics without sorting a whole group in one task.

``percentile`` keeps every distinct value of a group in one task's memory and a
``row_number`` over a group sorts all of it in one task. Both fail when a group
holds a large share of a big table. Here the interval that holds a wanted rank is
narrowed by counting passes over its slices, combined on the map side, and only the
few rows of the last interval are shuffled and ordered. Null and NaN are no values;
infinities are.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from math import ceil, log

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salescope.functions.hashing import hex_bucket, hex_fraction
from salescope.session import materialize

#: A counting pass cuts an interval into so many slices; an interval that holds no more rows is ordered.
SLICES = 1024
_LARGEST = 1.7976931348623157e308


# Keys made by this library and never null: plain equality keeps an existing
# partitioning on them usable, where a null-safe comparison would shuffle again.
_NEVER_NULL = {"__all", "__bucket", "__local", "rep", "variable"}


def null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` where null matches null; keeps the left keys once."""
    renamed = right.select(
        *[F.col(k).alias(f"__r_{k}") for k in keys],
        *[F.col(c) for c in right.columns if c not in keys],
    )
    cond = reduce(lambda a, b: a & b, [
        F.col(k) == F.col(f"__r_{k}") if k in _NEVER_NULL else F.col(k).eqNullSafe(F.col(f"__r_{k}")) for k in keys
    ])
    return left.join(renamed, cond, how).drop(*[f"__r_{k}" for k in keys])


def _values(df: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """``keys, variable, __v``: the present values of several columns as rows."""
    long = df.select(*keys, F.explode(F.array(*[
        F.struct(F.lit(v).alias("variable"), F.col(v).cast("double").alias("__v")) for v in values
    ])).alias("__e")).select(*keys, "__e.variable", "__e.__v")
    return long.where(F.col("__v").isNotNull() & ~F.isnan("__v"))


def _same(keys: Sequence[str]) -> Column:
    """Equality with the columns ``__r_<key>``, null matching null."""
    return reduce(lambda a, b: a & b, [
        F.col(k) == F.col(f"__r_{k}") if k in _NEVER_NULL else F.col(k).eqNullSafe(F.col(f"__r_{k}")) for k in keys
    ])


def _renamed(df: DataFrame, keys: Sequence[str], *rest: str) -> DataFrame:
    return df.select(*[F.col(k).alias(f"__r_{k}") for k in keys], *rest)


def _counted(long: DataFrame, intervals: DataFrame, group: list[str], bins: Mapping[str, Column], *aggs: Column) -> DataFrame:
    """Rows per bin of each interval, with ``__from`` the rank of the bin's first row, and the interval's ranks."""
    held = [f"__r_{k}" for k in group]
    side = _renamed(intervals, group, "__lo", "__hi", "__below")
    inside = long.join(side, _same(group) & F.col("__v").between(F.col("__lo"), F.col("__hi")))
    counts = inside.groupBy(*group, "__lo", "__below", *[c.alias(n) for n, c in bins.items()]).agg(F.count("*").alias("__c"), *aggs)
    before = Window.partitionBy(*group, "__lo").orderBy(*bins).rowsBetween(Window.unboundedPreceding, -1)
    placed = counts.withColumn("__from", F.col("__below") + F.coalesce(F.sum("__c").over(before), F.lit(0)))
    ranks = _renamed(intervals, group, "n", "__ranks", F.col("__lo").alias("__r_lo"))
    joined = placed.join(ranks, _same(group) & (F.col("__lo") == F.col("__r_lo"))).drop(*held, "__r_lo")
    here = F.filter("__ranks", lambda r: (r >= F.col("__from")) & (r < F.col("__from") + F.col("__c")))
    return joined.withColumn("__ranks", here).where(F.size("__ranks") > 0)


def _slice(logs: bool) -> Column:
    """The slice of ``__v`` in its interval, of equal width in the value or in its logarithm.

    Either grows with the value. Widths in the value settle what lies evenly, widths in the
    logarithm settle what spans many orders of magnitude, so taking turns needs few passes.
    """
    def scale(c: Column) -> Column:
        return F.signum(c) * (F.when(c == 0, 0.0).otherwise(F.log(F.abs(c))) + 746.0) if logs else c / 2

    lo, hi = scale(F.greatest("__lo", F.lit(-_LARGEST))), scale(F.least("__hi", F.lit(_LARGEST)))
    piece = F.floor((scale(F.col("__v")) - lo) / F.nullif(hi - lo, F.lit(0.0)) * SLICES)
    finite = F.least(F.greatest(F.coalesce(piece, F.lit(0)), F.lit(0)), F.lit(SLICES - 1))
    return F.when(F.col("__v") > _LARGEST, SLICES).when(F.col("__v") < -_LARGEST, -1).otherwise(finite)


def ranked_values(long: DataFrame, group: list[str], summary: DataFrame) -> DataFrame:
    """``group, n, __rank, __v``: the value at each wanted 0-based rank of each group.

    ``long`` holds ``group`` and ``__v``; ``summary`` has a row per group with its number
    of rows ``n``, least and largest value ``__lo`` and ``__hi``, and the array ``__ranks``.
    Every pass counts the slices of the intervals that hold wanted ranks and keeps the
    slices the ranks lie in, as intervals between their least and largest value. Passes
    end when no interval of differing values holds over ``SLICES`` rows; those left are
    ordered, each by itself.
    """
    kept = [*group, "n", "__lo", "__hi", "__below", "__size", "__ranks"]
    state = materialize(summary.select(
        *group, "n", "__lo", "__hi", F.lit(0).cast("bigint").alias("__below"), F.col("n").alias("__size"), "__ranks"), "intervals")
    wide = (F.col("__size") > SLICES) & (F.col("__lo") < F.col("__hi"))
    logs = False
    while state.where(wide).limit(1).count():
        found = _counted(long, state.where(wide), group, {"__s": _slice(logs)}, F.min("__v").alias("__min"), F.max("__v").alias("__max"))
        narrow = found.select(*group, "n", F.col("__min").alias("__lo"), F.col("__max").alias("__hi"),
                              F.col("__from").alias("__below"), F.col("__c").alias("__size"), "__ranks")
        state = materialize(state.where(~wide).select(*kept).unionByName(narrow), "intervals")
        logs = not logs
    differing = F.col("__lo") < F.col("__hi")
    ordered = _counted(long, state.where(differing), group, {"__x": F.col("__v")}).withColumnRenamed("__x", "__v")
    alike = state.where(~differing).withColumn("__v", F.col("__lo"))
    return ordered.select(*group, "n", "__ranks", "__v").unionByName(alike.select(*group, "n", "__ranks", "__v")).select(
        *group, "n", F.explode("__ranks").alias("__rank"), "__v")


def exact_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    values: Sequence[str],
    quantiles: Mapping[str, float],
) -> DataFrame:
    """Linear-interpolation quantiles of each value column per group.

    Returns ``keys, variable, n`` and one column per entry of ``quantiles``. A group
    without values has no row. Between two equal values nothing is interpolated, so
    infinities stay as they are.
    """
    group = [*keys, "variable"]
    long = _values(df, keys, values)
    place = {name: F.lit(float(q)) * (F.col("n") - 1) for name, q in quantiles.items()}
    low = {name: F.floor(p) for name, p in place.items()}
    high = {name: F.least(r + 1, F.col("n") - 1) for name, r in low.items()}
    summary = long.groupBy(*group).agg(F.count("*").alias("n"), F.min("__v").alias("__lo"), F.max("__v").alias("__hi"))
    found = ranked_values(long, group, summary.withColumn("__ranks", F.array_distinct(F.array(*low.values(), *high.values()))))
    at = found.groupBy(*group, "n").agg(F.map_from_entries(F.collect_list(F.struct("__rank", "__v"))).alias("__at"))
    out = []
    for name, p in place.items():
        a, b = F.element_at("__at", low[name]), F.element_at("__at", high[name])
        out.append(F.when(a == b, a).otherwise(a + (b - a) * (p - low[name])).alias(name))
    return at.select(*group, "n", *out)


def values_at_ranks(df: DataFrame, value: str, ranks: DataFrame) -> DataFrame:
    """``(rank, v)``: the value at each 0-based rank of ``ranks.rank``.

    The distinct ranks travel as one array, so they are a parameter-sized list, such as
    the middle positions of the replicates of a bootstrap.
    """
    long = _values(df, [], [value])
    wanted = ranks.agg(F.collect_set(F.col("rank").cast("bigint")).alias("w")).select("w").scalar()
    summary = long.groupBy("variable").agg(F.count("*").alias("n"), F.min("__v").alias("__lo"), F.max("__v").alias("__hi"))
    found = ranked_values(long, ["variable"], summary.withColumn("__ranks", wanted))
    return found.select(F.col("__rank").alias("rank"), F.col("__v").alias("v"))


def with_quantiles(
    agg: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    wanted: Mapping[str, tuple[str, float]],
) -> DataFrame:
    """Add quantile columns ``name -> (value column, q)`` to a table keyed by ``keys``."""
    values = sorted({v for v, _ in wanted.values()})
    by_q = {f"q{i}": q for i, q in enumerate(sorted({q for _, q in wanted.values()}))}
    names = {q: n for n, q in by_q.items()}
    anchor = list(keys) or ["__all"]
    src = source if keys else source.withColumn("__all", F.lit(0))
    base = agg if keys else agg.withColumn("__all", F.lit(0))
    long = exact_quantiles(src, anchor, values, by_q)
    wide = long.groupBy(*anchor).agg(*[
        F.max(F.when(F.col("variable") == v, F.col(names[q]))).alias(name)
        for name, (v, q) in wanted.items()
    ])
    joined = null_safe(base, wide, anchor, "left")
    return joined if keys else joined.drop("__all")


def hash_cuts(
    df: DataFrame,
    strata: Sequence[str],
    hash_col: str,
    ranks: Mapping[str, Column],
) -> DataFrame:
    """The hash found at given 1-based ranks of each stratum, in hash order.

    ``ranks`` maps an output name to a rank written over the stratum size ``n``.
    Comparing a row's hash with the cut then answers "is this row among the first
    r of its stratum" by a map-side test. The hash is uniform, so the r-th of n lies
    within a few times sqrt(n) places of r / n: one pass counts the hashes below that
    window and orders only those inside. A cut outside its window, which the width makes
    all but impossible, is looked for again in one eight times as wide. A rank of 0 gives
    a null cut. No stratum may be called ``n``.
    """
    anchor = list(strata) or ["__all"]
    src = df if strata else df.withColumn("__all", F.lit(0))
    src = src.select(*anchor, F.col(hash_col).alias("__hash"), hex_fraction(F.col(hash_col)).alias("__u"))
    sizes = src.groupBy(*anchor).agg(F.count("*").alias("n"))
    wanted = materialize(sizes.select(*anchor, "n", F.explode(F.array(*[
        F.struct(F.lit(name).alias("__cut"), r.cast("bigint").alias("__rank")) for name, r in ranks.items()
    ])).alias("__p")).select(*anchor, "n", "__p.*"), "cut-ranks")
    open_, width, found = wanted.where(F.col("__rank").between(1, F.col("n"))), 8.0, []
    while True:
        p = F.col("__rank") / F.col("n")
        reach = width * (F.sqrt(p * (1 - p) / F.col("n")) + 2 / F.col("n"))
        side = _renamed(open_.withColumns({"__from": p - reach, "__to": p + reach}), anchor, "__cut", "__rank", "__from", "__to")
        near = src.join(side, _same(anchor)).where(F.col("__u") <= F.col("__to"))
        inside = F.when(F.col("__u") >= F.col("__from"), F.col("__hash"))
        counts = near.groupBy(*anchor, "__cut", "__rank", inside.alias("__h")).agg(F.count("*").alias("__c"))
        upto = Window.partitionBy(*anchor, "__cut").orderBy(F.col("__h").asc_nulls_first()).rowsBetween(
            Window.unboundedPreceding, Window.currentRow)
        hit = counts.withColumn("__upto", F.sum("__c").over(upto)).where(
            F.col("__h").isNotNull() & (F.col("__upto") >= F.col("__rank")) & (F.col("__upto") - F.col("__c") < F.col("__rank")))
        found.append(materialize(hit.select(*anchor, "__cut", "__h"), "cuts"))
        side = _renamed(found[-1], [*anchor, "__cut"])
        missed = open_.join(side, _same([*anchor, "__cut"]), "left_anti")
        if not missed.limit(1).count():
            break
        open_, width = materialize(missed, "missed"), width * 8
    cuts = reduce(DataFrame.unionByName, found)
    table = null_safe(wanted.select(*anchor).distinct(), cuts, anchor, "left").groupBy(*anchor).agg(*[
        F.max(F.when(F.col("__cut") == name, F.col("__h"))).alias(name) for name in ranks
    ])
    return table if strata else table.drop("__all")


def hash_ranks(df: DataFrame, strata: Sequence[str], hash_col: str, out: str) -> DataFrame:
    """Dense 1-based rank of every row in hash order within its stratum.

    Rows are ordered inside (stratum, hash bucket) and shifted by the number of
    rows in earlier buckets, so a stratum of any size spreads over the cluster. The hex
    digits of a bucket follow from the largest stratum, for about as many buckets as rows
    in each.
    """
    anchor = list(strata) or ["__all"]
    src = df if strata else df.withColumn("__all", F.lit(0))
    largest = src.groupBy(*anchor).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 1
    digits = max(1, ceil(log(largest, 16) / 2))
    src = src.withColumn("__bucket", hex_bucket(F.col(hash_col), digits))
    counts = src.groupBy(*anchor, "__bucket").agg(F.count("*").alias("__c"))
    earlier = Window.partitionBy(*anchor).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        *anchor, "__bucket",
        F.coalesce(F.sum("__c").over(earlier), F.lit(0)).alias("__offset"),
    )
    local = src.withColumn(
        "__local", F.row_number().over(Window.partitionBy(*anchor, "__bucket").orderBy(hash_col))
    )
    ranked = null_safe(local, offsets, [*anchor, "__bucket"]).withColumn(
        out, (F.col("__offset") + F.col("__local")).cast("bigint")
    )
    drop = ["__bucket", "__local", "__offset"] + ([] if strata else ["__all"])
    return ranked.drop(*drop)
