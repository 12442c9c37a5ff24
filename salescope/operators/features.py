"""Splits, column roles, imputation, scaling and the assembled feature bundle.

Every statistic is fitted on the training rows only. Fitted statistics are a few
numbers per column, so they travel as literals and applying them needs no join.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salescope.functions.hashing import md5_of
from salescope.operators.order_stats import exact_quantiles, hash_cuts, null_safe
from salescope.session import materialize


def assign_by_cuts(df: DataFrame, cuts: DataFrame, strata: Sequence[str], names: Sequence[str],
                   values: Sequence, out: str) -> DataFrame:
    """Name each row by the first cut its ``__h`` does not pass; the last value is the rest."""
    if strata:
        joined = null_safe(df, cuts, strata, "left")
        cut = {n: F.col(n) for n in names}
    else:
        joined = df
        packed = cuts.select(F.struct(*names).alias("s")).scalar()
        cut = {n: packed.getField(n) for n in names}
    expr = F.lit(values[-1])
    for name, value in reversed(list(zip(names, values))):
        expr = F.when(F.col("__h") <= cut[name], value).otherwise(expr)
    return joined.withColumn(out, expr).drop("__h", *names)


def _share(percent: int) -> Column:
    """Rounded share of a stratum of ``n`` rows, in whole-number arithmetic."""
    return F.expr(f"(n * {percent} + 50) div 100")


def stratified_split(
    df: DataFrame, key: str, strata: Sequence[str], test: int = 15, val: int = 15, seed: int = 42
) -> DataFrame:
    """Add ``split``: exact test and validation shares inside every stratum.

    Two small passes find the hash cuts; the labelling itself is a map-side test, so
    the table is not shuffled and a stratum of any size is no bottleneck. ``key``
    must be unique.
    """
    hashed = df.withColumn("__h", md5_of(seed, F.col(key)))
    cuts = hash_cuts(hashed, strata, "__h", {"cut_test": _share(test), "cut_val": _share(test) + _share(val)})
    return assign_by_cuts(hashed, cuts, strata, ["cut_test", "cut_val"], ["test", "val", "train"], "split")


def segment_split(df: DataFrame, key: str, segment: str, seed: int = 42) -> DataFrame:
    """70/15/15 inside each segment."""
    return stratified_split(df, key, [segment], seed=seed)


def kfold_assign(df: DataFrame, key: str, k: int = 3, seed: int = 42) -> DataFrame:
    """Add ``fold`` in 0..k-1: shuffled folds whose sizes differ by at most one."""
    hashed = df.withColumn("__h", md5_of(seed, F.col(key)))
    ranks = {f"cut{i}": F.expr(f"{i} * (n div {k}) + least({i}, n % {k})") for i in range(1, k)}
    cuts = hash_cuts(hashed, [], "__h", ranks)
    return assign_by_cuts(hashed, cuts, [], list(ranks), list(range(k)), "fold")


def column_roles(
    df: DataFrame, columns: Sequence[str], prefixes: tuple[str, ...], ordinal: Iterable[str] = ()
) -> DataFrame:
    """``(column, role)``: binary, ordinal or continuous, from one aggregate."""
    ordinal = set(ordinal)
    tested = [c for c in columns if c not in ordinal and c.startswith(prefixes)]
    one = df.agg(F.count("*"), *[
        F.coalesce(F.min(F.col(c).cast("double").isin(0.0, 1.0).cast("int")), F.lit(1)).alias(f"is_{c}")
        for c in tested
    ])
    roles = {c: F.when(F.col(f"is_{c}") == 1, "binary").otherwise("continuous") for c in tested}
    return one.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"),
                 roles.get(c, F.lit("ordinal" if c in ordinal else "continuous")).alias("role"))
        for c in columns
    ])).alias("r")).select("r.*")


def fit_medians(train: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    anchored = train.withColumn("__all", F.lit(0))
    rows = exact_quantiles(anchored, ["__all"], columns, {"median": 0.5}).collect()
    return {r["variable"]: r["median"] for r in rows}


def fit_modes(train: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    """Most frequent value per column, smallest first on ties."""
    long = train.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v")) for c in columns
    ])).alias("e")).select("e.*").where(F.col("v").isNotNull())
    counts = long.groupBy("column", "v").agg(F.count("*").alias("n"))
    best = counts.groupBy("column").agg(F.max_by("v", F.struct(F.col("n"), -F.col("v"))).alias("mode"))
    return {r["column"]: r["mode"] for r in best.collect()}


def fit_scale(train: DataFrame, columns: Mapping[str, Column]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation per column; a constant column keeps scale 1."""
    row = train.agg(
        *[F.avg(c).alias(f"m{i}") for i, c in enumerate(columns.values())],
        *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(columns.values())],
    ).first()
    return {n: (row[f"m{i}"], row[f"s{i}"] or 1.0) for i, n in enumerate(columns)}


def impute(df: DataFrame, fills: Mapping[str, float]) -> DataFrame:
    return df.withColumns({
        c: F.coalesce(F.col(c).cast("double"), F.lit(float(v))) for c, v in fills.items()
    })


def standardize(df: DataFrame, scale: Mapping[str, tuple[float, float]]) -> DataFrame:
    return df.withColumns({c: (F.col(c) - m) / s for c, (m, s) in scale.items()})


@dataclass(frozen=True)
class FeatureBundle:
    """One table with ``split``, ``label`` and ``features``, and how it was made."""

    data: DataFrame
    names: list[str]
    pipeline: PipelineModel

    def part(self, split: str) -> DataFrame:
        return self.data.where(F.col("split") == split)

    def select(self, names: Sequence[str]) -> "FeatureBundle":
        """The same bundle over a subset of the features."""
        unknown = [n for n in names if n not in self.names]
        if unknown:
            raise KeyError(f"features not in the bundle: {unknown}")
        assembler = VectorAssembler(inputCols=[f"z_{n}" for n in names], outputCol="features")
        data = assembler.transform(self.data.drop("features"))
        stages = [self.pipeline.stages[0], assembler]
        return replace(self, data=data, names=list(names), pipeline=PipelineModel(stages))


def feature_pipeline(train: DataFrame, names: Sequence[str], prefixes: tuple[str, ...],
                     ordinal: Sequence[str]) -> tuple[PipelineModel, list[str]]:
    """Median and z-score for continuous columns, mode for binary and ordinal ones.

    The fitted statistics sit in one SQL projection, so the result is an ordinary
    saveable pipeline that applies in a single codegen stage.
    """
    roles = {r["column"]: r["role"] for r in column_roles(train, names, prefixes, ordinal).collect()}
    continuous = [n for n in names if roles[n] == "continuous"]
    passthrough = [n for r in ("binary", "ordinal") for n in names if roles[n] == r]
    medians = fit_medians(train, continuous) if continuous else {}
    modes = fit_modes(train, passthrough) if passthrough else {}
    continuous = [n for n in continuous if n in medians]
    passthrough = [n for n in passthrough if n in modes]
    scale = fit_scale(train, {
        n: F.coalesce(F.col(n).cast("double"), F.lit(medians[n])) for n in continuous
    }) if continuous else {}

    def lit(x: float) -> str:
        return f"{float(x)!r}D"

    parts = [
        f"(coalesce(cast(`{n}` as double), {lit(medians[n])}) - {lit(scale[n][0])}) / {lit(scale[n][1])} AS `z_{n}`"
        for n in continuous
    ] + [f"coalesce(cast(`{n}` as double), {lit(modes[n])}) AS `z_{n}`" for n in passthrough]
    ordered = continuous + passthrough
    sql = SQLTransformer(statement=f"SELECT *, {', '.join(parts)} FROM __THIS__")
    assembler = VectorAssembler(inputCols=[f"z_{n}" for n in ordered], outputCol="features")
    return PipelineModel([sql, assembler]), ordered


def assemble_features(
    df: DataFrame, names: Sequence[str], key: str, label: str, *, stratum: str | None,
    prefixes: tuple[str, ...], keep: Sequence[str] = (), seed: int = 42,
) -> FeatureBundle:
    """Split, fit the feature pipeline on the training rows, transform all rows.

    The rows with their split are written once, because every fit reads them several
    times; scaling them and assembling the vector is a projection of that table.
    """
    needed = list(dict.fromkeys([key, label, *keep, *names]))
    split = materialize(
        stratified_split(df.select(*needed), key, [stratum] if stratum else [], seed=seed), "split"
    )
    ordinal = [stratum] if stratum in names else []
    pipeline, ordered = feature_pipeline(split.where(F.col("split") == "train"), names, prefixes, ordinal)
    out = pipeline.transform(split).withColumn("label", F.col(label).cast("double"))
    kept = list(dict.fromkeys([key, "split", "label", *keep, *[f"z_{n}" for n in ordered], "features"]))
    return FeatureBundle(out.select(*kept), ordered, pipeline)
