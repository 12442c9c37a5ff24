"""Column expressions and table helpers shared by the operators of this package."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WHITESPACE = " \t\n\x0b\x0c\r"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(c: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(c, UPPER, UPPER.lower())


def split_words(c: Column, separators: str) -> Column:
    """The words between runs of the regex class ``separators``; null text gives none."""
    return F.array_remove(F.split(F.coalesce(c, F.lit("")), f"{separators}+"), "")


def text_key(*cols: Column) -> list[Column]:
    """Two independent 64-bit hashes, as columns ``k1`` and ``k2``."""
    return [F.xxhash64(*cols).alias("k1"), F.xxhash64(F.lit(1), *cols).alias("k2")]


def numbered(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with columns c0, c1, ... and the new name of each old one, so that no name meets one of an operator."""
    names = [f"c{i}" for i in range(len(docs.columns))]
    return docs.toDF(*names), dict(zip(docs.columns, names))
