"""Sinks: processed tables, one output per segment, reports, fitted models."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame


def sink_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def sink_by_segment(df: DataFrame, path: str, segment: str, mode: str = "overwrite") -> None:
    """One directory per segment. Rebalancing splits a hot segment over several
    writers and merges small ones, so file sizes stay even."""
    df.hint("rebalance", segment).write.mode(mode).partitionBy(segment).parquet(path)


def sink_report(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Result tables as header CSV; free text survives quotes, newlines and spaces."""
    df.write.mode(mode).csv(
        path, header=True, quote='"', escape='"', escapeQuotes=True,
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    )


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
