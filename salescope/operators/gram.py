"""Pairwise moments of many columns in one pass, whole or per group.

For columns i and j the moments run over the rows where both are present: their
number, the mean of i, the squared deviations of i, and the cross product. Each task
takes them with matrix products over Arrow batches (values and presence masks) and
folds its batches into one state, so a pass costs no expression per pair and emits one
row per task and group. States merge by the usual update of centred sums: nothing is
ever summed far from its mean, and a constant column keeps a deviation of exactly 0.

Null and NaN both mean absent.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

#: A task that meets more groups than this hands out its states and starts anew.
GROUPS_IN_MEMORY = 256
_PARTS = ("n", "mean", "square", "cross")
_STATE = ", ".join(f"{p} array<double>" for p in _PARTS)


@dataclass(frozen=True)
class PairMoments:
    """p x p arrays: rows with i and j, mean of i over them, squares of i about it, cross products."""

    n: np.ndarray
    mean: np.ndarray
    square: np.ndarray
    cross: np.ndarray

    @staticmethod
    def of(x: np.ndarray) -> "PairMoments":
        """Moments of the rows of ``x``, NaN where a value is absent."""
        here = ~np.isnan(x)
        counts = np.maximum(here.sum(axis=0), 1)
        low = np.min(x, axis=0, initial=np.inf, where=here)
        high = np.max(x, axis=0, initial=-np.inf, where=here)
        with np.errstate(invalid="ignore"):
            centre = np.where(low == high, low, np.sum(x, axis=0, where=here) / counts)
            c = np.where(here, x - centre, 0.0)
            if here.all():
                n = np.full((x.shape[1], x.shape[1]), float(len(x)))
                total = np.repeat(c.sum(axis=0)[:, None], x.shape[1], axis=1)
                square = np.repeat((c * c).sum(axis=0)[:, None], x.shape[1], axis=1)
            else:
                m = here.astype(float)
                n, total, square = m.T @ m, c.T @ m, (c * c).T @ m
            off = total / np.maximum(n, 1.0)
            return PairMoments(n, np.where(n > 0, centre[:, None] + off, 0.0), square - n * off * off, c.T @ c - n * off * off.T)

    def merge(self, other: "PairMoments") -> "PairMoments":
        n = self.n + other.n
        safe = np.maximum(n, 1.0)
        d = np.where((self.n > 0) & (other.n > 0), other.mean - self.mean, 0.0)
        start = np.where(self.n > 0, self.mean, other.mean)
        weight = self.n * other.n / safe
        return PairMoments(n, start + d * other.n / safe, self.square + other.square + d * d * weight,
                           self.cross + other.cross + d * d.T * weight)

    def correlation(self) -> np.ndarray:
        """Correlations, NaN where a side is constant over the shared rows."""
        spread = np.sqrt(np.maximum(self.square, 0.0)) * np.sqrt(np.maximum(self.square.T, 0.0))
        with np.errstate(divide="ignore", invalid="ignore"):
            r = np.where(spread > 0, self.cross / spread, np.nan)
        return np.where(np.isnan(r), r, np.clip(r, -1.0, 1.0))

    @property
    def complete(self) -> bool:
        return bool((self.n == self.n.max()).all())


def _columns(batch: pa.RecordBatch, first: int) -> np.ndarray:
    return np.column_stack([c.to_numpy(zero_copy_only=False).astype(np.float64) for c in batch.columns[first:]])


def _emit(kind: pa.DataType, states: Iterable[tuple[object, PairMoments]]) -> Iterator[pa.RecordBatch]:
    for key, s in states:
        yield pa.RecordBatch.from_arrays(
            [pa.array([key], kind), *(pa.array([getattr(s, p).ravel()], pa.list_(pa.float64())) for p in _PARTS)], names=["key", *_PARTS])


def _state(batch: pa.RecordBatch, row: int, width: int) -> PairMoments:
    return PairMoments(*(batch.column(p)[row].values.to_numpy().reshape(width, width) for p in _PARTS))


def _fold(width: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        states: dict[object, PairMoments] = {}
        kind = None
        for batch in batches:
            if not batch.num_rows:
                continue
            kind, x = batch.column(0).type, _columns(batch, 1)
            coded = batch.column(0).dictionary_encode(null_encoding="encode")
            codes, values = coded.indices.to_numpy(), coded.dictionary.to_pylist()
            order = np.argsort(codes, kind="stable")
            cuts = np.concatenate([[0], np.cumsum(np.bincount(codes, minlength=len(values)))])
            for value, lo, hi in zip(values, cuts, cuts[1:]):
                mine = PairMoments.of(x[order[lo:hi]])
                states[value] = states[value].merge(mine) if value in states else mine
            if len(states) > GROUPS_IN_MEMORY:
                yield from _emit(kind, states.items())
                states = {}
        yield from _emit(kind, states.items())

    return run


def _merge_sorted(width: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, kind = None, None, None
        for batch in batches:
            kind, keys = batch.column(0).type, batch.column(0).to_pylist()
            for row, k in enumerate(keys):
                state = _state(batch, row, width)
                if held is not None and k == key:
                    held = held.merge(state)
                else:
                    if held is not None:
                        yield from _emit(kind, [(key, held)])
                    key, held = k, state
        if held is not None:
            yield from _emit(kind, [(key, held)])

    return run


def group_moments(df: DataFrame, columns: Sequence[str], key: str | None = None) -> DataFrame:
    """One row per group: ``key`` and the four flattened p x p arrays of its moments.

    Without ``key`` the whole table is one group, and its states (one per task) merge in
    two steps, the first spread over the cluster. With it, states of one group meet in
    one task, as many as there are tasks in the pass at most; a null key is a group.
    """
    width = len(columns)
    group = F.lit(0) if key is None else F.col(key)
    rows = df.select(group.alias("key"), *[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(columns)])
    schema = f"key {rows.schema['key'].dataType.simpleString()}, {_STATE}"
    states = rows.mapInArrow(_fold(width), schema)
    if key is None:
        spread = states.repartition(max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) // 8))
        states = spread.mapInArrow(_merge_sorted(width), schema).repartition(1)
        return states.mapInArrow(_merge_sorted(width), schema)
    return states.repartition("key").sortWithinPartitions("key").mapInArrow(_merge_sorted(width), schema)


def moments_of(row, width: int) -> PairMoments:
    """The moments held by one row of :func:`group_moments`."""
    return PairMoments(*(np.array(row[p], dtype=float).reshape(width, width) for p in _PARTS))


def whole_moments(df: DataFrame, columns: Sequence[str]) -> PairMoments:
    """The moments of a whole table, 4 p^2 numbers, on the driver."""
    row = group_moments(df, columns).first()
    if row is None:
        return PairMoments(*(np.zeros((len(columns), len(columns))) for _ in _PARTS))
    return moments_of(row, len(columns))


def per_group(states: DataFrame, width: int, solve: Callable[[PairMoments], Iterable[tuple]], fields: str) -> DataFrame:
    """Apply ``solve`` to each group's moments on the executors; it returns rows of ``fields``."""
    kind = states.schema["key"].dataType.simpleString()
    schema = StructType.fromDDL(f"key {kind}, {fields}")
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0).to_pylist()
            rows = [(k, *r) for i, k in enumerate(keys) for r in solve(_state(batch, i, width))]
            columns = zip(*rows) if rows else [()] * len(arrow)
            yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, arrow)], names=arrow.names)

    return states.mapInArrow(run, schema)
