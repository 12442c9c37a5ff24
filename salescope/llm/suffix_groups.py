"""Removal of passages that occur more than once, by prefix-partitioned suffix trees.

A window is ``window`` consecutive words. Suffixes worth a tree are found first: every
window picks the ``prefix``-word gram with the smallest hash inside it, so two equal
windows pick the same gram at the same place, and a window whose gram occurs once in
the corpus can't repeat. Grams are counted with a map-side combine; the suffixes that
start at shared grams are what remains.

They are split by prefix. The suffixes of a gram with up to ``group_rows`` occurrences
form a group that fits in memory; a task sorts its groups' suffixes, the longest common
prefixes of neighbours are the inner nodes of the tree, and a second tree over the words
before the gram, read backwards, extends its nodes to the left. A window is repeated
when its row shares the node of depth ``window - o`` in the first and of depth ``o`` in
the second tree with another row, ``o`` being the gram's place in the window. A gram with
more occurrences is too short a prefix: its suffixes are told apart by the longest prefix
that matters, the whole window, at whose nodes all suffixes are alike and are counted with
a map-side combine. No group holds more than ``group_rows`` rows and no text is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salescope.llm.word_arrays import gram_hashes, places, slices, split_words, word_ids
from salescope.session import materialize

#: Rows of whole groups that a task turns into trees at once.
TREE_ROWS = 20_000
_OFF = 1 << 8
_RUN = 1 << 8


def _anchors(ids: np.ndarray, offsets: np.ndarray, window: int, prefix: int):
    """Runs of windows with one smallest gram: (text, first window, gram's offset, run, hash)."""
    width = window - prefix + 1
    n = len(ids) - window + 1
    if n <= 0:
        return (np.empty(0, np.int64),) * 4 + (np.empty(0, np.uint64),)
    g = gram_hashes(ids, prefix)
    at, reach = np.arange(len(g)), 1
    while reach < width:  # leftmost smallest gram of runs of growing width
        step = min(reach, width - reach)
        left, right = at[:-step], at[step:]
        at = np.where(g[left] <= g[right], left, right)
        reach += step
    owner, place = places(offsets)
    sizes = np.diff(offsets)
    valid = place[:n] + window <= sizes[owner[:n]]
    new = valid & (np.diff(at[:n], prepend=-1) != 0)
    new[1:] |= valid[1:] & ~valid[:-1]
    new[1:] |= valid[1:] & (owner[1:n] != owner[: n - 1])
    first = np.flatnonzero(new)
    run = np.bincount(np.cumsum(new)[valid] - 1, minlength=len(first))
    return owner[first], place[first], at[first] - first, run, g[at[first]]


def _find(window: int, prefix: int):
    schema = pa.schema([("h", pa.int64()), ("doc_id", pa.int64()), ("th", pa.int64()), ("pos", pa.int64())])

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                offsets, words = split_words(batch.column("text"))
                text, first, off, run, h = _anchors(word_ids(words), offsets, window, prefix)
                rows = pa.array(text)
                pos = (first * _OFF + off) * _RUN + run
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h.view(np.int64)), batch.column("doc_id").take(rows), batch.column("th").take(rows), pa.array(pos.astype(np.int64))], schema=schema)

    return find


def _texts(offsets: np.ndarray, words: pa.Array) -> pa.Array:
    """Each text's words, joined by one space without a Python object per word."""
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), words), pa.scalar(" ", words.type)).cast(pa.string())


def _split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The number of words of each text; rows without shared grams keep all of them."""
    for whole in batches:
        for batch in slices(whole, "text"):
            offsets, words = split_words(batch.column("text"))
            done = batch.column("anchors").is_null()
            text = pc.if_else(done, _texts(offsets, words), batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("th"), pa.array(np.diff(offsets)), text, batch.column("anchors")],
                names=["doc_id", "th", "n_words", "text", "anchors"])


def _contexts(window: int, group_rows: int, hot: bool):
    """Suffix rows of small grams with their words, or window hashes of the others."""

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "text"):
                offsets, words = split_words(batch.column("text"))
                ids = word_ids(words)
                lists = batch.column("anchors")
                bounds = lists.offsets.to_numpy()
                flat = lists.values.slice(bounds[0], bounds[-1] - bounds[0])
                h, n, pos = (flat.field(i).to_numpy(zero_copy_only=False) for i in range(3))
                row = np.repeat(np.arange(batch.num_rows), np.diff(bounds))
                pick = np.flatnonzero((n > group_rows) == hot)
                row, h, pos = row[pick], h[pick], pos[pick]
                first, off, run = pos // (_OFF * _RUN), pos // _RUN % _OFF, pos % _RUN
                start = offsets[row] + first
                if hot:
                    a, b = gram_hashes(ids, window), gram_hashes(ids ^ np.uint64(0x5BD1E995), window)
                    each = np.repeat(np.arange(len(row)), run)
                    s = np.arange(len(each)) - np.repeat(np.cumsum(run) - run, run)
                    at = start[each] + s
                    cols = [pa.array(a[at].view(np.int64)), pa.array(b[at].view(np.int64))]
                    rows, names = pa.array(row[each]), ["w1", "w2"]
                    tail, more = [pa.array(first[each] + s)], ["s"]
                else:
                    raw, data = ids.view(np.uint8), []
                    for i, m in zip(start.tolist(), (run + window - 1).tolist()):
                        data.append(raw[i * 8 : (i + m) * 8].tobytes())
                    cols, rows, names = [pa.array(h)], pa.array(row), ["h"]
                    tail, more = [pa.array(pos), pa.array(data, pa.binary())], ["pos", "words"]
                yield pa.RecordBatch.from_arrays(
                    [*cols, batch.column("doc_id").take(rows), batch.column("th").take(rows), *tail], names=[*names, "doc_id", "th", *more])

    return contexts


def _common(order: np.ndarray, keys: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Longest common prefix, in columns, of each row in ``order`` with the one before; 0 across groups."""
    same = rows[order[1:]] == rows[order[:-1]]
    lcp = np.argmin(np.concatenate([same, np.zeros((len(same), 1), bool)], axis=1), axis=1)
    return np.concatenate([[0], np.where(keys[order[1:]] == keys[order[:-1]], lcp, 0)])


def repeated_windows(h: np.ndarray, off: np.ndarray, run: np.ndarray, words: list[np.ndarray], window: int) -> np.ndarray:
    """Matrix [row, o] of the windows with the gram at place o that another row shares.

    Row i has ``run[i] + window - 1`` words; its gram starts at word ``off[i]``.
    """
    n, width = len(h), int(off.max()) + 1
    lone = np.arange(n, dtype=np.uint64)[:, None] | np.uint64(1 << 63)  # never equal between rows
    right, left = np.repeat(lone, window, axis=1), np.repeat(lone, max(width - 1, 1), axis=1)
    sizes, flat = run + window - 1, np.concatenate(words)
    row = np.repeat(np.arange(n), sizes)
    col = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes) - off[row]
    r, l_ = (col >= 0) & (col < window), col < 0
    right[row[r], col[r]] = flat[r]
    left[row[l_], -1 - col[l_]] = flat[l_]
    nodes = []
    for m in (right, left):
        order = np.lexsort([m[:, c] for c in range(m.shape[1] - 1, -1, -1)] + [h])
        nodes.append((order, _common(order, h, m)))
    group = np.unique(h, return_inverse=True)[1]

    def node_of(side: int, depth: int) -> np.ndarray:
        if depth == 0:
            return group
        order, lcp = nodes[side]
        out = np.empty(n, np.int64)
        out[order] = np.cumsum(lcp < depth)
        return out

    repeated = np.zeros((n, width), bool)
    for o in range(width):
        has = np.flatnonzero((o <= off) & (o > off - run))
        if len(has) > 1:
            key = node_of(0, window - o)[has] * (n + 1) + node_of(1, o)[has]
            _, which, count = np.unique(key, return_inverse=True, return_counts=True)
            repeated[has, o] = count[which] > 1
    return repeated


def _trees(window: int):
    schema = pa.schema([("doc_id", pa.int64()), ("th", pa.int64()), ("s", pa.int64()), ("e", pa.int64())])

    def solve(table: pa.Table) -> pa.RecordBatch:
        h = table.column("h").to_numpy()
        pos = table.column("pos").to_numpy()
        first, off, run = pos // (_OFF * _RUN), pos // _RUN % _OFF, pos % _RUN
        words = [np.frombuffer(b, np.uint64) for b in table.column("words").to_pylist()]
        hit = repeated_windows(h, off, run, words, window)
        edge = np.diff(hit.astype(np.int8), axis=1, prepend=0, append=0)
        row, lo = np.nonzero(edge == 1)
        _, hi = np.nonzero(edge == -1)  # both in row order
        anchor = first + off
        rows = pa.array(row)
        return pa.RecordBatch.from_arrays(
            [table.column("doc_id").combine_chunks().take(rows), table.column("th").combine_chunks().take(rows),
             pa.array(anchor[row] - (hi - 1)), pa.array(anchor[row] - lo + window)], schema=schema)

    def trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows = 0
        for batch in batches:
            for at in range(0, batch.num_rows, TREE_ROWS):
                held.append(batch.slice(at, TREE_ROWS))
                rows += held[-1].num_rows
                if rows < TREE_ROWS:
                    continue
                table = pa.Table.from_batches(held)
                h = table.column("h").to_numpy()
                cut = int(np.searchsorted(h, h[-1]))  # the last group may go on
                if cut:
                    yield solve(table.slice(0, cut))
                held, rows = table.slice(cut).to_batches(), len(h) - cut
        if rows:
            yield solve(pa.Table.from_batches(held))

    return trees


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64())]))
    for whole in batches:
        for batch in slices(whole, "text"):
            offsets, words = split_words(batch.column("text"))
            edge = np.zeros(len(words) + 1, np.int64)
            for start, spans in zip(offsets.tolist(), batch.column("spans").to_pylist()):
                for x in spans or ():
                    edge[start + x["s"]] += 1
                    edge[start + x["e"]] -= 1
            kept = np.cumsum(edge[:-1]) == 0
            upto = np.concatenate([[0], np.cumsum(kept)])[offsets]
            gone = np.diff(offsets) - np.diff(upto)
            text = _texts(upto, words.filter(pa.array(kept)))
            first = ~kept & np.insert(kept[:-1], 0, True)[: len(kept)]
            last = ~kept & np.append(kept[1:], True)[: len(kept)]
            at = offsets[:-1][offsets[:-1] < len(kept)]
            first[at] = ~kept[at]  # a removed run ends with its text
            at = offsets[1:][offsets[1:] > 0] - 1
            last[at] = ~kept[at]
            start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
            owner, _ = places(offsets)
            own = owner[start]
            lists = pa.StructArray.from_arrays([pa.array(start - offsets[own]), pa.array(end - offsets[own])], names=["s", "e"])
            removed = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(np.bincount(own, minlength=batch.num_rows))]), pa.int32()), lists)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_words"), pa.array(gone, pa.int64()), text, removed.cast(kind)],
                names=["doc_id", "n_words", "n_removed", "kept", "removed"])


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", window: int = 35, prefix: int = 12, group_rows: int = 256,
) -> DataFrame:
    """One row per row of ``docs``: (doc_id, n_words, n_removed, kept, removed, kept_sha256).

    Words are runs without ASCII whitespace, taken unchanged. A word goes when a window
    over it also starts anywhere else, be it in its own text; ``kept`` is the kept words
    joined by one space, ``kept_sha256`` is its digest, and ``removed`` lists the removed
    runs of words in order as (s, e), the first word's place and that after the last.
    The digest costs nothing where the column isn't asked for. A ``window`` less ``prefix``
    of 255 or more raises. Null texts have no words, texts shorter than a window
    keep all. Rows with the same id are told apart by a 64-bit text hash; rows alike in
    both repeat each other. A null id is a value like any other. Other columns are ignored.
    """
    if not 0 < prefix <= window or window - prefix + 1 >= _RUN:
        raise ValueError(f"window - prefix must be 0 to {_RUN - 2}")
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("th"), F.col(text).alias("text"))
    anchors = base.mapInArrow(_find(window, prefix), "h long, doc_id long, th long, pos long")
    shared = anchors.groupBy("h").agg(F.count("*").alias("n")).filter("n > 1")
    shared = materialize(shared, "prefixes")
    kept = anchors.join(shared, "h").groupBy("doc_id", "th").agg(F.collect_set(F.struct("h", "n", "pos")).alias("anchors"))
    kept = materialize(kept, "suffixes").select(F.col("doc_id").alias("_i"), F.col("th").alias("_h"), "anchors")
    rows = base.join(kept, F.col("doc_id").eqNullSafe(F.col("_i")) & (F.col("th") == F.col("_h")), "left").select("doc_id", "th", "text", "anchors")
    kinds = "anchors array<struct<h: bigint, n: bigint, pos: bigint>>"
    rows = materialize(rows.mapInArrow(_split, f"doc_id long, th long, n_words long, text string, {kinds}"), "split")
    done = rows.filter("anchors is null").select("doc_id", "n_words", F.lit(0).cast("long").alias("n_removed"), F.col("text").alias("kept"),
                                                F.array().cast("array<struct<s: bigint, e: bigint>>").alias("removed"))
    open_ = rows.filter("anchors is not null").select("doc_id", "th", "n_words", "text", "anchors")

    source = open_.select("doc_id", "th", "text", "anchors")
    suffixes = source.mapInArrow(_contexts(window, group_rows, False), "h long, doc_id long, th long, pos long, words binary")
    spans = suffixes.repartition("h").sortWithinPartitions("h").mapInArrow(_trees(window), "doc_id long, th long, s long, e long")
    windows = source.mapInArrow(_contexts(window, group_rows, True), "w1 long, w2 long, doc_id long, th long, s long")
    often = materialize(windows.groupBy("w1", "w2").agg(F.count("*").alias("n")).filter("n > 1").select("w1", "w2"), "windows")
    long_ = windows.join(often, ["w1", "w2"], "left_semi").select("doc_id", "th", "s", (F.col("s") + window).alias("e"))
    spans = spans.union(long_).groupBy("doc_id", "th").agg(F.collect_set(F.struct("s", "e")).alias("spans"))
    spans = materialize(spans, "spans").select(F.col("doc_id").alias("_i"), F.col("th").alias("_h"), "spans")
    open_ = open_.drop("anchors").join(spans, F.col("doc_id").eqNullSafe(F.col("_i")) & (F.col("th") == F.col("_h")), "left")
    kinds = "doc_id long, n_words long, n_removed long, kept string, removed array<struct<s: bigint, e: bigint>>"
    removed = open_.select("doc_id", "n_words", "text", "spans").mapInArrow(_remove, kinds)
    return done.union(removed).withColumn("kept_sha256", F.sha2(F.col("kept").cast("binary"), 256))
