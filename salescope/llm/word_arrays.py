"""Texts as arrays of word hashes, a few megabytes at a time, for functions over Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

#: Odd multiplier of the rolling hash and its inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15
BASE_INVERSE = pow(BASE, -1, 1 << 64)
SLICE_BYTES = 4_000_000


def slices(batch: pa.RecordBatch, text: str) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of a batch with about ``SLICE_BYTES`` of text each."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    part = np.cumsum(sizes) // SLICE_BYTES
    cuts = np.flatnonzero(np.diff(part, prepend=-1)).tolist() + [batch.num_rows]
    for lo, hi in zip(cuts, cuts[1:]):
        yield batch.slice(lo, hi - lo)


def split_words(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """(offsets, words) of the words between ASCII whitespace; null texts have none."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, "").cast(pa.large_string()))
    bounds = lists.offsets.to_numpy().astype(np.int64)
    flat = lists.values.slice(bounds[0], bounds[-1] - bounds[0])
    full = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)
    upto = np.concatenate([[0], np.cumsum(full)])
    return upto[bounds - bounds[0]], flat.filter(pa.array(full))


def word_ids(words: pa.Array) -> np.ndarray:
    """A 64-bit hash per word; each distinct word is hashed once."""
    coded = words.dictionary_encode()
    if isinstance(coded, pa.ChunkedArray):
        coded = coded.combine_chunks()
    ids = np.fromiter((xxhash.xxh64_intdigest(w) for w in coded.dictionary.to_pylist()), np.uint64, len(coded.dictionary))
    return ids[coded.indices.to_numpy()] if len(words) else np.empty(0, np.uint64)


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection that spreads all bits."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def word_hashes(words: pa.Array, longest: int = 512) -> np.ndarray:
    """A 64-bit hash per word (large strings) from its length and its bytes, eight at a time for all words at once."""
    if not len(words):
        return np.empty(0, np.uint64)
    offsets = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words) + 1]
    data = np.zeros(offsets[-1] - offsets[0] + 8, np.uint8)
    data[:-8] = np.frombuffer(words.buffers()[2], np.uint8)[offsets[0] : offsets[-1]] if len(data) > 8 else 0
    eight = np.ndarray(len(data) - 7, "<u8", buffer=data, strides=(1,))
    used = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
    start, sizes = offsets[:-1] - offsets[0], np.diff(offsets)
    h = mixed(sizes.astype(np.uint64) + np.uint64(BASE))
    own = np.flatnonzero(sizes <= longest)
    for k in range(0, longest, 8):
        own = own[sizes[own] > k] if k else own
        if not len(own):
            break
        h[own] = mixed(h[own] ^ (eight[start[own] + k] & used[np.minimum(sizes[own] - k, 8)]))
    for i in np.flatnonzero(sizes > longest).tolist():
        h[i] = xxhash.xxh64_intdigest(data[start[i] : start[i] + sizes[i]].tobytes())
    return h


def gram_hashes(ids: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k words from each position on, over the whole array, across texts."""
    if len(ids) < k:
        return np.empty(0, np.uint64)
    n = len(ids)
    up = np.full(n, BASE, np.uint64)
    up[0] = 1
    down = np.full(n, BASE_INVERSE, np.uint64)
    down[0] = 1
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(ids * np.cumprod(up))])
    return mixed((total[k:] - total[:-k]) * np.cumprod(down)[: n - k + 1])


def places(offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each word the number of its text and its place in it."""
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    return owner, np.arange(len(owner)) - offsets[owner]
