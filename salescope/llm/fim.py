"""Fill-in-the-middle transformation of texts cut at line ends.

One pyarrow.compute pipeline per slice of a batch: texts are split into list arrays of
units (lines with their line end), the lists are flattened with the index of their
parent, each unit gets its ordinal, and the ordinal against the two cuts of its parent
gives its role: prefix, middle or suffix. Units are filtered by role, lists are rebuilt
from the counts of units per parent, ``binary_join`` makes one piece of each list, and the
pieces are joined in the order of the document's form with sentinels between them.

The two cuts and the form come from four numbers of a hash of the id, which Spark's own
functions compute, so that any run gives the same result. Texts are processed a few
megabytes at a time; one text is never cut across slices.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salescope.llm.word_arrays import slices

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"


def draws(id_col: Column, seed: int) -> list[Column]:
    """Four unsigned 32-bit numbers from sha256 of ``seed:id``; a null id counts as an empty one."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def _remainder(a: pa.Array, b: pa.Array) -> pa.Array:
    return pc.subtract(a, pc.multiply(pc.divide(a, b), b))


def units(texts: pa.Array) -> pa.ListArray:
    """Lines with their line ends; an empty text has none."""
    pieces = pc.split_pattern(texts, "\n")
    parent, flat = pc.list_parent_indices(pieces), pc.list_flatten(pieces)
    ordinal, last = _ordinals(parent, len(texts)), pc.subtract(pc.list_value_length(pieces), 1)
    is_last = pc.equal(ordinal, pc.take(last, parent))
    # all pieces but the last of a text ended at a line end; a last piece without text is no unit
    ended = pc.if_else(is_last, flat, pc.binary_join_element_wise(flat, pa.scalar("\n", flat.type), pa.scalar("", flat.type)))
    full = pc.invert(pc.and_(is_last, pc.equal(flat, "")))
    return _rebuilt(pc.filter(ended, full), pc.filter(parent, full), len(texts))


def _sizes(parent: pa.Array, n: int) -> np.ndarray:
    return np.bincount(parent.to_numpy(), minlength=n)


def _ordinals(parent: pa.Array, n: int) -> pa.Array:
    """Place of each flattened unit within its parent."""
    first = np.concatenate([[0], np.cumsum(_sizes(parent, n))[:-1]]) if n else np.zeros(0, np.int64)
    return pc.subtract(pa.array(np.arange(len(parent)), pa.int64()), pc.take(pa.array(first, pa.int64()), parent))


def _rebuilt(flat: pa.Array, parent: pa.Array, n: int) -> pa.LargeListArray:
    return pa.LargeListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(_sizes(parent, n))]), pa.int64()), flat)


def cut_pieces(texts: pa.Array, h1: pa.Array, h2: pa.Array) -> dict[str, pa.Array]:
    """Number of units and prefix, middle and suffix of each text."""
    lists = units(texts)
    n = pc.list_value_length(lists).cast(pa.int64())
    a, b = (_remainder(h, pc.add(n, 1)) for h in (h1, h2))
    low, high = pc.min_element_wise(a, b), pc.max_element_wise(a, b)
    parent, flat = pc.list_parent_indices(lists), pc.list_flatten(lists)
    ordinal = _ordinals(parent, len(texts))
    before, after = pc.less(ordinal, pc.take(low, parent)), pc.greater_equal(ordinal, pc.take(high, parent))
    roles = {"prefix": before, "middle": pc.invert(pc.or_(before, after)), "suffix": after}
    joined = {"n": n}
    for role, mask in roles.items():
        joined[role] = pc.binary_join(_rebuilt(pc.filter(flat, mask), pc.filter(parent, mask), len(texts)), pa.scalar("", flat.type))
    return joined


def _transformed(batch: pa.RecordBatch, rate: int, spm: int) -> list[pa.Array]:
    texts = pc.fill_null(batch.column("text").cast(pa.large_string()), "")
    h1, h2, h3, h4 = (batch.column(f"h{i}") for i in range(1, 5))
    got = cut_pieces(texts, h1, h2)
    hundred = pa.scalar(100, pa.int64())
    plain = pc.or_(pc.equal(got["n"], 0), pc.greater_equal(_remainder(h3, hundred), rate))
    for sentinel in (PREFIX, SUFFIX, MIDDLE):
        plain = pc.or_(plain, pc.match_substring(texts, sentinel))
    first = pc.less(_remainder(h4, hundred), spm)
    form = pc.if_else(plain, "plain", pc.if_else(first, "spm", "psm"))
    p, s, m, none = (pa.scalar(x, pa.large_string()) for x in (PREFIX, SUFFIX, MIDDLE, ""))
    psm = pc.binary_join_element_wise(p, got["prefix"], s, got["suffix"], m, got["middle"], none)
    spm_ = pc.binary_join_element_wise(s, got["suffix"], p, got["prefix"], m, got["middle"], none)
    output = pc.if_else(plain, texts, pc.if_else(first, spm_, psm))
    gap = pa.scalar(None, pa.int64())
    chars = [pc.if_else(plain, gap, pc.utf8_length(got[r]).cast(pa.int64())) for r in ("prefix", "middle")]
    return [got["n"], form, *chars, output]


def transform(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", seed: int = 7, rate: int = 100, spm: int = 50,
) -> DataFrame:
    """(id, n, form, prefix_chars, middle_chars, output) for each row of ``docs``.

    ``rate`` percent of the texts are transformed, ``spm`` percent of these with the
    suffix first. Null and empty texts have no units and stay as the empty text in the
    form plain, and so does a text that holds a sentinel. Texts are cut whole, however
    long. Repeated rows each have their row, a null id hashes like an empty one; an
    empty table gives no rows, and other columns, whatever their names, are ignored.
    """
    key = F.col(f"`{id_col}`")
    rows = docs.select(key.alias("id"), F.col(f"`{text}`").alias("text"), *[h.alias(f"h{i}") for i, h in enumerate(draws(key, seed), 1)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                n, form, prefix, middle, output = _transformed(part, rate, spm)
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), n, form.cast(pa.string()), prefix, middle, output.cast(pa.string())],
                    names=[id_col, "n", "form", "prefix_chars", "middle_chars", "output"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"`{id_col}` {kind}, n long, form string, prefix_chars long, middle_chars long, output string")


def restore(output: Column, form: Column) -> Column:
    """The exact text from an output and its form. No piece holds a sentinel, so the first of each kind is the mark."""
    parts = {f: rf"(?s)\A{a}(.*?){b}(.*?){MIDDLE}(.*)\z" for f, a, b in (("psm", PREFIX, SUFFIX), ("spm", SUFFIX, PREFIX))}
    order = {"psm": (1, 3, 2), "spm": (2, 3, 1)}
    built = {f: F.concat(*[F.regexp_extract(output, parts[f], i) for i in order[f]]) for f in parts}
    return F.when(form == "plain", output).when(form == "psm", built["psm"]).otherwise(built["spm"])
