"""Corpus-wide line deduplication.

Lines are normalised, exploded and hashed; a key found in at least ``min_docs``
documents loses all its lines everywhere; the other lines are put together again
by position.

The hash is 128 bits wide and stands for the key. A document counts a key once:
its keys are made distinct inside the row, so the count is a plain sum with a
map-side combine, and a line that a third of all documents share costs each task
one partial row. The join that finds the lines to drop is keyed by line, and its
large side may be split by adaptive execution; the list of dropped positions that
comes back is bounded by the length of its document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salescope.llm.common import WHITESPACE, lower_ascii, numbered, text_key
from salescope.session import materialize


def line_key(line: Column) -> Column:
    """The line without whitespace at its ends, A-Z lower-cased."""
    return lower_ascii(F.trim(line, F.lit(WHITESPACE)))


def _hashed_lines(text: Column) -> Column:
    """An array of (k1, k2) per line, null where the key is empty."""
    lines = F.split(lower_ascii(text), "\n")

    def hashed(line: Column) -> Column:
        key = F.trim(line, F.lit(WHITESPACE))
        return F.when(key != "", F.struct(*text_key(key)))

    return F.transform(lines, hashed)


def frequent_lines(docs: DataFrame, text: str = "text", min_docs: int = 10) -> DataFrame:
    """(k1, k2, n_docs) of the non-empty line keys in at least ``min_docs`` rows."""
    keys = docs.select(F.explode(F.array_distinct(_hashed_lines(F.col(text)))).alias("k")).filter("k is not null")
    counts = keys.groupBy(F.col("k.k1").alias("k1"), F.col("k.k2").alias("k2")).agg(F.count("*").alias("n_docs"))
    return counts.filter(F.col("n_docs") >= min_docs)


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text: str = "text", min_docs: int = 10) -> DataFrame:
    """Every column of ``docs`` with ``text`` cleaned, plus ``n_lines`` and ``n_dropped``.

    Null and empty texts have one empty line, which is never dropped, and come back
    as the empty string. Each row counts as one document, so repeated rows are
    several documents; rows are told apart by (id, text hash), and a null id is a
    value like any other. Columns of ``docs`` named like the two added ones are
    replaced; names with dots are read as plain names. An empty table gives no rows; a text
    of any length is one row of the table and one array of line hashes.
    """
    plain, named = numbered(docs)
    columns = {c: n for c, n in named.items() if c not in ("n_lines", "n_dropped")}
    body = F.coalesce(F.col(named[text]), F.lit(""))
    docs, key = plain, F.col(named[id_col])
    frequent = materialize(frequent_lines(docs.select(body.alias("_b")), "_b", min_docs).select("k1", "k2"), "lines")
    rows = docs.select(key.alias("_id"), F.xxhash64(body).alias("_h"), F.posexplode(_hashed_lines(body)).alias("_p", "_k"))
    hits = rows.filter("_k is not null").select("_id", "_h", "_p", F.col("_k.k1").alias("k1"), F.col("_k.k2").alias("k2"))
    hits = hits.join(frequent, ["k1", "k2"], "left_semi")
    drop = materialize(hits.groupBy("_id", "_h").agg(F.collect_set("_p").alias("_drop")), "dropped")

    own = [n for c, n in columns.items() if c != text]
    left = docs.select(*own, body.alias("_b"), key.alias("_lid"), F.xxhash64(body).alias("_lh"))
    joined = left.join(drop, F.col("_lid").eqNullSafe(F.col("_id")) & (F.col("_lh") == F.col("_h")), "left")
    lines = F.split("_b", "\n")
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("_drop"))
    out = joined.select(
        *own, lines.alias("_lines"), "_drop", "_b",
        F.size(lines).cast("long").alias("n_lines"),
        F.coalesce(F.size(F.col("_drop")), F.lit(0)).cast("long").alias("n_dropped"),
    )
    cleaned = F.when(F.col("n_dropped") > 0, F.array_join(F.transform(kept, lambda p: F.col("_lines")[p]), "\n"))
    out = out.withColumn(named[text], F.coalesce(cleaned, F.col("_b")))
    return out.select(*[F.col(n).alias(c) for c, n in columns.items()], "n_lines", "n_dropped")
