"""Quality rules whose cutoffs are certified on labelled documents.

Each rule compares one statistic of a text with a cutoff, and has a ladder of cutoffs
from lax to strict; level l of the ladder applies the l-th cutoff of every rule, so the
documents that level l rejects are among those of level l + 1. The ladder is fixed
before any label is seen, so all labelled documents are holdout. In each stratum a
level is certified when the hypothesis "more than ``max_false_rejection`` of the good
documents are rejected" falls at an exact binomial test, that is, when the
Clopper-Pearson bound of the rejected good documents lies below the limit. Levels are
tested in order and the first that fails ends the sequence, which needs no correction
among levels; the error is divided by the number of strata (Bonferroni). So with
probability 1 - ``error`` no stratum loses more than the limit to the rules. A stratum
whose labels can't certify any level has no rules beyond the base ones.

The statistics of a slice of texts are taken by numpy over all its bytes, words and
lines; windows of words are compared exactly, by numbering pairs, then pairs of pairs.
What is counted per stratum is one row of a few numbers, from a partial aggregate.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salescope.functions.student import regularized_beta
from salescope.llm.word_arrays import places, slices, split_words
from salescope.session import materialize

#: rule: (counted, per, "above" or "below", percent cutoffs from lax to strict)
RULES: dict[str, tuple[str, str, str, tuple[int, ...]]] = {
    "symbols_per_word": ("n_symbols", "n_words", "above", (200, 100, 50, 25, 15, 10)),
    "words_without_letters": ("n_plain_words", "n_words", "above", (70, 50, 40, 30, 25, 20)),
    "capitals": ("n_capitals", "n_letters", "above", (90, 80, 70, 60, 50, 40)),
    "long_words": ("word_chars", "n_words", "above", (1500, 1300, 1200, 1100, 1000, 950)),
    "short_words": ("word_chars", "n_words", "below", (200, 250, 280, 300, 330, 350)),
    "distinct_words": ("n_distinct_words", "n_words", "below", (5, 10, 15, 20, 25, 30)),
    "equal_lines": ("n_dup_lines", "n_word_lines", "above", (90, 70, 50, 40, 35, 30)),
    "repeated_words": ("n_repeat_words", "n_words", "above", (29, 27, 25, 23, 21, 20)),
}
STATISTICS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_plain_words", "n_capitals", "n_letters", "n_distinct_words", "n_word_lines",
)


def _byte_class(chars: str | range) -> np.ndarray:
    table = np.zeros(256, np.int64)
    table[[ord(c) for c in chars] if isinstance(chars, str) else list(chars)] = 1
    return table


_SYMBOL = _byte_class("#*$%&|<>")
_CAPITAL = _byte_class(range(65, 91))
_LETTER = _CAPITAL + _byte_class(range(97, 123))
_WORDLIKE = _LETTER + _byte_class(range(128, 256))  # bytes of a letter or of a character beyond ASCII
_START = 1 - _byte_class(range(128, 192))  # first byte of a code point


def _content(strings: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, bounds) of an array of strings without nulls."""
    strings = pa.concat_arrays([strings.cast(pa.large_string())])
    bounds = np.frombuffer(strings.buffers()[1], np.int64)[strings.offset : strings.offset + len(strings) + 1]
    data = strings.buffers()[2]
    return np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8), bounds


def _counts(data: np.ndarray, bounds: np.ndarray, table: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(table[data])])
    return total[bounds[1:]] - total[bounds[:-1]]


def _numbered(a: np.ndarray) -> np.ndarray:
    return np.unique(a, return_inverse=True)[1].astype(np.int64)


def _repeats(owner: np.ndarray, place: np.ndarray, sizes: np.ndarray, codes: np.ndarray, window: int) -> np.ndarray:
    """Which words lie in a window of ``window`` words that its text holds more than once."""
    n = len(codes)
    inside = np.zeros(n, bool)
    if n < window:
        return inside
    parts, width, reach = codes, 1, 0
    whole = np.zeros(n - window + 1, np.int64)
    left = window
    while left:  # windows as binary sums of power-of-two runs, each run numbered exactly
        if left & width:
            run = parts[reach : reach + len(whole)]
            whole = _numbered(whole * (run.max() + 1) + run)
            reach, left = reach + width, left - width
        if left:
            parts = _numbered(parts[: len(parts) - width] * (parts.max() + 1) + parts[width:])
            width *= 2
    starts = np.flatnonzero(place[: len(whole)] + window <= sizes[owner[: len(whole)]])
    key = owner[starts] * (whole.max() + 1) + whole[starts]
    _, number, count = np.unique(key, return_inverse=True, return_counts=True)
    hit = starts[count[number] > 1]
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, hit, 1)
    np.add.at(change, hit + window, -1)
    return np.cumsum(change[:-1]) > 0


def text_statistics(texts: pa.Array, window: int = 8) -> dict[str, np.ndarray]:
    """``STATISTICS`` of each text; a null text counts as empty."""
    texts = pc.fill_null(texts, "")
    offsets, words = split_words(texts)
    owner, place = places(offsets)
    sizes, n = np.diff(offsets), len(texts)

    def per_text(flags: np.ndarray) -> np.ndarray:
        return np.bincount(owner, flags, n).astype(np.int64)

    data, bounds = _content(texts)
    word_data, word_bounds = _content(words)
    codes = words.dictionary_encode()
    codes = (codes.combine_chunks() if isinstance(codes, pa.ChunkedArray) else codes).indices.to_numpy().astype(np.int64)
    distinct = np.unique(owner * (codes.max(initial=0) + 1) + codes)

    lists = pc.split_pattern(texts.cast(pa.large_string()), "\n")
    cuts = lists.offsets.to_numpy().astype(np.int64)
    lines = lists.values.slice(cuts[0], cuts[-1] - cuts[0])
    full = pc.not_equal(pc.ascii_trim_whitespace(lines), "").to_numpy(zero_copy_only=False)
    line_owner = np.repeat(np.arange(n), np.diff(cuts))[full]
    line_codes = lines.filter(pa.array(full)).dictionary_encode().indices.to_numpy().astype(np.int64)
    distinct_lines = np.unique(line_owner * (line_codes.max(initial=0) + 1) + line_codes) // (line_codes.max(initial=0) + 1)
    n_lines = np.bincount(line_owner, minlength=n)

    return {
        "n_words": sizes,
        "word_chars": per_text(_counts(word_data, word_bounds, _START)),
        "n_symbols": _counts(data, bounds, _SYMBOL),
        "n_dup_lines": n_lines - np.bincount(distinct_lines, minlength=n),
        "n_repeat_words": per_text(_repeats(owner, place, sizes, codes, window)),
        "n_plain_words": per_text(_counts(word_data, word_bounds, _WORDLIKE) == 0),
        "n_capitals": _counts(data, bounds, _CAPITAL),
        "n_letters": _counts(data, bounds, _LETTER),
        "n_distinct_words": np.bincount(distinct // (codes.max(initial=0) + 1), minlength=n),
        "n_word_lines": n_lines,
    }


def measure(docs: DataFrame, text: str, carry: Mapping[str, Column]) -> DataFrame:
    """The columns ``carry`` and ``STATISTICS`` for each row of ``docs``."""
    rows = docs.select(*[c.alias(f"c{i}") for i, c in enumerate(carry.values())], F.col(f"`{text}`").alias("text"))
    names = list(carry)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                found = text_statistics(part.column("text"))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], *(pa.array(found[s], pa.int64()) for s in STATISTICS)], names=[*names, *STATISTICS])

    kinds = [rows.schema[f"c{i}"].dataType.simpleString() for i in range(len(names))]
    schema = ", ".join([f"`{n}` {k}" for n, k in zip(names, kinds)] + [f"{s} long" for s in STATISTICS])
    return rows.mapInArrow(run, schema)


def base_failed() -> Column:
    """Fewer than 20 words, or over 30 % of them in repeated windows."""
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def _broken(rule: str, level: int) -> Column:
    counted, per, side, cutoffs = RULES[rule]
    left, right = 100 * F.col(counted), cutoffs[level - 1] * F.col(per)
    return (left > right) if side == "above" else (left < right)


def n_levels() -> int:
    return len(next(iter(RULES.values()))[3])


def first_broken() -> Column:
    """The laxest level at which some rule rejects the row; null if none does."""
    found = F.lit(None).cast("int")
    for level in range(n_levels(), 0, -1):
        broken = _broken(next(iter(RULES)), level)
        for rule in list(RULES)[1:]:
            broken = broken | _broken(rule, level)
        found = F.when(broken, level).otherwise(found)
    return found


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(at most k of n) for trials of probability p, 0 < p < 1."""
    return 1.0 if k >= n else regularized_beta(n - k, k + 1, 1.0 - p)


def certified_levels(
    labelled: DataFrame, max_false_rejection: float = 0.05, error: float = 0.05,
) -> DataFrame:
    """(stratum, n_good, certified) from good documents as (stratum, level).

    ``level`` is the laxest level that rejects the document, null if none does. Strata
    are tested at ``error`` divided by their number; a null stratum is one like others.
    """
    levels = n_levels()
    counts = labelled.groupBy("stratum").agg(
        F.count("*").alias("n_good"), F.array(*[F.count_if(F.col("level") <= i) for i in range(1, levels + 1)]).alias("rejected"))
    strata = counts.select(F.count("*").alias("n_strata"))
    kind = labelled.schema["stratum"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best = []
            for row in batch.select(["n_good", "rejected", "n_strata"]).to_pylist():
                passed = 0
                for k in row["rejected"]:
                    if binomial_tail(k, row["n_good"], max_false_rejection) > error / row["n_strata"]:
                        break
                    passed += 1
                best.append(passed)
            yield pa.RecordBatch.from_arrays(
                [batch.column("stratum"), batch.column("n_good"), pa.array(best, pa.int32())], names=["stratum", "n_good", "certified"])

    return counts.withColumn("n_strata", strata.scalar()).mapInArrow(run, f"stratum {kind}, n_good long, certified int")


def judge_quality(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", stratum: str = "lang",
    label: str = "quality", max_false_rejection: float = 0.05, error: float = 0.05,
) -> DataFrame:
    """Statistics and verdict of each row of ``docs``, and the certified level of its stratum.

    Columns: the id, ``stratum``, ``STATISTICS``, ``base_failed``, ``level`` (the laxest
    level that rejects the row, null if none), ``certified`` (0 where nothing is
    certified) and ``kept``. Null and empty texts have no words and fail the base rules,
    as every text under 20 words does. A labelled good document is an id whose labels
    are all 1; ids with both labels or null ones, and null ids, count as unlabelled. Each
    row of a repeated id is one trial. A text is judged whole, however long. An empty
    table gives no rows; without labels only the base rules hold. Other columns of
    ``docs``, whatever their names, are ignored.
    """
    rows = measure(docs, text, {"id": F.col(f"`{id_col}`"), "stratum": F.col(f"`{stratum}`")})
    rows = rows.withColumn("base_failed", base_failed()).withColumn("level", first_broken())
    rows = materialize(rows, "quality")
    value = F.col(f"`{label}`")
    good = labels.select(F.col(f"`{id_col}`").alias("id"), value.alias("label")).filter("id is not null").groupBy("id").agg(
        F.min("label").alias("low"), F.max("label").alias("high"), F.count_if(F.col("label").isNull()).alias("gaps"))
    good = good.filter("low = 1 and high = 1 and gaps = 0").select("id")
    trials = rows.filter(~F.col("base_failed")).select("id", "stratum", "level").join(good, "id", "left_semi")
    levels = materialize(certified_levels(trials, max_false_rejection, error).select(F.col("stratum").alias("of"), "certified"), "certified")
    out = rows.join(levels, F.col("stratum").eqNullSafe(F.col("of")), "left").drop("of")
    out = out.withColumn("certified", F.coalesce("certified", F.lit(0)))
    kept = ~F.col("base_failed") & ~F.coalesce(F.col("level") <= F.col("certified"), F.lit(False))
    return out.withColumn("kept", kept).withColumnRenamed("id", id_col)


def broken_rules(level: Column | str = "certified") -> Column:
    """Names of the rules that reject a row of ``judge_quality`` at a level of the ladder."""
    at = F.col(level) if isinstance(level, str) else level
    names: Sequence[Column] = [
        F.when(F.coalesce(*[F.when(at == i, _broken(rule, i)) for i in range(1, n_levels() + 1)], F.lit(False)), F.lit(rule))
        for rule in RULES
    ]
    return F.array_compact(F.array(*names))
