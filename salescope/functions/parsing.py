"""Column expressions for messy catalogue fields. No Python runs per row."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

_WHITESPACE = " \t\n\r\x0b\x0c"

# One element of a list literal: a quoted string with escapes, or a plain scalar.
# Possessive quantifiers keep the matcher linear and off the Java stack.
_ITEM = (
    r"(?:'[^'\\\n]*+(?:\\.[^'\\\n]*+)*+'"
    r'|"[^"\\\n]*+(?:\\.[^"\\\n]*+)*+"'
    r"|[-+]?[0-9.]++|None|True|False)"
)
_LIST = r"^\s*+\[\s*+(?:" + _ITEM + r"\s*+(?:,\s*+" + _ITEM + r"\s*+)*+,?+\s*+)?+\]\s*+$"
_QUOTED = r"""['"]([^'"]+)['"]"""


def slug(label: str) -> str:
    """Column-name form of a label: lower case, runs of other characters as ``_``."""
    return re.sub(r"[^a-z0-9]+", "_", label.lower()).strip("_")


def flag(cond: Column) -> Column:
    """0/1 from a condition; null counts as 0."""
    return F.coalesce(cond, F.lit(False)).cast("int")


def binary_round(c: Column, places: int) -> Column:
    """Half-even rounding of the scaled binary value, as array libraries round."""
    scale = F.lit(10.0 ** places)
    return F.rint(c * scale) / scale


def parse_utc(c: Column) -> Column:
    """Timestamp whose fields read as UTC in any session zone; null if invalid."""
    return F.to_utc_timestamp(F.try_to_timestamp(c), F.current_timezone())


def date_parts(c: Column) -> dict[str, Column]:
    ts = parse_utc(c)
    return {
        "release_year": F.year(ts),
        "release_month": F.month(ts),
        "release_quarter": F.quarter(ts),
    }


def entity_age(year: Column, ref_year: int) -> Column:
    """Years since release, floored at 0; null stays null."""
    age = F.lit(ref_year) - year
    return F.when(age < 0, 0).otherwise(age).cast("int")


def list_string_count(c: Column) -> Column:
    """Items of a list literal held as text; other text counts its quoted parts."""
    n = F.when(c.rlike(_LIST), F.regexp_count(c, F.lit(_ITEM))).otherwise(
        F.regexp_count(c, F.lit(_QUOTED))
    )
    return F.coalesce(n, F.lit(0)).cast("int")


def range_midpoint(c: Column) -> Column:
    """Midpoint of ``lo - hi``; the empty range ``0 - 0`` and garbage give null."""
    parts = F.split(c, " - ")
    lo = F.get(parts, F.lit(0)).try_cast("double")
    hi = F.get(parts, F.lit(1)).try_cast("double")
    return F.when(c != "0 - 0", (lo + hi) / 2.0)


def split_labels(c: Column) -> Column:
    """Comma-separated text as an array of trimmed labels."""
    return F.split(F.regexp_replace(F.btrim(c, F.lit(_WHITESPACE)), r"\s*,\s*", ","), ",")


def tag_list(c: Column) -> Column:
    """Trimmed non-empty tags, duplicates kept; null gives an empty array."""
    return F.coalesce(F.array_remove(split_labels(c), ""), F.array().cast("array<string>"))


def label_flags(labels: Column, vocabulary: Sequence[str], prefix: str) -> dict[str, Column]:
    """One exact-match flag per word of a vocabulary."""
    return {
        prefix + word.lower().replace(" ", "_"): flag(F.array_contains(labels, word))
        for word in vocabulary
    }


def group_flags(labels: Column, groups: Mapping[str, Sequence[str]]) -> dict[str, Column]:
    """One flag per keyword group: set when any keyword is present."""
    return {
        name: flag(F.arrays_overlap(labels, F.array(*[F.lit(w) for w in words])))
        for name, words in groups.items()
    }


def tag_flags(tags: Column, vocabulary: Sequence[str]) -> dict[str, Column]:
    return {"tag_" + slug(t): flag(F.array_contains(tags, t)) for t in vocabulary}


def review_columns(pos: Column, neg: Column) -> dict[str, Column]:
    """Review total and damped positive share, rounded half to even."""
    zero = F.lit(0).cast("bigint")
    p, n = F.coalesce(pos.cast("bigint"), zero), F.coalesce(neg.cast("bigint"), zero)
    return {"total_reviews": p + n, "review_ratio": binary_round(p / (p + n + 1), 4)}


def positive_flag(c: Column) -> Column:
    return flag(c > 0)


def loose_bool(c: Column) -> Column:
    """0/1 where a missing value counts as true, as a float NaN does when cast."""
    return F.coalesce(c.cast("boolean"), F.lit(True)).cast("int")


def text_length(c: Column) -> Column:
    return F.length(F.coalesce(c, F.lit("")))


def ordinal_code(c: Column, order: Mapping[str, int]) -> Column:
    """Position on an ordinal scale; unknown and null give -1."""
    expr = F.lit(-1)
    for name, code in order.items():
        expr = F.when(c == name, code).otherwise(expr)
    return expr.cast("int")


def log1p_floor(c: Column) -> Column:
    """``log1p`` of the value floored at 0; null as 0."""
    return F.log1p(F.greatest(F.coalesce(c.cast("double"), F.lit(0.0)), F.lit(0.0)))


def band(c: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Right-closed buckets: the first edge at or above the value names it."""
    expr = F.when(c.isNotNull(), labels[len(edges)])
    for edge, label in reversed(list(zip(edges, labels))):
        expr = F.when(c <= edge, label).otherwise(expr)
    return expr
