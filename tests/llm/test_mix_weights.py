"""Mixing against exact target weights."""

from collections import Counter
from fractions import Fraction

import pytest

from salescope.llm import pfair


def widest(rows, target, block_docs):
    """The largest distance between the blocks a source has had and its target, over all slots."""
    slots = {(r.source, r.block): r.slot for r in rows}
    assert len(set(slots.values())) == len(slots)
    order = [s for (s, _), _ in sorted(slots.items(), key=lambda x: x[1])]
    had, most = Counter(), Fraction(0)
    for t, s in enumerate(order, 1):
        had[s] += 1
        most = max([most, *(abs(had[k] - w * t) for k, w in target.items())])
    return most


def table(spark, sizes):
    rows = [(i, s) for s, n in sizes.items() for i in range(n)]
    return spark.createDataFrame([(j, s) for j, (_, s) in enumerate(rows)], "doc_id long, source string")


@pytest.mark.parametrize("weights", [{"a": 0.9, "b": 0.1}, {"a": "9/10", "b": "1/10"}, {"a": 9, "b": 1}])
def test_a_hundred_cycles_stay_within_a_block(spark, weights):
    rows = pfair.mix_sources(table(spark, {"a": 1800, "b": 200}), block_docs=2, weights=weights).collect()
    assert max(r.slot for r in rows) == 999
    assert widest(rows, {"a": Fraction(9, 10), "b": Fraction(1, 10)}, 2) < 1


def test_unequal_sources_stay_within_a_block(spark):
    weights = {"a": 0.5, "b": 0.23, "c": 0.17, "d": 0.07, "e": 0.03}
    rows = pfair.mix_sources(table(spark, {s: round(w * 3000) for s, w in weights.items()}), block_docs=1, weights=weights).collect()
    assert widest(rows, {s: Fraction(str(w)) for s, w in weights.items()}, 1) < 1


def test_a_thousand_sources(spark):
    names = {f"s{i:04}": 1 + i % 2 for i in range(1000)}
    total = sum(names.values())
    rows = pfair.mix_sources(table(spark, {s: w * 2 for s, w in names.items()}), block_docs=1, weights=names).collect()
    assert len({r.slot for r in rows}) == 2 * total
    assert widest(rows, {s: Fraction(names[s], total) for s in ("s0000", "s0001", "s0998", "s0999")}, 1) < 1


def test_weights_in_whole_numbers():
    assert pfair.exact_parts({"a": 0.9, "b": 0.1}, 100) == {"a": 9, "b": 1}
    assert pfair.exact_parts({"a": 6, "b": 4.0}, 100) == {"a": 3, "b": 2}
    assert pfair.exact_parts({"a": 0.12345, "b": 1}, 100) is None
    with pytest.raises(ValueError):
        pfair.exact_parts({"a": 0, "b": 1}, 100)
