"""Columns of any name pass through the operators that return whole rows."""

import pytest

from salescope.llm import count_rtree, line_dedup, pfair, winnowing

EXTRA = ["_id", "_lid", "_h", "_b", "_n", "_s", "_l", "_t", "_k1", "_k2", "_o", "_i", "c0", "c1", "k1", "source", "th", "a.b", "_slot", "_parts"]


@pytest.fixture(scope="module")
def docs(spark):
    texts = ["one line of words here\nshared line", "other words in this one\nshared line", "one line of words here\nshared line", None, ""]
    rows = [(i, t, *[f"{n}{i}" for n in EXTRA]) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"`{n}` string" for n in EXTRA))


def extras(row):
    return [row[n] for n in EXTRA]


def expected(i):
    return [f"{n}{i}" for n in EXTRA]


def test_line_dedup(docs):
    got = line_dedup.dedup_lines(docs, min_docs=3)
    assert got.columns == docs.columns + ["n_lines", "n_dropped"]
    rows = {r.doc_id: r for r in got.collect()}
    assert all(extras(rows[i]) == expected(i) for i in range(5)) and rows[0].text == "one line of words here" and rows[3].text == ""


def test_mixing(docs):
    rows = {r.doc_id: r for r in pfair.mix_sources(docs, source="_s", block_docs=1).collect()}
    assert all(extras(rows[i]) == expected(i) for i in range(5)) and len({(r.slot, r.place) for r in rows.values()}) == 5


def test_near_duplicates(docs):
    rows = {r.doc_id: r for r in count_rtree.keep_one(docs).collect()}
    assert set(rows) == {0, 1, 3, 4} and all(extras(r) == expected(i) for i, r in rows.items())


def test_decontamination(spark, docs):
    items = spark.createDataFrame([("q", "other words in this one")], "item_id string, text string")
    rows = {r.doc_id: r for r in winnowing.clean_documents(docs, items).collect()}
    assert set(rows) == {0, 2, 3, 4} and all(extras(r) == expected(i) for i, r in rows.items())
