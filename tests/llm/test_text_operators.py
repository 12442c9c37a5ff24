"""Deduplication and decontamination against plain versions, with nulls, ties and odd columns."""

import random

import brute
import pytest
from pyspark.sql import functions as F

from salescope.llm import count_rtree, line_dedup, suffix_groups, winnowing

WORDS = "a b c d e f g Ä ö ñ the OF 1 22".split()


def table(spark, texts, ids=None):
    """Documents with extra columns whose names the operators use themselves."""
    ids = range(len(texts)) if ids is None else ids
    rows = [(i, t, 7, "x", None) for i, t in zip(ids, texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, n long, th string, n_hit long")


def corpus(seed, n=60, length=60):
    rng = random.Random(seed)
    base = [[rng.choice(WORDS) + str(rng.randrange(9)) for _ in range(length)] for _ in range(8)]
    texts = []
    for _ in range(n):
        w = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 2, 6])):
            w[rng.randrange(len(w))] = rng.choice(WORDS)
        a = rng.randrange(len(w) // 2)
        texts.append(rng.choice([" ", "  ", "\n", "\t "]).join(w[a:] if rng.random() < 0.4 else w))
    return [*texts, None, "", "  \n ", "one two", "ONE two", texts[0], texts[0]]


@pytest.mark.parametrize("seed", [1, 2])
def test_similar_components(spark, seed):
    texts = corpus(seed)
    want = brute.similar_components(list(enumerate(texts)))
    got = count_rtree.similar_components(table(spark, texts), few=3, rare=3, block=4).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert len(got) == len(texts)


def test_keep_one(spark):
    texts = corpus(3)
    docs = table(spark, texts).union(table(spark, texts[:3]))
    want = brute.similar_components(list(enumerate(texts)))
    kept = count_rtree.keep_one(docs)
    assert kept.columns == docs.columns
    alone = sorted(i for i, (n, c) in want.items() if n == 0 or c == i)
    assert sorted(r.doc_id for r in kept.collect()) == alone


def test_keep_one_of_each_component_of_null_and_shared_ids(spark):
    a, b = ([f"{x}{i}" for i in range(40)] for x in "ab")
    near = " ".join([*b[:-1], "z"])
    texts = [" ".join(f"u{i}w{j}" for j in range(12)) for i in range(30)]
    rows = [(None, t) for t in texts] + [(None, texts[0]), (5, " ".join(a)), (5, " ".join(b)), (7, near), (None, near)]
    kept = count_rtree.keep_one(table(spark, [t for _, t in rows], [i for i, _ in rows]))
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=str)
    assert got == sorted([*((None, t) for t in texts), (5, " ".join(a)), (5, " ".join(b))], key=str)


def test_components_with_null_ids(spark):
    docs = table(spark, ["p q r s t u"] * 2 + ["w"], [None, 4, None])
    got = sorted(((r.doc_id, r.component_id) for r in count_rtree.similar_components(docs).collect()), key=str)
    assert got == [(4, 4), (None, 4), (None, None)]


@pytest.mark.parametrize("seed,group_rows", [(1, 256), (2, 3)])
def test_remove_repeats(spark, seed, group_rows):
    import hashlib

    texts = corpus(seed, 40)
    want = brute.remove_repeats(texts, 12)
    got = suffix_groups.remove_repeats(table(spark, texts), window=12, prefix=4, group_rows=group_rows).collect()
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in got}
    assert got == {i: (n, n - len(k), hashlib.sha256(" ".join(k).encode()).hexdigest()) for i, (n, k) in enumerate(want)}


def test_remove_repeats_gives_texts_and_spans(spark):
    texts = [*corpus(3, 12), "k l m n o p q r s t u v w", "x k l m n o p q r s t u v w", " ".join(["y"] * 30)]
    want = brute.remove_repeats(texts, 12)
    for r in suffix_groups.remove_repeats(table(spark, texts), window=12, prefix=4).collect():
        n, kept = want[r.doc_id]
        assert r.kept == " ".join(kept)
        gone = [i for s, e in r.removed for i in range(s, e)]
        assert len(gone) == n - len(kept) and [w for i, w in enumerate((texts[r.doc_id] or "").split()) if i not in gone] == kept
    with pytest.raises(ValueError):
        suffix_groups.remove_repeats(table(spark, texts), window=300, prefix=12)


def test_repeated_rows_repeat_each_other(spark):
    docs = table(spark, ["k l m n o p q"] * 2 + ["k l m n"], [5, 5, None])
    got = sorted((r.n_words, r.n_removed) for r in suffix_groups.remove_repeats(docs, window=5, prefix=2).collect())
    assert got == [(4, 0), (7, 7), (7, 7)]


@pytest.mark.parametrize("seed", [4, 5])
def test_decontaminate(spark, seed):
    texts = corpus(seed, 30)
    rng = random.Random(seed)
    items = [(i, " ".join((texts[rng.randrange(30)]).split()[a : a + rng.choice([3, 6, 10, 14, 25])])) for i, a in enumerate([0, 3, 5, 8, 10, 11])]
    items += [(90, None), (91, ""), (92, items[0][1])]
    bench = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, len int")
    got = winnowing.decontaminate(table(spark, texts), bench).collect()
    assert {r.doc_id: (r.n_words, r.n_hit, r["items"]) for r in got} == dict(enumerate(brute.decontaminate(texts, items)))
    clean = winnowing.clean_documents(table(spark, texts), bench)
    assert sorted(r.doc_id for r in clean.collect()) == [i for i, x in enumerate(brute.decontaminate(texts, items)) if not x[1]]


def test_dedup_lines(spark):
    rng = random.Random(6)
    lines = ["Common line ", "\tcommon LINE", "É", "é", "", " ", "x\r", "rare one", "two"]
    texts = ["\n".join(rng.choices(lines, k=rng.randrange(9))) for _ in range(30)] + [None, ""]
    docs = table(spark, texts)
    got = line_dedup.dedup_lines(docs, min_docs=9)
    assert got.columns == [*docs.columns, "n_lines", "n_dropped"]
    rows = {r.doc_id: r for r in got.collect()}
    want = brute.dedup_lines(texts, 9)
    assert {i: r.text for i, r in rows.items()} == dict(enumerate(want))
    assert all(r.n_lines == len((texts[i] or "").split("\n")) for i, r in rows.items())


def test_empty_tables(spark):
    docs = table(spark, [])
    bench = spark.createDataFrame([], "item_id long, text string")
    assert count_rtree.similar_components(docs).count() == 0
    assert suffix_groups.remove_repeats(docs).count() == 0
    assert winnowing.decontaminate(docs, bench).count() == 0
    assert line_dedup.dedup_lines(docs).count() == 0
    assert winnowing.decontaminate(table(spark, ["a b"]), bench).agg(F.sum("n_hit")).first()[0] == 0


def test_very_long_text(spark):
    long = " ".join(f"w{i % 997}x{i}" for i in range(60_000))
    docs = table(spark, [long, "z", long])
    assert [r.n_removed for r in suffix_groups.remove_repeats(docs).orderBy("doc_id").collect()] == [60_000, 0, 60_000]
