"""Benchmark decontamination by winnowing.

A text's fingerprints are the smallest hashes of its k-word grams in every run of
``window - k + 1`` grams, so any span of ``window`` words that a document shares with
an item contains a fingerprint of both. The fingerprints are joined, and each hit is
extended word by word to the windows of the item that hold it, which keeps the
windows that occur and nothing else.

All of it is SQL functions on arrays inside one row. The join against the corpus is
a semi join on distinct fingerprints, so an item passage that thousands of documents
quote multiplies nothing; contexts of the hits are made distinct by text before they
meet the items. Texts are keyed by two 64-bit hashes of the whole text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salescope.llm.common import lower_ascii, numbered, split_words, text_key
from salescope.session import materialize

#: Everything that is not part of a word.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]"


def words_of(text: Column) -> Column:
    """Words of digits, letters a-z after lower-casing, and all non-ASCII characters."""
    return split_words(lower_ascii(text), SEPARATORS)


def gram_hashes(hashes: str, k: int) -> str:
    """SQL: the hash of every k-gram over the array column of word hashes."""
    grams = ", ".join(f"try_element_at({hashes}, i + {j})" for j in range(1, k + 1))
    last = f"size({hashes}) - {k}"
    return f"if({last} < 0, cast(array() as array<bigint>), transform(sequence(0, {last}), i -> xxhash64({grams})))"


def window_minima(grams: str, width: int) -> str:
    """SQL: (pos, fp) of the smallest gram in every run of ``width``, leftmost on ties.

    Repeats are dropped while they are plain positions, which is linear in their number.
    """
    run = ", ".join(f"try_element_at({grams}, i + {j})" for j in range(1, width + 1))
    last = f"greatest(size({grams}) - {width}, 0)"
    least = f"transform(sequence(0, {last}), i -> cast(i + array_position(slice({grams}, i + 1, {width}), least({run})) - 1 as int))"
    pairs = f"transform(array_distinct({least}), p -> named_struct('pos', p, 'fp', {grams}[p]))"
    return f"if(size({grams}) = 0, cast(array() as array<struct<pos: int, fp: bigint>>), {pairs})"


def fingerprints(df: DataFrame, k: int, window: int) -> DataFrame:
    """Adds ``_f``, the array of (pos, fp), to a table with the word array ``_words``.

    Texts of ``k`` words and more that are shorter than a window get the smallest of
    their grams; shorter texts get none. Each step is bound to a lambda variable, so it
    is evaluated once per row.
    """
    minima = window_minima("g", window - k + 1)
    grams = f"transform(array({gram_hashes('h', k)}), g -> {minima})[0]"
    return df.withColumn("_f", F.expr(f"transform(array(transform(_words, w -> xxhash64(w))), h -> {grams})[0]"))


def item_windows(items: DataFrame, item_id: str, text: str, window: int) -> DataFrame:
    """(item_id, words, len): distinct windows of the items; a shorter item is one window."""
    w = items.select(F.col(item_id).alias("item_id"), words_of(F.col(text)).alias("_words")).filter(F.size("_words") > 0)
    starts = F.sequence(F.lit(0), F.greatest(F.size("_words") - window, F.lit(0)))
    w = w.select("item_id", F.explode(F.transform(starts, lambda i: F.slice(F.col("_words"), i + 1, window))).alias("words"))
    return w.distinct().withColumn("len", F.size("words"))


def contaminated_spans(
    docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
    window: int = 10, k: int = 5,
) -> DataFrame:
    """(k1, k2, item_id, start, len): where windows of items occur, by text of ``docs``.

    Items of fewer than ``window`` words are one window of their own length. Their
    lengths are at most ``window - 1`` different numbers; for each that occurs, every
    gram of that length is looked up, since fewer words give no winnowing guarantee.
    """
    grams = materialize(item_windows(items, item_id, item_text, window), "windows")
    texts = docs.select(F.col(text).alias("_text")).filter("_text is not null").select(
        *text_key(F.col("_text")), words_of(F.col("_text")).alias("_words"))

    full = fingerprints(grams.filter(F.col("len") == window).withColumnRenamed("words", "_words"), k, window)
    full = full.select("item_id", "_words", F.explode("_f").alias("f"))
    full = full.select(F.lit(window).alias("len"), F.col("f.fp").alias("fp"), F.col("f.pos").alias("off"), "item_id", F.col("_words").alias("words"))
    short = grams.filter(F.col("len") < window)
    lengths = sorted(r["len"] for r in short.select("len").distinct().collect())  # fewer than `window` numbers
    short = short.select("len", F.xxhash64("words").alias("fp"), F.lit(0).alias("off"), "item_id", "words")
    keys = materialize(full.unionByName(short), "item_fingerprints")
    wanted = materialize(keys.select("len", "fp").distinct(), "wanted")

    marked = fingerprints(texts, k, window).select("k1", "k2", F.lit(window).alias("len"), F.col("_f").alias("f"))
    for n in lengths:
        each = f"if(size(_words) < {n}, cast(array() as array<struct<pos: int, fp: bigint>>), transform(sequence(0, size(_words) - {n}), i -> named_struct('pos', i, 'fp', xxhash64(slice(_words, i + 1, {n})))))"
        marked = marked.unionByName(texts.select("k1", "k2", F.lit(n).alias("len"), F.expr(each).alias("f")))
    # the outer form, as the plain one repeats the whole array expression in a filter of its own
    marked = marked.select("k1", "k2", "len", F.inline_outer("f")).filter("fp is not null")
    found = marked.join(wanted, ["len", "fp"], "left_semi")
    found = materialize(found.groupBy("k1", "k2").agg(F.collect_set(F.struct("len", "fp", "pos")).alias("found")), "found")

    whole = docs.select(F.col(text).alias("_text")).filter("_text is not null").select(*text_key(F.col("_text")), "_text")
    # copies of a text go on as one, and are made so before the shuffle as well as after it
    whole = whole.dropDuplicates(["k1", "k2"])
    # always by shuffle: a size at which the plan changes would only move the cost, and hits grow with the texts
    whole = whole.join(found.hint("merge"), ["k1", "k2"]).select("k1", "k2", "found", words_of(F.col("_text")).alias("_words"))
    # words around a hit: all windows that hold it lie between pos - (window - k) and pos + window
    near = f"""transform(found, x -> named_struct('len', x.len, 'fp', x.fp, 'pos', x.pos,
        'left', least(x.pos, {window - k}),
        'ctx', slice(_words, x.pos - least(x.pos, {window - k}) + 1, {2 * window - k})))"""
    near = whole.select("k1", "k2", F.explode(F.expr(near)).alias("n")).select("k1", "k2", "n.*")
    near = materialize(near.dropDuplicates(["k1", "k2", "len", "fp", "pos"]), "contexts")
    pairs = near.join(keys, ["len", "fp"])
    at = F.col("left") - F.col("off")
    same = (at >= 0) & (F.slice("ctx", F.greatest(at, F.lit(0)) + 1, F.col("len")) == F.col("words"))
    spans = pairs.filter(same).select("k1", "k2", "item_id", (F.col("pos") - F.col("off")).alias("start"), "len")
    return spans.distinct()


def decontaminate(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text: str = "text", item_id: str = "item_id",
    item_text: str = "text", window: int = 10, k: int = 5,
) -> DataFrame:
    """One row per row of ``docs``: (doc_id, n_words, n_hit, items).

    A word is hit when it lies in an occurrence of an item window; ``items`` are the
    ids of the items with occurring windows, as strings in order. Null and empty texts
    have no words and no hits; items without words are never hit, and a null item id
    does not enter ``items`` though its windows count as hits. Repeated rows each get
    their row; other columns of both tables are ignored.
    """
    spans = materialize(contaminated_spans(docs, items, text, item_id, item_text, window, k), "spans")
    words = spans.select("k1", "k2", F.explode(F.expr("sequence(start, start + len - 1)")).alias("w")).distinct()
    words = words.groupBy("k1", "k2").agg(F.count("*").alias("n_hit"))
    names = spans.select("k1", "k2", F.col("item_id").cast("string").alias("i")).filter("i is not null").distinct()
    names = names.groupBy("k1", "k2").agg(F.array_sort(F.collect_list("i")).alias("items"))
    verdicts = materialize(words.join(names, ["k1", "k2"], "left"), "verdicts")
    rows = docs.select(
        F.col(id_col).alias("doc_id"), *text_key(F.coalesce(F.col(text), F.lit(""))),
        F.size(words_of(F.col(text))).cast("long").alias("n_words"))
    return rows.join(verdicts, ["k1", "k2"], "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("items", F.expr("cast(array() as array<string>)")).alias("items"))


def clean_documents(docs: DataFrame, items: DataFrame, text: str = "text", **options) -> DataFrame:
    """The rows of ``docs``, with all columns, in which no item window occurs; null texts stay."""
    spans = contaminated_spans(docs, items, text, **options).select(F.col("k1").alias("_k1"), F.col("k2").alias("_k2"))
    hit = materialize(spans.distinct(), "hit")
    plain, named = numbered(docs)
    k1, k2 = text_key(F.coalesce(F.col(named[text]), F.lit("")))
    kept = plain.join(hit, (k1 == F.col("_k1")) & (k2 == F.col("_k2")), "left_anti")
    return kept.select(*[F.col(n).alias(c) for c, n in named.items()])
