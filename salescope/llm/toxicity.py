"""Toxicity scoring of text that may hide its words.

A writer's word reaches the page through a noisy channel: letters become look-alikes,
letters repeat, and spaces or marks come between them. A character trigram model counted
over the whole corpus says what words look like; a Viterbi search over the lattice of
readings of a suspicious token finds the likeliest one. Words as written and as restored
are then scored: features are words and word beginnings that labelled toxic documents have
and clean ones lack, and a logistic regression over few sums of them gives the score.

The model counts are one bounded array per task, summed by Spark, and cover every
document. Features and regression are fitted on at most ``fit_rows`` labelled rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from salescope.llm.word_arrays import slices, split_words
from salescope.session import materialize

LETTERS = "abcdefghijklmnopqrstuvwxyz"
OTHER = 27  # any letter outside a-z
SYMBOLS = 28  # 0 is the edge of a word
#: Letters that a sign may stand for.
LOOKALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e", "(": "c", "£": "l",
}
SIGNS = re.escape("".join(LOOKALIKES))
#: A token that may be disguised: a letter and a look-alike sign, a letter twice in a row, or a mark between letters.
SUSPICIOUS = re.compile(rf"[^\W\d_].*[{SIGNS}]|[{SIGNS}].*[^\W\d_]|([^\W\d_])\1|[^\W\d_](?:[^\w\s]|_)+[^\W\d_]", re.S)
#: What makes a token of letters alone suspicious.
DOUBLED = re.compile(r"([^\W\d_])\1")
#: Most tokens whose reading a task keeps; a new one is read again when its turn comes.
CACHED = 200_000
#: Single letters with marks between them.
MARKED = re.compile(r"(?:[^\W_](?:[^\w\s]|_)){3}")
NOT_LETTERS = re.compile(r"[\W\d_]+")
SUBSTITUTED, REPEATED, PARTED, SPLIT, SPACE = -1.5, -0.7, -0.5, -3.0, -1.0
BEGINNINGS = (4, 5, 6)
#: Single letters and signs in a row that are read as spaced words.
SPACED = 2


def symbol(c: str) -> int:
    at = ord(c) - 96
    return at if 1 <= at <= 26 else OTHER


def is_single(token: str) -> bool:
    return len(token) == 1 and (token.isalnum() or token in LOOKALIKES)


def _spelt(symbols: list[int], flat: list[float]) -> float:
    """The log-probability of a word, its end included."""
    a = b = 0
    total = 0.0
    for c in symbols:
        total += flat[(a * SYMBOLS + b) * SYMBOLS + c]
        a, b = b, c
    return total + flat[(a * SYMBOLS + b) * SYMBOLS]


def _once_doubled(low: str, flat: list[float]) -> str | None:
    """The likelier of a word with one doubled letter and the word with that letter once; None for other words."""
    at = [i for i in range(1, len(low)) if low[i] == low[i - 1]]
    if len(at) != 1:
        return None
    letters = [symbol(c) for c in low]
    i = at[0]
    if _spelt(letters, flat) >= REPEATED + _spelt(letters[:i] + letters[i + 1 :], flat):
        return low
    return low[:i] + low[i + 1 :]


def restore_word(token: str, logp: np.ndarray) -> str:
    """:func:`restored` under a trigram model given as an array."""
    return restored(token, logp.ravel().tolist())


def restored(token: str, flat: list[float]) -> str:
    """The likeliest reading of a token; ``flat`` holds the log-probability of c after a, b for all (a, b, c).

    Each sign is read as itself if it is a letter, as a letter it looks like, or as
    nothing if it repeats the sign before or is a mark between letters. Marks, and spaces
    that spaced letters are joined with, may also end a word, so that the reading can be
    several words with a space between. Signs with no other reading are dropped. The
    empty token reads as itself.
    """
    low = token.lower()
    if low.isalpha() and (read := _once_doubled(low, flat)) is not None:
        return read
    # the state a * SYMBOLS + b stands for the last two symbols read
    states: dict[int, tuple[float, tuple]] = {0: (0.0, ())}
    last, worst = "", (-math.inf,)
    for c in low:
        gap = c == " "
        letters = [(c, 0.0)] if c.isalpha() else [(x, SUBSTITUTED) for x in LOOKALIKES.get(c, "")]
        reads = [(x, symbol(x), cost) for x, cost in letters]
        skip = 0.0 if gap else REPEATED if c == last else PARTED if not c.isalnum() else None if reads else 0.0
        ends = SPACE if gap else SPLIT if not c.isalnum() else None
        new: dict[int, tuple[float, tuple]] = {}
        for state, (score, path) in states.items():
            base, b = state * SYMBOLS, state % SYMBOLS
            for letter, s, cost in reads:
                got, to = score + cost + flat[base + s], b * SYMBOLS + s
                if got > new.get(to, worst)[0]:
                    new[to] = (got, (path, letter))
            if skip is not None and score + skip > new.get(state, worst)[0]:
                new[state] = (score + skip, path)
            if ends is not None and b and score + ends + flat[base] > new.get(b * SYMBOLS, worst)[0]:
                new[b * SYMBOLS] = (score + ends + flat[base], (path, " "))
        states, last = new, last if gap else c
    _, path = max((score + (flat[state * SYMBOLS] if state % SYMBOLS or not path else 0.0), path) for state, (score, path) in states.items())
    out = []
    while path:
        path, letter = path
        out.append(letter)
    return "".join(reversed(out)).strip() or token


def restore_text(text: str, logp: np.ndarray) -> str:
    """The text with suspicious tokens, and runs of spaced single letters, restored."""
    out, run = [], []
    for token in [*text.split(" "), ""]:
        if is_single(token):
            run.append(token)
            continue
        out += [restore_word(" ".join(run), logp)] if len(run) >= SPACED and any(map(str.isalpha, run)) else run
        run = []
        out.append(restore_word(token, logp) if SUSPICIOUS.search(token.lower()) else token)
    return " ".join(out[:-1])


_TABLE = np.zeros(256, np.int64)
for _i, _c in enumerate(LETTERS, 1):
    _TABLE[ord(_c)] = _TABLE[ord(_c.upper())] = _i
_TABLE[128:] = OTHER


def _count_trigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(SYMBOLS**3, np.int64)
    for whole in batches:
        for batch in slices(whole, "text"):
            raw = "\n\n".join(["", *(t for t in batch.column("text").to_pylist() if t), ""]).encode()
            s = _TABLE[np.frombuffer(raw, np.uint8)]
            if len(s) > 2:
                total += np.bincount((s[:-2] * SYMBOLS + s[1:-1]) * SYMBOLS + s[2:], minlength=SYMBOLS**3)
    some = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], names=["gram", "n"])


def character_model(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Log-probabilities of trigrams over all texts, smoothed; at most 28**3 counts reach the driver."""
    counts = docs.select(F.col(text).alias("text")).mapInArrow(_count_trigrams, "gram int, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    n = np.zeros(SYMBOLS**3)
    for gram, c in counts.collect():
        n[gram] = c
    n = n.reshape((SYMBOLS,) * 3)
    uni = (n.sum((0, 1)) + 1) / (n.sum() + SYMBOLS)
    bi = (n.sum(0) + 5 * uni) / (n.sum((0, 2))[:, None] + 5)
    return np.log((n + 5 * bi[None]) / (n.sum(2)[:, :, None] + 5))


def bare(low: str) -> str:
    return low.strip("\"'.,;:!?()[]{}<>*#%&$-_|")


def features_of(words) -> tuple[str, ...]:
    return tuple({x for w in words if w for x in (w, *(w[:k] + "*" for k in BEGINNINGS if len(w) > k))})


def word_features(token: str, logp: np.ndarray | list[float], cache: dict) -> tuple[str, ...]:
    """Features of a token: words and their beginnings, as written, as split at what is no letter, and as restored."""
    got = cache.get(token)
    if got is None:
        low, flat = token.lower(), logp if isinstance(logp, list) else logp.ravel().tolist()
        if low.isalpha():
            forms = {low, *(restored(low, flat).split(" ") if DOUBLED.search(low) else ())}
        else:
            forms = {bare(low), *(w for w in NOT_LETTERS.split(low) if len(w) > 1)}
            if " " in low or SUSPICIOUS.search(low):
                forms.update(restored(low, flat).split(" "))
        got = features_of(forms)
        if len(cache) > CACHED:
            cache.clear()
        cache[token] = got
    return got


def _tokens(batch: pa.RecordBatch):
    """(offsets, codes, distinct tokens, extra): extra lists (row, letters with a space between) of spaced words."""
    offsets, words = split_words(batch.column("text"))
    coded = words.dictionary_encode()
    if isinstance(coded, pa.ChunkedArray):
        coded = coded.combine_chunks()
    tokens = coded.dictionary.to_pylist()
    codes = coded.indices.to_numpy() if len(words) else np.empty(0, np.int64)
    single = np.array([is_single(t) for t in tokens], bool)[codes] if len(tokens) else np.empty(0, bool)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    start = single.copy()
    start[1:] &= ~single[:-1] | (row[1:] != row[:-1])
    at = np.flatnonzero(start)
    if len(at):
        sizes = np.bincount(np.cumsum(start)[single] - 1, minlength=len(at))
        extra = [(row[a], " ".join(tokens[c] for c in codes[a : a + m])) for a, m in zip(at, sizes) if m >= SPACED]
        extra = [(r, x) for r, x in extra if any(map(str.isalpha, x))]
    else:
        extra = []
    return offsets, codes, tokens, extra


@dataclass
class ToxicityModel:
    logp: np.ndarray
    weights: dict[str, float] = field(default_factory=dict)
    coefficients: np.ndarray = field(default_factory=lambda: np.zeros(6))

    @cached_property
    def flat(self) -> list[float]:
        return self.logp.ravel().tolist()

    @cached_property
    def starts(self) -> dict[str, float]:
        """Weights of the beginnings of words."""
        return {x[:-1]: w for x, w in self.weights.items() if x.endswith("*")}

    @cached_property
    def pieces(self) -> tuple[set[str], set[str], set[str]]:
        """What words with a weight can be split into: first, middle and last pieces."""
        words = [w for w in self.weights if len(w) > 3 and w.isalpha()]
        return ({w[:k] for w in words for k in range(1, len(w))}, {w[i:k] for w in words for k in range(2, len(w)) for i in range(1, k)},
                {w[k:] for w in words for k in range(1, len(w))})

    def weight_of(self, words: Iterable[str]) -> float:
        """The largest weight of the words and their beginnings, 0 if none has one."""
        best = 0.0
        for w in words:
            best = max(best, self.weights.get(w, 0.0)) if w else best
            for k in BEGINNINGS:
                if len(w) > k:
                    best = max(best, self.starts.get(w[:k], 0.0))
        return best

    def facts(self, token: str) -> tuple[float, str, bool, bool, bool]:
        """(weight, letters, and whether these may begin, continue or end a split word) of a token, restored once."""
        low = token.lower()
        if low.isalpha():
            weight = self.weight_of((low,))
            if DOUBLED.search(low):
                weight = max(weight, self.weight_of(restored(low, self.flat).split(" ")))
            form = low
        else:
            words = [bare(low), *(w for w in NOT_LETTERS.split(low) if len(w) > 1)]
            form = words[0]
            if SUSPICIOUS.search(low):
                read = restored(low, self.flat)
                words += read.split(" ")
                form = NOT_LETTERS.sub("", read)
            weight = self.weight_of(words)
            if MARKED.search(token):
                weight = max(weight, self.inside(token))
        first, middle, last = self.pieces
        return weight, form, form in first, form in middle, form in last

    def split_words(self, row: np.ndarray, codes: np.ndarray, facts: list[tuple]) -> list[tuple[int, float]]:
        """(row, weight) of the words with a weight that two or three tokens in a row make up."""
        forms = [f[1] for f in facts]
        first, middle, last = (np.array([f[i] for f in facts], bool)[codes] for i in (2, 3, 4))
        out = []
        for n in (2, 3):
            if len(codes) < n:
                break
            fit = first[: 1 - n] & last[n - 1 :] & (row[: 1 - n] == row[n - 1 :])
            if n == 3:
                fit &= middle[1:-1]
            for i in np.flatnonzero(fit).tolist():
                w = self.weights.get("".join(forms[c] for c in codes[i : i + n]))
                if w:
                    out.append((int(row[i]), w))
        return out

    def inside(self, spaced: str) -> float:
        """The largest weight of a word of four letters or more in letters whose word ends are not told."""
        best = 0.0
        for x in {restored(spaced, self.flat).replace(" ", ""), NOT_LETTERS.sub("", spaced.lower())}:
            for i in range(len(x) - 3):
                k = i + 1
                while k <= len(x) and (k == len(x) or x[i:k] in self.pieces[0]):
                    k += 1
                best = max([best, *(self.weights.get(x[i:e], 0.0) for e in range(i + 4, min(k, len(x)) + 1))])
        return best

    def sums(self, batch: pa.RecordBatch, cache: dict) -> np.ndarray:
        """Per text: 1, number of hits, their sum, the largest, hits per word, log of the words."""
        offsets, codes, tokens, extra = _tokens(batch)
        n = len(offsets) - 1
        if len(cache) > CACHED:
            cache.clear()
        facts = []
        for t in tokens:
            found = cache.get(t)
            if found is None:
                found = cache[t] = self.facts(t)
            facts.append(found)
        w = np.array([f[0] for f in facts])
        size = np.diff(offsets)
        row = np.repeat(np.arange(n), size)
        more = self.split_words(row, codes, facts) if len(tokens) else []
        value = w[codes] if len(codes) else np.empty(0)
        hit = value > 0
        row, value = row[hit], value[hit]
        for r, spaced in extra:
            low = spaced.lower()
            v = self.weight_of([bare(low), *(x for x in NOT_LETTERS.split(low) if len(x) > 1), *restored(low, self.flat).split(" ")])
            v = max(v, self.inside(spaced))
            more += [(int(r), v)] if v > 0 else []
        row = np.concatenate([row, np.array([r for r, _ in more], np.int64)])
        value = np.concatenate([value, np.array([v for _, v in more], float)])
        hits = np.bincount(row, minlength=n).astype(float)
        total = np.bincount(row, weights=value, minlength=n)
        most = np.zeros(n)
        np.maximum.at(most, row, value)
        return np.stack([np.ones(n), np.log1p(hits), np.log1p(total), most, hits / np.maximum(size, 1), np.log1p(size)], axis=1)

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(x @ self.coefficients, -30, 30)))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 30) -> np.ndarray:
    """Coefficients by Newton steps; with one class only, the intercept leans to it."""
    beta = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        w = np.maximum(p * (1 - p), 1e-9)
        step = np.linalg.solve((x * w[:, None]).T @ x + ridge * np.eye(x.shape[1]), x.T @ (y - p) - ridge * beta)
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    return beta


def _count_features(logp):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict = {}
        flat = logp.value.ravel().tolist()
        for whole in batches:
            for batch in slices(whole, "text"):
                offsets, codes, tokens, extra = _tokens(batch)
                seen: tuple[Counter, Counter] = (Counter(), Counter())
                more: dict[int, set] = {}
                for r, spaced in extra:
                    more.setdefault(int(r), set()).update(word_features(spaced, flat, cache))
                for i, y in enumerate(batch.column("y").to_pylist()):
                    own = {x for c in np.unique(codes[offsets[i] : offsets[i + 1]]) for x in word_features(tokens[c], flat, cache)}
                    seen[y].update(own | more.get(i, set()))
                names = list(seen[0].keys() | seen[1].keys())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names, pa.string()), pa.array([seen[1][x] for x in names], pa.int64()), pa.array([seen[0][x] for x in names], pa.int64())],
                    names=["feature", "toxic", "clean"])

    return count


def fit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "toxic",
    fit_rows: int = 20_000, vocabulary: int = 5_000, least_docs: int = 3, least_odds: float = 2.0,
) -> ToxicityModel:
    """The character model over all ``docs`` and a classifier from at most ``fit_rows`` labelled rows.

    ``labels`` must hold training rows only. Null labels and ids are passed over; of
    several labels of an id the largest counts. Ids are taken in hash order; of an id
    with several rows all count for the features and one for the regression, so at most
    ``fit_rows`` rows reach the driver. Features are kept when ``least_docs`` toxic documents have them and their
    log-odds are at least ``least_odds``, the ``vocabulary`` strongest of them. Without
    labels the score is 0.5 times what an empty regression gives, the same for all.
    """
    spark = docs.sparkSession
    model = ToxicityModel(character_model(docs, text))
    y = labels.select(F.col(id_col).cast("long").alias("_i"), F.col(label).cast("int").alias("y")).filter("_i is not null and y in (0, 1)")
    y = y.groupBy("_i").agg(F.max("y").alias("y"))
    y = materialize(y.orderBy(F.xxhash64("_i"), "_i").limit(fit_rows), "labelled")
    rows = docs.select(F.col(id_col).cast("long").alias("_i"), F.col(text).alias("text")).join(y, "_i").select("text", "y", "_i")
    logp = spark.sparkContext.broadcast(model.logp)
    counts = rows.mapInArrow(_count_features(logp), "feature string, toxic long, clean long")
    counts = counts.groupBy("feature").agg(F.sum("toxic").alias("t"), F.sum("clean").alias("c"))
    sizes = dict(y.groupBy("y").count().collect())
    odds = F.log((F.col("t") + 0.5) / (sizes.get(1, 0) + 1.0)) - F.log((F.col("c") + 0.5) / (sizes.get(0, 0) + 1.0))
    best = counts.withColumn("odds", odds).filter((F.col("t") >= least_docs) & (F.col("odds") >= least_odds))
    best = best.orderBy(F.desc(F.col("odds") * F.log(F.col("t") + 1.0)), "feature").limit(vocabulary)
    model.weights = {r["feature"]: r["odds"] for r in best.collect()}
    shipped = spark.sparkContext.broadcast(model)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict = {}
        for whole in batches:
            for batch in slices(whole, "text"):
                x = shipped.value.sums(batch, cache)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in x.T] + [batch.column("y"), batch.column("_i")], names=[*"abcdef", "y", "_i"])

    found = rows.mapInArrow(sums, ", ".join(f"{c} double" for c in "abcdef") + ", y int, _i long")
    table = found.groupBy("_i").agg(F.min(F.struct(*"abcdef", "y")).alias("r")).select("r.*").toPandas()
    if len(table):
        table = table.sort_values([*"abcdef", "y"])  # the sum's order, and so the result, is fixed
        model.coefficients = logistic(table[[*"abcdef"]].to_numpy(), table["y"].to_numpy(float))
    return model


def score_documents(docs: DataFrame, model: ToxicityModel, text: str = "text") -> DataFrame:
    """``docs`` with a column ``toxicity`` between 0 and 1, from whole texts alone.

    Null and empty texts have no hits and get the score of such a text. Repeated rows
    score alike; a column of ``docs`` that is called ``toxicity`` is replaced.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(model)
    docs = docs.drop("toxicity")
    columns = docs.columns

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict = {}
        for whole in batches:
            for batch in slices(whole, text):
                got = shipped.value.scores(shipped.value.sums(pa.RecordBatch.from_arrays([batch.column(text)], names=["text"]), cache))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(got)], names=[*columns, "toxicity"])

    return docs.mapInArrow(score, StructType([*docs.schema.fields, StructField("toxicity", DoubleType())]))


def held_out(doc_id: Column) -> Column:
    """Rows kept from training: a fifth, by the checksum of the id. A null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))
