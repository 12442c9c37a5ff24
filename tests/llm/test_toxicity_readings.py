"""The decoder against all readings of short tokens, and the bounds of what fitting sends to the driver."""

import random

import numpy as np
import pytest

from salescope.llm import toxicity as T


def model(seed):
    rng = np.random.default_rng(seed)
    p = rng.dirichlet(np.full(T.SYMBOLS, 0.3), (T.SYMBOLS, T.SYMBOLS)) + 1e-4
    return np.log(p / p.sum(-1, keepdims=True))


def all_readings(token, logp):
    """(score, text) of every way to read, drop or end a word at each sign."""
    found = [(0.0, "", 0, 0)]
    last = ""
    for c in token.lower():
        after = []
        gap = c == " "
        reads = [(c, 0.0)] if c.isalpha() else [(x, T.SUBSTITUTED) for x in T.LOOKALIKES.get(c, "")]
        drop = 0.0 if gap else T.REPEATED if c == last else T.PARTED if not c.isalnum() else None if reads else 0.0
        end = T.SPACE if gap else T.SPLIT if not c.isalnum() else None
        for score, text, a, b in found:
            after += [(score + cost + logp[a, b, T.symbol(x)], text + x, b, T.symbol(x)) for x, cost in reads]
            if drop is not None:
                after.append((score + drop, text, a, b))
            if end is not None and b:
                after.append((score + end + logp[a, b, 0], text + " ", b, 0))
        found, last = after, last if gap else c
    return [(score + (logp[a, b, 0] if b or not text else 0.0), text.strip() or token) for score, text, a, b in found]


TOKENS = ["aabb", "loser", "l0s3r", "l-o-s", "s s a", "1d!0t", "id-iot", "aaa", "bb", "a$$", "st.up", "xx--yy", "\u00e9\u00e92", "7", "--", "a1l1", "oo0", "h e l"]


@pytest.mark.parametrize("seed", range(4))
def test_the_likeliest_of_all_readings_is_found(seed):
    logp, rng = model(seed), random.Random(seed)
    more = ["".join(rng.choice("abls01!-. $") for _ in range(rng.randrange(1, 7))) for _ in range(120)]
    for token in TOKENS + more:
        if not token.strip():
            continue
        readings = all_readings(token, logp)
        best = max(score for score, _ in readings)
        texts = {text for score, text in readings if score > best - 1e-9}
        assert T.restore_word(token, logp) in texts, token


def test_weights_of_a_token_are_the_largest_of_its_features():
    m = T.ToxicityModel(model(1), {"loser": 2.0, "idio*": 1.5, "stup*": 1.0, "fool": 3.0})
    for token in ["loser", "Loser!", "l0ser", "idiotic", "stupid", "stup", "fool-loser", "f o o l", "foool", "", "x", "a" * 40 + "0"]:
        want = max((m.weights.get(x, 0.0) for x in T.word_features(token, m.logp, {})), default=0.0)
        assert m.facts(token)[0] >= want if T.MARKED.search(token) else m.facts(token)[0] == want, token


def test_rows_of_one_id_send_one_row(spark, monkeypatch):
    rows = [(5, f"word{i % 7} and more words {i}") for i in range(400)] + [(6, "another text"), (None, "no id")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(5, 1), (5, 0), (6, 0), (6, None), (None, 1)], "doc_id long, toxic int")
    sent = []
    monkeypatch.setattr(T, "logistic", lambda x, y: sent.append((len(x), sorted(y))) or np.zeros(6))
    T.fit(docs, labels, fit_rows=2)
    assert sent == [(2, [0.0, 1.0])]
    T.fit(docs, labels.filter("doc_id < 0"))
    assert len(sent) == 1
