"""Plain versions of the operators, over lists of rows."""

import re
from collections import defaultdict

ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, width=5):
    w = WORD.findall((text or "").translate(ASCII_LOWER))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + width]) for i in range(max(len(w) - width, 0) + 1))


def similar_components(rows, width=5):
    """doc_id -> (size, component), by comparing all pairs that share a shingle."""
    sets = {d: shingles(t, width) for d, t in rows}
    holders = defaultdict(list)
    for d, s in sets.items():
        for x in s:
            holders[x].append(d)
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for d, s in sets.items():
        shared = defaultdict(int)
        for x in s:
            for o in holders[x]:
                shared[o] += 1
        for o, n in shared.items():
            if o != d and 100 * n >= 75 * (len(s) + len(sets[o]) - n):
                a, b = sorted((find(d), find(o)))
                parent[b] = a
    return {d: (len(s), find(d)) for d, s in sets.items()}


def words10(text):
    return WORD.findall(text or "")


def remove_repeats(texts, window):
    """Per text (n_words, kept words)."""
    starts = defaultdict(int)
    docs = [words10(t) for t in texts]
    for w in docs:
        for i in range(len(w) - window + 1):
            starts[tuple(w[i : i + window])] += 1
    out = []
    for w in docs:
        gone = set()
        for i in range(len(w) - window + 1):
            if starts[tuple(w[i : i + window])] > 1:
                gone.update(range(i, i + window))
        out.append((len(w), [x for i, x in enumerate(w) if i not in gone]))
    return out


WORD5 = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def decontaminate(texts, items, window=10):
    """Per text (n_words, n_hit, sorted item ids)."""
    grams = []
    for i, t in items:
        w = WORD5.findall((t or "").translate(ASCII_LOWER))
        n = min(len(w), window)
        grams += [(i, tuple(w[s : s + n])) for s in range(len(w) - n + 1) if n]
    out = []
    for t in texts:
        w = WORD5.findall((t or "").translate(ASCII_LOWER))
        hit, names = set(), set()
        for i, g in grams:
            for s in range(len(w) - len(g) + 1):
                if tuple(w[s : s + len(g)]) == g:
                    hit.update(range(s, s + len(g)))
                    names.add(str(i))
        out.append((len(w), len(hit), sorted(names)))
    return out


def dedup_lines(texts, min_docs):
    strip = "".join(map(chr, (32, 9, 10, 11, 12, 13)))
    docs = [(t or "").split("\n") for t in texts]
    key = [[x.strip(strip).translate(ASCII_LOWER) for x in d] for d in docs]
    count = defaultdict(int)
    for k in key:
        for x in set(k):
            count[x] += 1
    return ["\n".join(x for x, y in zip(d, k) if not y or count[y] < min_docs) for d, k in zip(docs, key)]
