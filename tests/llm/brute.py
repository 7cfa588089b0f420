"""Plain, slow versions of the operators, and odd rows that all of them have to take."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Nulls in every column, empty, blank and long texts, repeated rows, ids out of order.
ODD = [
    (5, None, None, None, None), (3, "", "en", "s", 0), (4, " \n\t", "en", "s", 3), (None, "a text without an id, of more than five words", None, None, None), (9, "long " * 30_000 + "é", "en", "s", None),
    (7, "one two three four five six seven", "en", "s", 1), (7, "one two three four five six seven", "en", "s", 1), (8, "One two three four five six seven", "fr", None, 1), (2, "one\ttwo threefour five six seven", None, "s", 1),
    (10, "x", None, None, 1), (-1, "x ", None, None, 2),
]


def words(text):
    return re.findall(r"\w+", (text or "").lower())


def shingle_sets(rows):
    out = {}
    for i, t in rows:
        w = words(t)
        n = min(5, len(w))
        out[i] = frozenset(tuple(w[k : k + n]) for k in range(len(w) - n + 1)) if w else frozenset()
    return out


def near(rows, threshold=0.8):
    """id -> (class, number of links)."""
    sets = shingle_sets(rows)
    parent, links, has = {i: i for i in sets}, Counter(), defaultdict(list)

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, s in sets.items():
        for g in s:
            has[g].append(i)
    for i, s in sets.items():
        for j, n in Counter(j for g in s for j in has[g] if j < i).items():
            if n >= threshold * (len(s) + len(sets[j]) - n) - 1e-9:
                links[i] += 1
                links[j] += 1
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: (find(i), links[i]) for i in sets}


def repeats(rows, length=100):
    """id -> (bytes, removed, spans, digest of the rest)."""
    seen, out = set(), {}
    for i, t in sorted(rows):
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            w = b[p : p + length]
            if w in seen:
                gone[p : p + length] = b"\1" * length
            seen.add(w)
        spans = sum(gone[k] and (k == 0 or not gone[k - 1]) for k in range(len(gone)))
        out[i] = (len(b), sum(gone), spans, hashlib.sha256(bytes(x for x, g in zip(b, gone, strict=True) if not g)).hexdigest())
    return out


def runs_of_13(docs, items):
    """(doc, item) pairs with 13 common words in a row, numbers left out."""
    letters = lambda t: re.findall(r"[^\W\d_]+", (t or "").lower())
    at = defaultdict(set)
    for i, t in items:
        w = letters(t)
        for k in range(len(w) - 12):
            at[tuple(w[k : k + 13])].add(i)
    found = set()
    for d, t in docs:
        w = letters(t)
        for k in range(len(w) - 12):
            found |= {(d, i) for i in at.get(tuple(w[k : k + 13]), ())}
    return found
