"""Context sums equal a plain count, and forms, which are few, cost one count a pair."""

import random

import numpy as np
import pandas as pd

from eventlake.llm import quality
from eventlake.llm.quality import DIMS, FORMS, REACH, ROWS, SPARSE, WORDS

TEXTS = ["The cat, the CAT the the\n\n12 a1B", None, "", "one", "Two words", *[" ".join(random.Random(k).choices(["a", "B", "cc", "Dd", "9", "x1", "é", "!"], k=40)) for k in range(60)]]


def contexts(texts):
    total = np.zeros((ROWS, DIMS + 1))
    for one in quality.add_contexts(pd.DataFrame({"text": texts[k : k + 20]}) for k in range(0, len(texts), 20)):
        for slab, sums in zip(one["slab"], one["sums"], strict=True):
            total[slab * quality.SLAB : (slab + 1) * quality.SLAB] += np.frombuffer(sums, "<f8").reshape(-1, DIMS + 1)
    return total


def test_contexts_equal_a_plain_count():
    expected, (place, sign), known = np.zeros((ROWS, DIMS + 1)), quality.index_vectors(), quality.TokenRows()
    for text in TEXTS:
        for rows in quality.tokens([text], known)[:2]:
            for k, row in enumerate(rows):
                expected[row, DIMS] += 1
                for other in [*rows[max(0, k - REACH) : k], *rows[k + 1 : k + 1 + REACH]]:
                    for j in range(SPARSE):
                        expected[row, place[other, j]] += sign[other, j]
    assert expected[WORDS:].any() and np.array_equal(contexts(TEXTS), expected)
    assert not contexts([None, ""]).any() and not contexts([]).any()


def test_pairs_of_forms_are_counted_once(monkeypatch):
    counted, bincount = [], np.bincount
    monkeypatch.setattr(np, "bincount", lambda x, *a, **k: counted.append(len(x)) or bincount(x, *a, **k))
    total = contexts(TEXTS)
    n = total[WORDS:, DIMS].sum()
    assert sum(counted) <= n * (2 * REACH * SPARSE + REACH + 2)


def test_shapes_are_as_they_were():
    def plain(token):
        cases = (token.islower(), token[:1].isupper() and not token[1:].upper() == token[1:] or len(token) == 1 and token.isupper(), token.isupper(), token.isdigit(), any(c.isdigit() for c in token))
        kind = cases.index(True) if True in cases else len(cases)
        return f"{kind}{'' if token.isascii() else '+'}:{min(len(token), 16)}"

    r = random.Random(3)
    for _ in range(5000):
        token = "".join(r.choices("aBéÉß1²٣_日ǅIİ", k=r.randint(1, 20)))
        for found in quality.TOKEN.findall(token):
            if found[0].isalnum() or found[0] == "_":
                assert quality.shape(found) == plain(found), found
    assert FORMS // 4 > quality.shape_row("0:4") == quality.shape_row("0:4") >= 0
