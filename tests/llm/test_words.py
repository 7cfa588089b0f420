"""Operators over words: source divergence, collocations, SimHash components; against plain versions and on odd rows."""

import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
import xxhash
from brute import DOCS, ODD

from eventlake.llm import divergence, phrases, registry, simhash
from eventlake.llm.common import mixed
from eventlake.llm.words import Cutter, groups

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
ALPHABET = ["the", "of", "cat", "Cat", "ÉTÉ", "x1y", "--", "a.b", "don't", " ", "end.", "\t", "\n", "日本", "q,", "r"]


def drawn(seed, n, words=30):
    r = random.Random(seed)
    return [(k, " ".join(r.choices(ALPHABET, [9, 7] + [3] * 14, k=r.randrange(words))), r.choice(["en", "de", None]), r.choice(["s", "t", "u", None]), 0) for k in range(n)]


def frame(spark, rows):
    return spark.createDataFrame(rows, DOCS)


def listed(df):
    return sorted(map(str, df.collect()))


def by_sql(name, rows):
    documents = pd.DataFrame(rows, columns=COLUMNS)  # noqa: F841  read by the SQL
    found = duckdb.execute(registry.oracle_sql()[name])
    names = [d[0] for d in found.description]
    return names, sorted(map(str, found.fetchall()))


def check_sql(df, name, rows):
    names, expected = by_sql(name, rows)
    assert sorted(str(tuple(r)) for r in df.select(*names).collect()) == expected


ROWS = {"odd": ODD, "drawn": drawn(1, 300), "none": [], "all null": [(None, None, None, None, None)] * 3, "copies": [(k, "One two three, four one two", "en", "s", 0) for k in range(150)] + drawn(2, 50)}


@pytest.mark.parametrize("kind", ROWS)
def test_divergence_equals_sql(spark, kind):
    check_sql(divergence.divergences(frame(spark, ROWS[kind])), "op11_source_divergence", ROWS[kind])


def test_divergence_over_many_blocks_and_chunks(spark, monkeypatch):
    monkeypatch.setattr(divergence, "BLOCK", 2)
    monkeypatch.setattr(divergence, "CELLS", 4)
    rows = [(k, t, "en", f"s{k % 11}", 0) for k, t, *_ in drawn(3, 200)]
    check_sql(divergence.divergences(frame(spark, rows)), "op11_source_divergence", rows)


def test_shares_are_exact_where_products_pass_64_bits():
    r = random.Random(4)
    counts = [r.randrange(1 << r.randrange(1, 50)) for _ in range(500)]
    over = [c + 1 + r.randrange(1 << 49) for c in counts]
    assert divergence.shares(np.array(counts), np.array(over)).tolist() == [1 + 10**9 * (c + 1) // o for c, o in zip(counts, over, strict=True)]


@pytest.mark.parametrize("kind", ROWS)
def test_collocations_equal_sql(spark, kind):
    check_sql(phrases.collocations(frame(spark, ROWS[kind])), "op12_phrase_collocations", ROWS[kind])


def plain_collocations(rows, least, top):
    counts, n = Counter(), Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            ws = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(ws)
            counts.update((lang, tuple(ws[i : i + k])) for i in range(len(ws)) for k in range(1, 6) if i + k <= len(ws))
    out = defaultdict(list)
    for (lang, p), a in counts.items():
        if len(p) < 2 or a < least:
            continue
        if any(lang == x and b >= a and len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q))) for (x, q), b in counts.items() if b >= least):
            continue
        score, k = min((1000 * a * n[lang] // (counts[lang, p[:k]] * counts[lang, p[k:]]), k) for k in range(1, len(p)))
        out[lang].append((-score, -a, " ".join(p), counts[lang, p[:k]], counts[lang, p[k:]]))
    return sorted((lang, rank, p, -a, left, right, n[lang], -score) for lang, found in out.items() for rank, (score, a, p, left, right) in enumerate(sorted(found)[:top], 1))


@pytest.mark.parametrize(("seed", "hot"), [(5, 1000), (6, 10), (7, 10)])
def test_collocations_of_low_support_equal_a_plain_count(spark, monkeypatch, seed, hot):
    monkeypatch.setattr(phrases, "HOT", hot)  # with few parts, many prefixes are deepened
    rows = drawn(seed, 250)
    found = sorted(map(tuple, phrases.collocations(frame(spark, rows), 4, 50).collect()))
    assert found == plain_collocations(rows, 4, 50)


def test_collocations_stay_right_when_every_filter_is_full(spark, monkeypatch):
    monkeypatch.setattr(phrases, "BITS", 64)
    rows = drawn(8, 150)
    assert sorted(map(tuple, phrases.collocations(frame(spark, rows), 4).collect())) == plain_collocations(rows, 4, 2000)


def plain_prints(rows):
    out = []
    for i, text, *_ in rows:
        w = (text or "").encode().lower().split()
        runs = [b" ".join(w[k : k + 3]) for k in range(len(w) - 2)] if len(w) > 2 else [b" ".join(w)] * bool(w)
        h = [xxhash.xxh64_intdigest(x, 42) for x in runs]
        out.append((i, sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))))
    return out


def plain_components(prints):
    root = list(range(len(prints)))
    for a in range(len(prints)):
        for b in range(a):
            if (prints[a][1] ^ prints[b][1]).bit_count() <= 3 and root[a] != root[b]:
                root = [root[b] if x == root[a] else x for x in root]
    least = defaultdict(lambda: None)
    for (i, _), r in zip(prints, root, strict=True):
        least[r] = i if least[r] is None else min(x for x in (i, least[r]) if x is not None) if i is not None else least[r]
    return sorted(str((i, f"{f:016x}", least[r])) for (i, f), r in zip(prints, root, strict=True))


def near_copies(seed, n):
    r = random.Random(seed)
    base = [[f"w{r.randrange(500)}" for _ in range(r.randrange(60, 400))] for _ in range(8)]
    rows = []
    for k in range(n):
        words = list(r.choice(base))
        for _ in range(r.randrange(3)):
            words[r.randrange(len(words))] = f"v{r.randrange(500)}"
        rows.append((1000 - k, "  ".join(words), "en", "s", 0))
    return rows


@pytest.mark.parametrize("rows", [ODD, [], near_copies(1, 150), [(k, None, None, None, None) for k in range(40)]], ids=["odd", "none", "near", "null"])
def test_simhash_components_equal_all_pairs(spark, rows):
    found = sorted(str(tuple(r)) for r in simhash.near_fingerprints(frame(spark, rows)).collect())
    assert found == plain_components(plain_prints(rows))


def test_large_groups_take_further_views_and_parts(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(simhash, "GROUP", 8)
    r = random.Random(9)
    centres = [r.getrandbits(64) for _ in range(4)]
    prints = {c ^ sum(1 << b for b in r.sample(range(64), r.randrange(4))) for c in centres for _ in range(150)}
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    edges = simhash.forest(spark.createDataFrame([(p,) for p in signed], "fp long").repartition(2), simhash.Scratch(spark, "test"))
    root = {p: p for p in signed}
    for a, b in edges.collect():
        x, y = root[a], root[b]
        root = {k: x if v == y else v for k, v in root.items()}
    expected = {i: c for i, _, c in map(eval, plain_components([(p, p & (1 << 64) - 1) for p in signed]))}
    both = Counter((root[p], expected[p]) for p in signed)
    assert len(both) == len({a for a, _ in both}) == len({b for _, b in both})


def test_gray_index_finds_every_link_and_prunes():
    rng = np.random.default_rng(3)
    x = np.unique(np.concatenate([rng.integers(0, 1 << 63, 500, dtype=np.uint64) * np.uint64(2), *[np.uint64(c) ^ (np.uint64(1) << rng.integers(0, 64, 40, dtype=np.uint64)) for c in rng.integers(0, 1 << 62, 9)]]))
    to = simhash.GrayIndex(x).link()
    expected = plain_components([(k, int(f)) for k, f in enumerate(x)])
    roots = {i: c for i, _, c in map(eval, expected)}
    assert len({(to[k], roots[k]) for k in range(len(x))}) == len(set(to.tolist())) == len(set(roots.values()))


def test_texts_cut_in_slices_have_the_same_fingerprint(monkeypatch):
    text = " ".join(f"Wörd{k % 77}" for k in range(3000)).encode()
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "SLICE", 50)
    assert simhash.fingerprint(text) == whole == simhash.fingerprint(b"\n" + text + b" ")
    assert simhash.fingerprint(b"x" * 300 + b"\t" + b"y") == simhash.fingerprint(b"X" * 300 + b" Y")


def test_cutter_against_a_plain_split():
    texts = [t[1].encode() for t in drawn(11, 60)]
    cut = phrases.CUTTER(texts)
    words = cut.words.to_pylist()
    found = [[] for _ in texts]
    for code, at, opens in zip(cut.code, cut.text, cut.opens, strict=True):
        if opens:
            found[at].append([])
        found[at][-1].append(words[code].decode())
    low = [re.sub("[A-Z]", lambda m: m[0].lower(), t.decode()) for t in texts]
    assert found == [[ws for p in re.split(r"[.,;:!?\x0A-\x0D]", t) if (ws := re.findall(r"[^ \t]+", p))] for t in low]
    with pytest.raises(ValueError):
        Cutter(b" ")
    assert not list(groups(iter([]), ["a"])) and len(set(mixed(np.arange(9, dtype=np.uint64)).tolist())) == 9


@pytest.mark.parametrize("make", [divergence.divergences, phrases.collocations, simhash.near_fingerprints])
def test_extra_columns_change_nothing(spark, make):
    rows = drawn(12, 40)
    df = frame(spark, rows)
    more = df.selectExpr("*", "'z' AS term", "1 AS n", "'q' AS fp", "2 AS row", "3 AS word", "4 AS w0", "5 AS _salt", "6 AS lang_", "7 AS first")
    assert listed(make(df)) == listed(make(more))


def test_a_task_hands_on_portions_of_its_projections():
    n = 4 * phrases.PORTION
    prefixes = pa.array([b"p%d" % (k % 1000) for k in range(n)])
    rows = phrases.by_prefix(pa.array(["en"] * n), prefixes, pa.array([b"r%d" % k for k in range(n)]), np.ones(n, np.int64))
    parts = list(phrases.portions(rows))
    assert pa.Table.from_batches(parts).to_pydict() == pa.Table.from_batches([rows]).to_pydict()
    assert len(parts) >= 4 and max(len(part["rests"].flatten()) for part in parts) <= phrases.PORTION + n // 1000
