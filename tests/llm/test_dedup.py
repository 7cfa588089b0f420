"""Exact, near and substring deduplication, and sharding, against brute force."""

import hashlib
import random
import re
import time
import zlib
from collections import Counter, defaultdict

import brute
import pandas as pd
import pytest
from brute import DOCS, ODD
from pyspark.sql import functions as F

from eventlake.llm import exact_dedup, near_dedup, repeats, sharding
from eventlake.llm.common import Scratch, clean_scratch, components, join_groups

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def real(spark):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]


def odd(spark):
    df = spark.createDataFrame(ODD, DOCS)
    for name in ("key", "row", "name", "h", "size", "_mid", "class", "text_sha256", "kept"):
        df = df.withColumn(name, df.lang)  # columns that operators use inside
    return df


def test_exact_groups_of_odd_rows(spark):
    got = exact_dedup.exact_duplicates(odd(spark)).collect()
    assert len(got) == len(ODD)
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]", "", t or "")
    groups = defaultdict(list)
    for r in ODD:
        groups[norm(r[1])].append(r)
    for r in got:
        members = next(m for m in groups.values() if hashlib.sha256(norm(m[0][1]).encode()).hexdigest() == r.text_sha256)
        best = min(members, key=lambda m: (-len(m[1] or ""), m[0] is None, m[0]))
        assert (r.group_size, r.keep_id) == (len(members), best[0])
    kept = Counter(r.text_sha256 for r in got if r.kept)
    assert set(kept.values()) == {1} and len(kept) == len(groups)


@pytest.mark.parametrize("block", [1, 2, 3, 7])
def test_identities_don_t_depend_on_the_block_size(spark, block):
    texts = ["", "a", "ab", "abab", "ababab", "abababa", "ba" * 5, "ab" * 5, "é" * 9, "é" * 10, None, "ab" * 5]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    ids = {r.doc_id: (r.level, r.name) for r in exact_dedup.identities(df, Scratch(spark, "t"), block).collect()}
    for i, a in enumerate(texts):
        for j, b in enumerate(texts):
            assert (ids[i] == ids[j]) == ((a or "") == (b or "")), (a, b)


def test_exact_stage_keeps_one_row_of_each_and_null_ids(spark):
    df = odd(spark)
    kept = exact_dedup.stage(spark, df, SF)
    assert kept.columns == df.columns
    assert sorted((r.doc_id is None, r.doc_id) for r in kept.collect()) == [(False, -1), (False, 4), (False, 7), (False, 8), (False, 9), (True, None)]


def test_near_duplicates_equal_brute_force(spark, real):
    rows = real[:120] + [(1000 + k, t.replace(" the ", " that ", 1)) for k, (_, t) in enumerate(real[:60])]
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: (r.class_id, r.n_links) for r in got} == brute.near(rows)
    assert all(r.kept == (r.doc_id == r.class_id) for r in got)


def test_a_large_group_of_near_copies_is_compared_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 7)
    r = random.Random(1)
    base = [f"w{k}" for k in range(60)]
    rows = [(k, " ".join(x if r.random() > 0.012 else f"n{r.random()}" for x in base)) for k in range(60)] + [(99, "quite another text of some words")]
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {x.doc_id: (x.class_id, x.n_links) for x in got} == brute.near(rows)


def test_crowded_prefixes_of_texts_that_differ(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 6)
    r = random.Random(2)
    shared = [f"s{k}" for k in range(90)]
    # two thirds of the shingles are common to all, which crowds prefixes; few pairs are similar
    rows = [(k, " ".join(shared + [f"o{k}x{i}" for i in range(45)])) for k in range(80)]
    rows += [(100 + k, t.replace(f"o{k}x{r.randint(5, 40)}", "changed")) for k, t in rows[:30]]
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {x.doc_id: (x.class_id, x.n_links) for x in got} == brute.near(rows)


def test_recall_of_pairs_at_the_threshold(spark):
    r = random.Random(5)
    rows = []
    for k in range(400):
        words = [f"p{k}w{i}" for i in range(r.randint(60, 200))]
        cut = round(len(words) * r.uniform(0.15, 0.2) / 2)  # the ends differ: similarity is 0.8 to 0.85 or just below 0.8
        rows += [(2 * k, " ".join(words + [f"a{k}x{i}" for i in range(cut)])), (2 * k + 1, " ".join(words + [f"b{k}x{i}" for i in range(cut)]))]
    expected = brute.near(rows)
    pairs = sum(n for _, n in expected.values())
    got = {x.doc_id: (x.class_id, x.n_links) for x in near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert pairs > 300 and sum(n for _, n in got.values()) >= 0.995 * pairs
    assert all(n <= expected[d][1] for d, (_, n) in got.items())


def test_a_repeated_id_doesn_t_keep_a_copy(spark):
    a, b = "one two three four five six seven", "quite another text with other words in it"
    df = spark.createDataFrame([(1, a, "x"), (7, a, "y"), (7, b, "z"), (None, b, "n"), (None, "third " * 9, "m")], "doc_id long, text string, key string")
    got = near_dedup.stage(spark, df, SF)
    assert got.columns == df.columns and {r.key for r in got.collect()} in ({"x", "n", "m"}, {"x", "z", "m"})


def test_near_odd_rows_and_depths(spark):
    got = sorted((str(r.doc_id), r.n_links, r.class_size) for r in near_dedup.near_duplicates(odd(spark)).collect())
    assert got == sorted([("5", 0, 1), ("3", 0, 1), ("4", 0, 1), ("None", 0, 1), ("9", 0, 1), ("7", 2, 3), ("7", 2, 3), ("8", 2, 3), ("2", 0, 1), ("10", 1, 2), ("-1", 1, 2)])
    assert near_dedup.near_duplicates(odd(spark).limit(0)).count() == 0
    assert near_dedup.stage(spark, odd(spark), SF).columns == odd(spark).columns
    assert near_dedup.prefix_depth(0.8, 0.9999) == 6 and near_dedup.prefix_depth(0.8, 0.9) == 8 and near_dedup.prefix_depth(0.2, 0.9999) == 1


def test_components_where_hubs_are_dealt_out(spark, monkeypatch):
    monkeypatch.setattr("eventlake.llm.common.HUB", 0)  # as for over a million edges
    stars = [(0, k) for k in range(1, 300)] + [(k, 2000) for k in range(1000, 1300)]  # a least and a greatest hub
    edges = [*stars, *[(k, k + 1) for k in range(5000, 5030)], (7, 7), (2000, 1000)]
    got = {r.id: r.root for r in components(Scratch(spark, "t"), spark.createDataFrame(edges, "a long, b long"), "c").collect()}
    want = {**{k: 0 for k in range(1, 300)}, **{k: 1000 for k in [*range(1001, 1300), 2000]}, **{k: 5000 for k in range(5001, 5031)}}
    assert {k: v for k, v in got.items() if k != v} == want


def test_components_of_paths_and_stars(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 130)] + [(7, 7), (200, 199), (199, 200)]
    got = {r.id: r.root for r in components(Scratch(spark, "t"), spark.createDataFrame(edges, "a long, b long"), "c").collect() if r.id != r.root}
    assert got == {**{k: 0 for k in range(1, 41)}, **{k: 100 for k in range(101, 130)}, 200: 199}


@pytest.mark.parametrize("seed", [1, 2])
def test_repeated_strings_equal_brute_force(spark, seed):
    r = random.Random(seed)
    base = "".join(r.choice("abcdé ") for _ in range(1500))
    rows = []
    for i in range(30):
        t = ""
        for _ in range(r.randint(0, 5)):
            a = r.randint(0, 1400)
            t += base[a : a + r.randint(20, 400)] + "".join(r.choice("xyz") for _ in range(r.choice([0, 0, 3, 50])))
        rows.append((i, t))
    rows += [(100, "a" * 500), (101, "ab" * 300), (102, None), (103, ""), (104, "a" * 99), (105, "a" * 100), (106, "abc" * 100 + "x" + "abc" * 100), (-4, base[50:300])]
    got = {x.doc_id: (x.n_bytes, x.n_removed, x.n_spans, x.kept_sha256) for x in repeats.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute.repeats(rows)


def test_large_groups_are_dealt_to_several_tasks(spark, monkeypatch):
    r = random.Random(4)
    some = lambda n: "".join(r.choice("abcdefghij") for _ in range(n))
    passage = some(160)
    rows = [(k, some(r.randint(0, 90)) + passage[r.randint(0, 9) :] + some(r.randint(0, 90))) for k in range(80)]
    monkeypatch.setattr(repeats, "GROUP", 3)
    got = {x.doc_id: (x.n_bytes, x.n_removed, x.n_spans, x.kept_sha256) for x in repeats.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute.repeats(rows)


def test_groups_in_pieces_are_refined_as_whole_ones(spark, monkeypatch):
    columns = ["h", "run", "context", "key", "start", "n", "place", "done"]
    rows = pd.DataFrame([(h, run, 5, key, 0, 3, 1, False) for h in (1, 2, 3) for run in (7, 7, 7, 8)[: 4 if h < 3 else 3] for key in (1,)], columns=columns)
    rows["key"] = range(len(rows))
    batches = lambda n: iter([rows.iloc[k : k + n] for k in range(0, len(rows), n)])
    whole = pd.concat(list(repeats.refine_runs(batches(100))))
    monkeypatch.setattr(repeats, "GROUP", 0)
    pieces = pd.concat(list(repeats.refine_runs(batches(1))))
    assert set(whole.loc[whole.place < 0, "key"]) == set(pieces.loc[pieces.place < 0, "key"]) == {1, 2, 5, 6, 9, 10}
    assert set(whole.loc[whole.place >= 0, "key"]) == {0, 3, 4, 7} <= set(pieces.loc[pieces.place >= 0, "key"])


def test_repeats_in_pieces_of_a_long_text(spark, monkeypatch):
    r = random.Random(3)
    text = "".join(r.choice("abcdefgh") for _ in range(900))
    rows = [(1, text), (2, "q" + text[100:700] + "z" + text[300:]), (3, text)]
    batch = pd.DataFrame({"key": [x[0] for x in rows], "text": [x[1] for x in rows]})
    monkeypatch.setattr(repeats, "CHUNK", 128)
    small = pd.concat(list(repeats.emit_runs(iter([batch]))))
    assert small["n"].sum() == sum(len(x[1]) - 99 for x in rows)  # every window once, whatever the pieces
    assert len(small[~small["done"]]) > 0


def test_repeats_of_odd_rows(spark):
    got = repeats.remove_repeats(odd(spark)).collect()
    assert len(got) == len(ODD)
    long = next(r for r in got if r.doc_id == 9)
    # five-byte words: all but the first window of each phase goes
    assert (long.n_bytes, long.n_spans, long.n_bytes - long.n_removed) == (150_002, 1, 7)
    assert repeats.remove_repeats(odd(spark).limit(0)).count() == 0


def test_real_documents(spark, real):
    got = {x.doc_id: (x.n_bytes, x.n_removed, x.n_spans, x.kept_sha256) for x in repeats.query(spark, SF).collect()}
    assert got == brute.repeats(real)


@pytest.mark.parametrize("n", [1, 2, 3, 5, 100, 257])
def test_permutation_is_one(spark, n):
    p = [r[0] for r in spark.range(n).select(sharding.permute(F.col("id"), n, 3)).collect()]
    assert sorted(p) == list(range(n)) and (n < 100 or p != sorted(p))


def test_shards_are_even_gapless_and_reproducible(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    a = sharding.shard_rows(docs).collect()
    b = sharding.shard_rows(docs.repartition(7)).collect()
    assert {(r.doc_id, r.shard, r.slot) for r in a} == {(r.doc_id, r.shard, r.slot) for r in b}
    slots = defaultdict(list)
    for r in a:
        slots[r.shard].append(r.slot)
    assert set(slots) == set(range(16)) and max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert all(r.size == len(texts[r.doc_id].encode()) + 1 and r.text_crc32 == zlib.crc32(texts[r.doc_id].encode()) and r.law == "rows" and r.grown_shard is None for r in a)


def test_shards_of_odd_rows(spark):
    got = sharding.shard_rows(odd(spark)).collect()
    assert len(got) == len(ODD) and sorted((r.shard, r.slot) for r in got) == [(k, 0) for k in range(len(ODD))]
    assert next(r for r in got if r.doc_id == 5)[1:3] == (1, 0)
    assert sharding.shard_rows(odd(spark).limit(0)).count() == 0


def test_scratch_tables_can_be_deleted(spark):
    from pathlib import Path

    scratch = Scratch(spark, "gone")
    assert scratch.keep(spark.range(3), "t").count() == 3
    at = Path(scratch.root.removeprefix("file://"))
    assert at.exists() and clean_scratch(spark) > 0 and not at.exists()


def test_long_texts_are_cut_in_linear_time(spark):
    text = "".join(f"w{k} " for k in range(700_000))
    df = spark.createDataFrame([(1, text), (2, text + " "), (3, text[:-3]), (4, "x")], "doc_id long, text string")
    began = time.monotonic()
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in exact_dedup.exact_duplicates(df).collect()}
    assert got == {1: (2, 2, False), 2: (2, 2, True), 3: (3, 1, True), 4: (4, 1, True)}
    assert time.monotonic() - began < 120  # a walk to each block from the text's start takes far longer


def test_rows_of_hot_groups_are_dealt_to_many_tasks(spark):
    rows = spark.range(30_000).select(F.col("id"), F.when(F.col("id") < 10_000, 7).otherwise(F.col("id")).alias("g"))
    groups = rows.groupBy("g").agg(F.count("*").alias("n"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = join_groups(rows, groups, ["g"], "n", 30_000, "id")
        sizes = [r[1] for r in out.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 30_000 == out.distinct().count() and max(sizes) < 1.5 * 30_000 / 4
        assert out.where("g = 7").select("n").distinct().collect() == [(10_000,)]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
