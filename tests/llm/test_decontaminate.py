"""Decontamination of slot-rich, edited and short items, at all places of a document."""

import random
from collections import defaultdict

import pytest

from eventlake.llm import decontaminate

SLOTS = ["Anna has 5 kg of apples and Bob has 3 kg of pears, how many kg?", "If Maria buys 3 pens at 2 dollars and 5 books at 7 dollars, what does Maria pay?"]


def found(spark, docs, items):
    docs = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    items = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    return {(r.doc_id, r.item_id): r for r in decontaminate.contaminated(docs, items).collect()}


@pytest.mark.parametrize("change", [lambda t: t, lambda t: t.replace("5", "8").replace("3", "6")])
def test_slot_rich_items_are_found_at_every_place(spark, change):
    docs = ["filler " * k + ". " + change(t) + " the end of it all" for t in SLOTS for k in range(8)]
    assert set(found(spark, docs, SLOTS)) == {(8 * i + k, i) for i in range(2) for k in range(8)}


def agreeing(doc, item):
    """Most tokens that agree along any alignment of two texts without slots."""
    d, w = doc.lower().split(), item.lower().split()
    return max(sum(0 <= j + s < len(d) and d[j + s] == w[j] for j in range(len(w))) for s in range(-len(w), len(d)))


def test_edited_copies_equal_all_alignments(spark):
    r = random.Random(3)
    vocabulary = ["".join(r.choices("aeinorst", k=4)) + "y" for _ in range(300)]
    items = [" ".join(r.choices(vocabulary, k=n)) for n in (5, 8, 12, 13, 20, 31, 47)]
    docs = []
    for item in items:
        for every in (2, 3, 4, 5, 6, 7, 8, 9, 10, 12):
            for k in range(8):
                copy = ["edited" if j % every == every - 1 else t for j, t in enumerate(item.split())]
                docs.append(" ".join(["filler"] * k + copy + r.choices(vocabulary, k=30)))
    docs += [" ".join(r.choice([t, "edited"]) for t in item.split()) for item in items for _ in range(30)]
    expected = {(d, i): n for d, doc in enumerate(docs) for i, item in enumerate(items) if (n := agreeing(doc, item)) >= max(4, len(item.split()) / 2)}
    got = found(spark, docs, items)
    assert expected and {k: x.n_matched for k, x in got.items()} == expected


def test_short_items_with_an_edit_after_other_words_and_in_unspaced_scripts(spark):
    items = ["What is the capital of France today", "水の都と呼ばれる街はどこですか", "ประเทศไทยมีกี่จังหวัด", "Who wrote Faust"]
    same = ["He asked what is the capital of France today", *[f"He {x} What is the capital of France today" for x in ("asked", "asked,", 'said "', "said (")]]
    edited = ["He asked, What is the capital of France now", "What was the capital of France today"]
    docs = [*same, *edited, "問題:水の都と呼ばれる町はどこですか。", "ถามว่าประเทศไทยมีกี่จังหวัดครับ", "Capital is a word and France another"]
    got = found(spark, docs, items)
    assert set(got) == {*[(k, 0) for k in range(7)], (7, 1), (8, 2)}
    assert all(got[k, 0].coverage == 1.0 for k in range(5)) and got[5, 0].n_matched == 6 and got[7, 1].n_matched == 14


def test_rows_that_repeat_an_item_id_are_items_of_their_own(spark):
    docs = spark.createDataFrame([(1, "so it goes: seven brave words stand here alone")], "doc_id long, text string")
    items = spark.createDataFrame([(None, "other things nobody wrote down anywhere"), (None, "seven brave words stand here")], "item_id long, text string")
    assert [(r.item_id, r.coverage) for r in decontaminate.contaminated(docs, items).collect()] == [(None, 1.0)]


def test_problems_asked_again_and_items_of_numbers(spark):
    items = ["Tom has 3 apples. Ann has 5 apples. How many apples do Tom and Ann have?", "Compute 12 + 45 * 3 - 7 / 2 then add 9 to it"]
    docs = ["so: Max has 9 apples. Eva has 6 apples. How many apples do Max and Eva have? well", "now Compute 12 + 45 * 3 - 7 / 2 then add 9 to it please", "Max has 9 pears and 6 nuts."]
    got = found(spark, docs, items)
    assert set(got) == {(0, 0), (1, 1)} and got[0, 0].reparameterised and not got[1, 1].reparameterised


def test_an_edited_passage_is_found_at_all_offsets(spark):
    item = " ".join(f"word{chr(97 + k)}" for k in range(24))
    copy = item.replace("wordh", "other").replace("wordq", "again")
    got = found(spark, ["pad " * k + copy + " end" for k in range(16)], [item])
    assert {k: x.n_matched for k, x in got.items()} == {(k, 0): 22 for k in range(16)}


def test_pairs_equal_all_alignments_of_the_rule(spark):
    """Every alignment of the canonical tokens of every document and item, judged in plain Python."""
    sf = "/root/testdata/sf0.001"
    docs, items = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "benchmark"))
    read = decontaminate.with_templates(docs.select("doc_id", "text"), written=True).collect()
    asked = decontaminate.with_forms(items.select("item_id", "text")).collect()
    expected = {}
    for item in asked:
        for form in item.forms:
            at = defaultdict(list)
            for j, t in enumerate(form):
                at[t].append(j)
            for d in read:
                agreeing = defaultdict(list)
                for k, t in enumerate(d.c):
                    for j in at.get(t, ()):
                        agreeing[k - j].append(j)
                for shift, same in agreeing.items():
                    slots = {(item.w[j], d.w[j + shift]) for j in same if form[j].startswith("#")}
                    fits = len(slots) == len({a for a, _ in slots}) == len({b for _, b in slots})
                    good = {j for j in same if fits or not form[j].startswith("#")}
                    run = any(all(j + i in good for i in range(decontaminate.RUN)) for j in good)
                    if run or len(good) >= max(4, len(form) / 2):
                        key = (d.doc_id, item.item_id)
                        expected[key] = max(expected.get(key, 0), len(good))
    got = {(r.doc_id, r.item_id): r.n_matched for r in decontaminate.query(spark, sf).collect()}
    assert expected and got == expected


def test_a_clean_row_that_shares_its_id_with_a_leaking_one_stays(spark):
    item = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").where("length(text) > 100").first().text
    df = spark.createDataFrame([(1, "clean text", "a"), (1, item, "b"), (None, item, "c"), (None, None, "d"), (2, "", "e")], "doc_id long, text string, key string")
    got = decontaminate.stage(spark, df, "/root/testdata/sf0.001")
    assert got.columns == df.columns and {r.key for r in got.collect()} == {"a", "d", "e"}
    assert decontaminate.stage(spark, df.limit(0), "/root/testdata/sf0.001").count() == 0
