"""Extraction, classifiers and decontamination: held-out accuracy, brute force, odd rows."""

import html
import random

import brute
import numpy as np
import pytest
from brute import DOCS, ODD
from pyspark.sql import functions as F

from eventlake.llm import decontaminate, html_extract, quality, toxicity
from eventlake.llm.sample_pages import Page

SF, BIG = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
NO_LABELS = "doc_id long, quality int, toxic int"


def test_blocks_of_malformed_html():
    page = '<title>no</title><script>var t="</p><p>no";</script><nav><li>a<li>b</nav><p class="x y-z">One &amp;&nbsp;\n two<br>three <b>bold<p>Next &lt;p&gt; &#233;</p>tail<!-- <p>no</p> --><img alt="a > b">!<style>no'
    got = [(b.above[-1] if b.above else "", b.text) for b in html_extract.blocks(page)]
    assert got == [("t:li", "a"), ("t:li", "b"), ("n:z", "One & two three bold"), ("t:p", "Next <p> é"), ("", "tail!")]
    assert html_extract.blocks(None) == html_extract.blocks("") == html_extract.blocks("<p> </p>") == []
    assert [b.text for b in html_extract.blocks("no markup < at all")] == ["no markup < at all"]


def test_field_labels_unseen_layouts():
    model = html_extract.default_model()
    wrong = total = 0
    for seed in range(10_000, 10_150):
        page, kept = Page(seed).build()
        found = html_extract.blocks(page)
        assert len(found) == len(kept)
        wrong += sum(a != b for a, b in zip(model.decode(found), kept, strict=True))
        total += len(kept)
    assert wrong < 0.03 * total


def test_viterbi_is_the_best_labelling():
    model = html_extract.default_model()
    r = random.Random(1)
    for seed in range(30):
        page = html_extract.blocks(Page(seed).build()[0])[:6]
        if not page:
            continue
        main, n = html_extract.has_main(page), len(page)
        score = [sum(model.weights.get(f, 0.0) for f in {*html_extract.context(b.above, main), *html_extract.text_features(b, k, n)}) for k, b in enumerate(page)]

        def total(labels, score=score):
            out = model.start[labels[0]] + sum(s for s, y in zip(score, labels, strict=True) if y)
            return out + sum(model.moves[a, b] for a, b in zip(labels, labels[1:], strict=False))

        best = max(total([(m >> k) & 1 for k in range(n)]) for m in range(1 << n))
        assert abs(total([int(x) for x in model.decode(page)]) - best) < 1e-9
    assert r


def test_extraction_over_pages(spark):
    got = html_extract.query(spark, SF).collect()
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    assert len(got) == len(pages) and all(r.n_chars == len(r.text) > 0 for r in got)
    for r in got:
        menu, inside = pages[r.page_id].split("<article>")
        assert r.text.split("\n")[0] in " ".join(html.unescape(inside).split()) and "track(" not in r.text
    df = spark.createDataFrame([(1, "u", None), (None, None, ""), (1, "u", "<article><p>Kept text.</article>"), (2, None, "<nav>Home</nav>"), (3, "u", "<p>" + "x " * 200_000)], "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    odd = html_extract.extract(df).collect()
    assert [(r.page_id, r.text, r.n_chars) for r in odd[:4]] == [(1, "", 0), (None, "", 0), (1, "Kept text.", 10), (2, "", 0)]
    assert odd[4].n_chars in (0, 399_999) and html_extract.extract(df.limit(0)).count() == 0


def held_out_of(spark, df, label):
    labels = {r.doc_id: r[label] for r in spark.read.parquet(f"{BIG}/labels.parquet").collect()}
    return [(r, labels[r.doc_id]) for r in df.collect() if r.doc_id in labels and r.held_out]


def test_quality_on_held_out_labels(spark):
    rows = held_out_of(spark, quality.query(spark, BIG), "quality")
    assert len(rows) > 50
    assert np.mean([r.predicted == y for r, y in rows]) > 0.97
    assert min(r.score for r, y in rows if y) > 0 and all(0 <= r.score <= 1 for r, _ in rows)
    import zlib

    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r, _ in rows)


def test_quality_of_odd_rows_and_without_labels(spark):
    docs = spark.createDataFrame(ODD, DOCS).withColumn("score", F.lit("clash")).withColumn("_score", F.lit(1))
    none = spark.createDataFrame([], NO_LABELS)
    got = quality.classify(docs, none).collect()
    assert len(got) == len(ODD) and {r.score for r in got} == {0.5} and {r.predicted for r in got} == {1}
    some = spark.createDataFrame([(7, 1, 0), (8, 0, 0), (8, None, 1), (None, 1, 1), (99, 1, 0), (9, 0, None), (9, 1, None)], NO_LABELS)
    got = quality.classify(docs, some)
    assert got.count() == len(ODD) and got.where("score IS NULL OR score < 0 OR score > 1").count() == 0
    assert quality.classify(docs.limit(0), some).count() == 0
    kept = quality.stage(spark, docs.unionByName(docs.limit(0)), SF)
    assert kept.columns == docs.columns


def test_toxicity_on_held_out_labels(spark):
    rows = held_out_of(spark, toxicity.query(spark, "/root/testdata/sf0.01"), "toxic")
    caught = [r.toxic for r, y in rows if y]
    assert not any(r.toxic for r, y in rows if not y) and np.mean(caught) > 0.5


def test_toxicity_of_odd_rows_and_one_kind_of_label(spark):
    docs = spark.createDataFrame(ODD, DOCS).withColumn("toxic", F.lit("clash"))
    assert not any(r.toxic for r in toxicity.classify(docs, spark.createDataFrame([], NO_LABELS)).collect())
    assert not any(r.toxic for r in toxicity.classify(docs, spark.createDataFrame([(7, 1, 0), (8, 1, None)], NO_LABELS)).collect())
    mixed = spark.createDataFrame([(k, 1, k % 2) for k in range(11)] + [(None, 1, 1), (3, 1, None), (50, 1, 1)], NO_LABELS)
    got = toxicity.classify(docs, mixed)
    assert got.count() == len(ODD) and toxicity.classify(docs.limit(0), mixed).count() == 0


def test_later_links_read_earlier_probabilities():
    r = np.random.default_rng(1)
    x = (r.random((400, 6)) < 0.2).astype(np.float32)
    a = x[:, 0] > 0
    models = toxicity.train(x, np.column_stack([a, a | (x[:, 1] > 0)]).astype(float), np.arange(400) % 5)
    assert len(models[0][0]) == 6 and len(models[1][0]) == 7
    p = toxicity.Chain([], models).predict(x)
    assert ((p[:, 0] > 0.5) == a).mean() > 0.99 and ((p[:, 1] > 0.5) == (a | (x[:, 1] > 0))).mean() > 0.97


@pytest.mark.parametrize("sf", [SF, BIG])
def test_leaks_equal_runs_of_13_words(spark, sf):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    got = {(r.doc_id, r.item_id) for r in decontaminate.query(spark, sf).collect()}
    assert got == brute.runs_of_13(docs, items) and got


QUESTION = "Anna buys 12 kg of red apples and then sells 5 kg to the old baker near the mill for 30 dollars."


def test_reparameterised_questions_and_slot_consistency(spark):
    items = spark.createDataFrame([(0, QUESTION, "x"), (1, "Seven words only here now", "x"), (2, None, "x"), (3, "To it", "x"), (None, "", "x")], "item_id long, text string, doc_id string")
    again = QUESTION.replace("Anna", "Berta").replace("12", "99").replace("5 kg", "7 kg").replace("30", "44")
    same = QUESTION.replace("12", "8").replace("5 kg", "8 kg").replace("30", "8")
    docs = spark.createDataFrame(
        [(0, "before. So " + again + " and after", 1), (1, "before. So " + same, 1), (2, "aha! Seven words only here now and more", 1), (3, None, 1), (4, "", 1), (None, QUESTION, 1), (5, QUESTION, 1), (5, QUESTION, 1), (6, "to it " * 9, 1), (7, "word " * 50_000 + QUESTION.upper(), 1)], "doc_id long, text string, item_id int")
    got = {r.doc_id: r for r in decontaminate.contaminated(docs, items).collect()}
    assert set(got) == {0, 1, 2, None, 5, 7}
    assert got[0].reparameterised and not got[5].reparameterised and got[5].coverage == 1.0
    assert not got[1].reparameterised and got[1].n_matched == 15  # inconsistent values don't count
    assert got[2].item_id == 1
    assert decontaminate.contaminated(docs.limit(0), items).count() == 0 and decontaminate.contaminated(docs, items.limit(0)).count() == 0


def test_decontamination_without_broadcast(spark, monkeypatch):
    expected = {(r.doc_id, r.item_id) for r in decontaminate.query(spark, SF).collect()}
    monkeypatch.setattr(decontaminate, "MAX_BROADCAST", 0)
    assert {(r.doc_id, r.item_id) for r in decontaminate.query(spark, SF).collect()} == expected


def test_abusive_stems_are_learned_and_clean_texts_left_alone(spark):
    r = random.Random(7)
    vocabulary = ["".join(r.choices("aeinorst", k=r.randint(2, 8))) for _ in range(2500)]
    common = vocabulary[:60]

    def text(k, bad):
        words = r.choices(common, k=r.randint(5, 40)) + r.choices(vocabulary, k=r.randint(5, 200))
        if bad:
            for _ in range(r.randint(1, 3)):
                words.insert(r.randrange(len(words)), r.choice(["idiot", "worthless", "gruzk" + r.choice(vocabulary), "plim" + r.choice(vocabulary)]))
        return " ".join(words)

    rows = [(k, text(k, k % 9 == 0)) for k in range(1800)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, 1, int(k % 9 == 0)) for k in range(1800)], NO_LABELS)
    got = toxicity.classify(docs, labels).where("held_out").collect()
    assert np.mean([x.toxic for x in got if x.doc_id % 9 == 0]) > 0.95
    assert np.mean([x.toxic for x in got if x.doc_id % 9]) < 0.01
