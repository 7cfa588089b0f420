"""Ids beside nulls, and columns with names that operators use themselves, come through every operator and stage as they are."""

import pytest

from eventlake.llm import decontaminate, exact_dedup, html_extract, near_dedup, quality, repeats, sentence_pieces, sharding, simhash, token_counts, toxicity

SF = "/root/testdata/sf0.001"
IDS = [None, 2**60 + 1, 2**60 + 2, -(2**60) - 3, -7]
TEXTS = ["first text of some words here", "second text, which has other words", "a third one of its own", None, "the fifth and last text of these"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", "s", 0, -3, f"t{k}", k, f"key{k}") for k, (i, t) in enumerate(zip(IDS, TEXTS, strict=True))]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, _n long, _t string, _row long, key string").coalesce(1)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet").join(spark.read.parquet(f"{SF}/documents.parquet"), "doc_id").selectExpr("doc_id", "text", "quality", "toxic")


def ids(df, column="doc_id"):
    return sorted((r[0] for r in df.select(column).collect()), key=str)


def test_ids_come_through_operators(spark, docs, labels, tmp_path):
    expected = sorted(IDS, key=str)
    learnt = docs.unionByName(labels.selectExpr("doc_id", "text", "'en' AS lang", "'s' AS source", "0L AS n_chars", "0L AS _n", "'' AS _t", "0L AS _row", "'' AS key")).coalesce(1)
    scores = {"toxicity": toxicity.classify(learnt, labels), "quality": quality.classify(learnt, labels)}
    known = set(ids(labels))
    for name, df in scores.items():
        assert [i for i in ids(df) if i not in known] == expected, name
    pages = docs.selectExpr("doc_id AS page_id", "key AS url", "concat('<article><p>', text, '</p></article>') AS html", "_n", "_row AS text")
    found = html_extract.extract(pages)
    assert ids(found, "page_id") == expected and {r.url: r.page_id for r in found.collect()} == {f"key{k}": i for k, i in enumerate(IDS)}
    encoded = sentence_pieces.encode(docs)
    assert {(r.doc_id, r.text) for r in sentence_pieces.decode(encoded).collect()} == {(i, t or "") for i, t in zip(IDS, TEXTS, strict=True)}
    for df in (encoded, near_dedup.near_duplicates(docs), repeats.remove_repeats(docs), token_counts.count_tokens(docs, f"file://{tmp_path}/cache"), exact_dedup.exact_duplicates(docs), sharding.shard_rows(docs), simhash.near_fingerprints(docs)):
        assert ids(df) == expected


@pytest.mark.parametrize("stage", [exact_dedup.stage, near_dedup.stage, decontaminate.stage])
def test_stages_keep_rows_and_columns_as_they_are(spark, docs, stage):
    twice = docs.unionByName(docs.where("_row = 1")).coalesce(1)  # a repeated row
    out = stage(spark, twice, SF)
    assert out.columns == docs.columns
    expected = sorted(map(str, (docs if stage is not decontaminate.stage else twice).collect()))
    assert sorted(map(str, out.collect())) == expected
