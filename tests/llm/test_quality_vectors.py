"""The quality score comes from pooled vectors alone, and holds on rows that were held out."""

import numpy as np
import pandas as pd

from eventlake.llm import quality

SF = "/root/testdata/sf0.1"


def test_vectors_alone_tell_held_out_rows_apart(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    model = quality.fit(docs, labels)
    assert model.layers[0].shape[0] == quality.POOLS * quality.DIMS  # nothing else goes in
    assert 0.26 < model.temperature < 7.9  # inside its grid
    held = docs.join(labels.where("quality IS NOT NULL").groupBy("doc_id").agg({"quality": "max"}).withColumnRenamed("max(quality)", "quality"), "doc_id")
    held = held.where(quality.held_out(held["doc_id"]))
    found = quality.scored(held.select("doc_id", "text", "quality"), model, ["doc_id", "quality"]).toPandas()
    good, score = found["quality"].to_numpy() > 0, found["score"].to_numpy()
    rank = pd.Series(score).rank().to_numpy()
    auc = (rank[good].sum() - good.sum() * (good.sum() + 1) / 2) / (good.sum() * (~good).sum())
    assert len(found) > 500 and auc > 0.999
    assert (score[~good] >= quality.THRESHOLD).mean() < 0.02 and (score[good] < quality.THRESHOLD).mean() < 0.01


def test_tokens_forms_and_pools():
    assert [quality.shape(t) for t in ("word", "Word", "WORD", "12", "a1B", "wOrd", "É", "!", "\n\n\n", "_")] == ["0:4", "1:4", "2:4", "3:2", "4:3", "5:4", "1+:1", "!", "\n\n", "5:1"]
    known = quality.TokenRows()
    texts = ["the cat the the", None, "", "The end", "cat"]
    words, forms, ends = quality.tokens(texts, known)
    assert ends.tolist() == [4, 4, 4, 6, 7] and words[0] == words[2] == words[3] == words[4] and words[1] == words[6]
    assert ((forms - quality.WORDS) % 4).tolist() == [0, 0, 1, 2, 0, 0, 0] and forms[0] != forms[4]
    vectors = np.random.default_rng(1).normal(size=(quality.ROWS, quality.DIMS)).astype(np.float32)
    x = quality.features(texts, vectors, known)
    assert not x[1].any() and not x[2].any()
    own = vectors[forms[:4]].astype(float)
    assert np.allclose(x[0], np.concatenate([vectors[words[:4]].mean(0), own.mean(0), own.std(0)]), atol=1e-5)
    assert np.allclose(quality.features(["the cat the the"], vectors, quality.TokenRows())[0], x[0])
