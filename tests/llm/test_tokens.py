"""SentencePiece on the tokenizers backend, token counts, and the pipeline."""

import hashlib
import struct

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from brute import DOCS, ODD, near, runs_of_13

import corpus_pipeline
from eventlake.llm import exact_dedup, piece_model, quality, sentence_pieces, token_counts

SF = "/root/testdata/sf0.001"
MODEL = public_tokenizers.path("piece_bpe_32k.model")
HARD = ["", " ", "  two  spaces ", "tab\tand\nnewline", "<s> </s> <unk> <0x0A>", "日本語 と émojis 🙂🙃", "▁▁ marks▁inside", "a" * 3000, "\u0000 ​﻿", "ﬁ ﬂ ①", "0123456789 1,000.5", "x" + " " * 70 + "y"]


def test_ids_and_text_equal_the_library(spark):
    ref = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    texts = HARD + [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = sentence_pieces.encode(df, parity_one_in=1)
    got = {r.doc_id: r for r in out.collect()}
    expected = ref.encode(texts)
    for k, ids in enumerate(expected):
        assert got[k].ids == ids and got[k].n_tokens == len(ids) and got[k].parity and got[k].round_trip == ("▁" not in texts[k]), texts[k][:50]
        assert got[k].ids_sha256 == hashlib.sha256(np.array(ids, "<i4").tobytes()).hexdigest()
    back = {r.doc_id: r.text for r in sentence_pieces.decode(out).collect()}
    assert back == {k: t.replace("▁", " ") for k, t in enumerate(texts)}


def varint(n):
    out = b""
    while n > 127:
        out, n = out + bytes([n & 127 | 128]), n >> 7
    return out + bytes([n])


def message(*fields):
    """Protobuf of (number, value) pairs: bytes, int or float."""
    out = b""
    for number, value in fields:
        if isinstance(value, bytes):
            out += varint(number << 3 | 2) + varint(len(value)) + value
        elif isinstance(value, float):
            out += varint(number << 3 | 5) + struct.pack("<f", value)
        else:
            out += varint(number << 3) + varint(value)
    return out


def test_a_unigram_model_is_rebuilt(tmp_path):
    pieces = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3), *[(f"<0x{b:02X}>", -20.0, 6) for b in range(256)], ("▁", -3.0, 1), ("▁ab", -2.5, 1), ("ab", -2.7, 1), ("a", -4.0, 1), ("b", -4.1, 1), ("▁abc", -9.0, 1), ("c", -4.2, 1), ("bc", -2.9, 1)]
    data = b"".join(message((1, message((1, p.encode()), (2, s), (3, kind)))) for p, s, kind in pieces)
    data += message((2, message((3, piece_model.UNIGRAM), (35, 1))), (3, message((1, b"identity"), (3, 1), (4, 0), (5, 1))))
    path = tmp_path / "uni.model"
    path.write_bytes(data)
    ref = sentencepiece.SentencePieceProcessor(model_file=str(path))
    tok = piece_model.load(str(path))
    for text in ("abc ab", "aabbcc", "abz é", "ab  c", ""):
        assert tok.encode(text, add_special_tokens=False).ids == ref.encode(text), text


def test_encoding_of_odd_rows(spark):
    docs = spark.createDataFrame(ODD, DOCS).withColumnRenamed("lang", "ids").withColumnRenamed("source", "parity")
    got = sentence_pieces.encode(docs, keep_ids=False).collect()
    assert len(got) == len(ODD) and all(r.round_trip or r.doc_id == 5 for r in got)
    assert sentence_pieces.encode(docs.limit(0)).count() == 0


@pytest.mark.parametrize("name", ["piece_bpe_32k.model", "byte_bpe_50k.json"])
def test_counts_through_the_cache(spark, tmp_path, name):
    path, cache = public_tokenizers.path(name), f"file://{tmp_path}/cache"
    docs = spark.createDataFrame(ODD, DOCS).withColumnRenamed("lang", "digest").withColumnRenamed("source", "n_tokens")
    count = token_counts.counter(path)
    expected = sorted((str(r[0]), len((r[1] or "").encode()), count([r[1] or ""])[0]) for r in ODD)
    first = token_counts.count_tokens(docs, cache, path).collect()
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in first) == expected and all(r.over_limit == (r.n_tokens > 4096) for r in first)
    folder = f"{cache}/tokenizer={token_counts.version_digest(path)}"
    stored = spark.read.parquet(folder)
    assert stored.count() == stored.select("digest").distinct().count() == len({r[1] or "" for r in ODD})
    # a second run encodes only what is new
    more = docs.select("doc_id", "text").union(spark.createDataFrame([(77, "something new")], "doc_id long, text string"))
    again = token_counts.count_tokens(more, cache, path).collect()
    assert len(again) == len(ODD) + 1 and spark.read.parquet(folder).select("digest").distinct().count() == len({r[1] or "" for r in ODD}) + 1
    assert token_counts.count_tokens(docs.limit(0), f"file://{tmp_path}/empty", path).count() == 0


def test_versions_have_caches_of_their_own():
    a, b = (token_counts.version_digest(public_tokenizers.path(n)) for n in ("piece_bpe_32k.model", "byte_bpe_50k.json"))
    assert a != b


def test_pipeline_equals_brute_force(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    good = {r.doc_id for r in quality.query(spark, SF).where("predicted = 1").collect()}
    best = {}
    for i in sorted(good):
        key = "".join(docs[i].split(" ")).translate({k: None for k in range(9, 14)})
        if key not in best or len(docs[i]) > len(docs[best[key]]):
            best[key] = i
    exact = sorted(best.values())
    classes = near([(i, docs[i]) for i in exact])
    kept = [i for i in exact if classes[i][0] == i]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    leaks = {d for d, _ in runs_of_13([(i, docs[i]) for i in kept], items)}
    expected = [i for i in kept if i not in leaks]
    got = corpus_pipeline.run(spark, SF).collect()
    assert sorted(r.doc_id for r in got) == expected
    ref = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    assert all(r.ids == ref.encode(docs[r.doc_id]) for r in got)


def test_stages_take_odd_and_empty_documents(spark):
    docs = spark.createDataFrame(ODD, DOCS)
    for start in (docs, docs.limit(0)):
        now = start
        for _, stage in corpus_pipeline.STAGES[1:4]:
            now = stage(spark, now, SF)
            assert now.columns == docs.columns
        assert now.count() == (5 if start is docs else 0)  # the blank texts, the null id, the long text, and one each of the copies and of the near copies
    assert exact_dedup.stage(spark, docs, SF).where("doc_id IS NULL").count() == 1


def test_registered_names():
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))
    assert corpus_pipeline.ORACLE_SQL is None and [n for n, _ in corpus_pipeline.STAGES]


def test_every_text_is_compared_with_the_library(spark):
    got = sentence_pieces.query(spark, SF).collect()
    assert len(got) >= 200 and all(r.parity is True for r in got)
