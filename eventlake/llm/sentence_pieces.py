"""SentencePiece encoding and decoding with the tokenizers library as the backend."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import piece_model
from .common import by_bytes, small_batches, tidy

MODEL = "piece_bpe_32k.model"
#: One text in so many, by crc32, is also encoded by the sentencepiece library and compared: all of them.
PARITY_ONE_IN = 1
NAMES = ["n_tokens", "ids_sha256", "round_trip", "parity", "ids"]
KINDS = [pa.int64(), pa.string(), pa.bool_(), pa.bool_(), pa.list_(pa.int32())]


@lru_cache(maxsize=4)
def reference(path: str) -> sentencepiece.SentencePieceProcessor:
    return sentencepiece.SentencePieceProcessor(model_file=path)


def reads_back(text: str, ids: list[int], surface: list[bytes], prefixed: bool) -> bool:
    """True where the joined bytes of the pieces are the text's, which the decoder then gives too: runs of byte pieces lie between whole characters."""
    joined = b"".join(map(surface.__getitem__, ids))
    return (joined.removeprefix(b" ") if prefixed else joined) == text.encode()


def encode(docs: DataFrame, model_path: str | None = None, parity_one_in: int = PARITY_ONE_IN, keep_ids: bool = True) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, round_trip, parity, and ids if ``keep_ids``, for every row.

    ids are those of the whole text without begin and end tokens; ids_sha256 digests them as
    little-endian int32.  ``round_trip``: decoding gives the text back (false where the model's
    normaliser rewrites it, and where it holds the marker itself, which reads as a space).  ``parity``: the backend's ids equal the sentencepiece library's, null where not
    compared; all texts are compared unless ``parity_one_in`` says otherwise, which chooses by content, not by place.  Where ids differ, those of the library are returned.  Null and empty texts have no
    tokens and are compared like others; repeated rows are encoded each; other columns are
    ignored; an empty table gives no rows.  Each task takes slices of about 1 MB.  Where the model's words are independent the backend encodes each distinct
    word once and a text is put together from its words; the library always encodes the whole text.  A text whose pieces' bytes, joined, are its own reads back; of any other the backend's decoder tells.
    """
    path = model_path or public_tokenizers.path(MODEL)
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok, ref, model = piece_model.load(path), reference(path), piece_model.parsed(path)
        pattern, surface = model.words(), model.surfaces()
        words = piece_model.WordIds(path, pattern) if pattern else None
        for batch in batches:
            texts = [t or "" for t in batch["text"].to_pylist()]
            rows = []
            for part in by_bytes(texts):
                found = [x.tolist() for x in words.of(part)] if words is not None else [e.ids for e in tok.encode_batch_fast(part, add_special_tokens=False)]
                chosen = [k for k, t in enumerate(part) if zlib.crc32(t.encode()) % parity_one_in == 0]
                same = dict(zip(chosen, ref.encode([part[k] for k in chosen], num_threads=1), strict=True))
                parity = [same[k] == ids if k in same else None for k, ids in enumerate(found)]
                found = [same[k] if equal is False else ids for k, (ids, equal) in enumerate(zip(found, parity, strict=True))]
                back = [reads_back(text, ids, surface, model.dummy_prefix) for text, ids in zip(part, found, strict=True)]
                open_ones = [k for k, equal in enumerate(back) if not equal]
                for k, again in zip(open_ones, tok.decode_batch([found[k] for k in open_ones], skip_special_tokens=False), strict=True):
                    back[k] = again == part[k]
                for ids, equal, whole in zip(found, parity, back, strict=True):
                    rows.append((len(ids), hashlib.sha256(np.array(ids, "<i4").tobytes()).hexdigest(), whole, equal, ids))
            columns = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(KINDS[: 4 + keep_ids])]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], *columns], names=["doc_id", *NAMES[: 4 + keep_ids]])

    schema = "doc_id long, n_tokens long, ids_sha256 string, round_trip boolean, parity boolean" + ", ids array<int>" * keep_ids
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(tidy(run), schema)


def decode(encoded: DataFrame, model_path: str | None = None) -> DataFrame:
    """doc_id, text for every row: the texts of ``ids``; null and empty ids give an empty text.

    doc_id comes through as it is, null or repeated; other columns are ignored; an empty table gives no rows.
    """
    path = model_path or public_tokenizers.path(MODEL)
    small_batches(encoded.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = piece_model.load(path)
        for batch in batches:
            texts = tok.decode_batch([x or [] for x in batch["ids"].to_pylist()], skip_special_tokens=False)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select(F.col("doc_id").cast("long").alias("doc_id"), "ids").mapInArrow(tidy(run), "doc_id long, text string")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the token ids of every document, a row each; ids that are null or repeat stay, null and empty texts have no tokens, extra columns go."""
    return encode(docs)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(spark.read.parquet(f"{sf_dir}/documents.parquet"), keep_ids=False)
