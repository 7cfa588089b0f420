"""Token counts through a cache keyed by content and tokenizer digests."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import public_tokenizers
import sentencepiece
import tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.session import shared_dir

from .common import by_bytes, small_batches, tidy

MODEL = "piece_bpe_32k.model"
LIMIT = 4096
#: Setting that names a lasting cache folder; without it a call has a cache of its own.
CACHE = "spark.eventlake.tokenCache"


def version_digest(path: str) -> str:
    """Digest of the tokenizer file and of the library's version."""
    library = sentencepiece.__version__ if path.endswith(".model") else tokenizers.__version__
    with open(path, "rb") as f:
        return hashlib.sha256(library.encode() + b"\0" + f.read()).hexdigest()


@lru_cache(maxsize=4)
def counter(path: str):
    """texts -> token counts."""
    if path.endswith(".model"):
        pieces = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(x) for x in pieces.encode(texts, num_threads=1)]
    tok = tokenizers.Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    return lambda texts: [len(e) for e in tok.encode_batch_fast(texts, add_special_tokens=False)]


def exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def cached(spark: SparkSession, folder: str) -> DataFrame | None:
    """digest, n_tokens of a cache; a digest written twice (a repeated append) counts once."""
    if not exists(spark, f"{folder}/_SUCCESS"):
        return None
    stored = spark.read.schema("digest binary, n_tokens long").parquet(folder)
    return stored.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def encode_misses(misses: DataFrame, path: str) -> DataFrame:
    """digest, n_tokens of each (digest, text)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count = counter(path)
        for batch in batches:
            counts = [n for part in by_bytes(list(batch["text"])) for n in count(part)]
            yield pd.DataFrame({"digest": batch["digest"], "n_tokens": counts})

    return misses.mapInPandas(tidy(run), "digest binary, n_tokens long")


def count_tokens(docs: DataFrame, cache: str, model_path: str | None = None, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every row.

    Content is normalised by taking null as empty only, since anything more would change
    counts.  Each distinct content that ``cache`` lacks for this tokenizer version is encoded
    once, whole, and appended; then counts are joined by digest.  Repeated rows and equal
    texts share one entry: equal digests meet map-side before any text is shuffled.  Other columns
    are ignored; an empty table gives no rows.  A run that fails before its append leaves the cache as it was.
    """
    spark = docs.sparkSession
    path = model_path or public_tokenizers.path(MODEL)
    folder = f"{cache}/tokenizer={version_digest(path)}"
    text = F.coalesce(F.col("text"), F.lit(""))
    keyed = docs.select("doc_id", F.unhex(F.sha2(text, 256)).alias("digest"), text.alias("text"))
    misses = keyed.groupBy("digest").agg(F.first("text").alias("text"))
    known = cached(spark, folder)
    if known is not None:
        misses = misses.join(known, "digest", "left_anti")
    small_batches(spark)
    encode_misses(misses, path).write.mode("append").parquet(folder)
    slim = docs.select("doc_id", F.unhex(F.sha2(text, 256)).alias("digest"), F.octet_length(text).cast("long").alias("n_bytes"))
    counts = cached(spark, folder)
    return slim.join(counts, "digest").select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    from uuid import uuid4

    cache = spark.conf.get(CACHE, None) or f"{shared_dir(spark)}/token-cache-{uuid4().hex}"
    return count_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"), cache)
