"""From raw documents to token ids: each stage's result is written as Parquet and is the next one's input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from eventlake.llm import decontaminate, exact_dedup, near_dedup, quality, sentence_pieces
from eventlake.llm.common import Scratch

STAGES = [
    ("quality classifier", quality.stage),
    ("exact dedup", exact_dedup.stage),
    ("n-gram Jaccard join", near_dedup.stage),
    ("benchmark decontamination", decontaminate.stage),
    ("SentencePiece encoding", sentence_pieces.stage),
]

#: SQL can't express a trained classifier or a tokenizer; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, round_trip, parity and ids of the documents that all stages keep."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = scratch.keep(stage(spark, docs, sf_dir), f"stage{k}")
        if k:
            scratch.drop(f"stage{k - 1}")
    return docs
