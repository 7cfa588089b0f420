"""Sharding by a Feistel permutation of global row numbers (DataFrame and SQL functions only)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Scratch

ROUNDS = 6
#: Feistel passes a row may walk; the domain is under twice the row count, so a pass leaves under half of the rows outside.
WALK = 80


def permute(number: Column, n: int, seed: int = 0) -> Column:
    """The place of row ``number`` in a pseudo-random permutation of [0, n).

    The domain is the least power of two of at least n, split into a high and a
    low half; rounds in turn change one half by a keyed hash of the other, which
    is a bijection.  A value of n or more is permuted again until it lies inside
    (cycle walking), which keeps it a bijection of [0, n).
    """
    bits = max(2, (n - 1).bit_length())
    low = (bits + 1) // 2
    low_mask, high_mask = (1 << low) - 1, (1 << (bits - low)) - 1

    def step(q: Column, k: Column) -> Column:
        key = k + F.lit(seed * ROUNDS)
        high = F.shiftleft(F.xxhash64(q.bitwiseAND(F.lit(low_mask)), key).bitwiseAND(F.lit(high_mask)), low)
        return F.when(k % 2 == 0, q.bitwiseXOR(high)).otherwise(q.bitwiseXOR(F.xxhash64(F.shiftright(q, low), key).bitwiseAND(F.lit(low_mask))))

    def rounds(p: Column) -> Column:
        return F.aggregate(F.sequence(F.lit(0).cast("long"), F.lit(ROUNDS - 1).cast("long")), p, step)

    walked = F.aggregate(F.sequence(F.lit(0), F.lit(WALK - 1)), number, lambda p, k: F.when((k > 0) & (p < n), p).otherwise(rounds(p)))
    return F.when(walked < n, walked).otherwise(F.raise_error(F.lit("cycle walk did not end")).cast("long"))


def numbered(df: DataFrame, scratch: Scratch, order: list[str]) -> tuple[DataFrame, int]:
    """``df`` with its global row number in ``order``, and the count.

    Ranges of the order are sorted apart; a row's number is its place in its range plus
    the rows of earlier ranges.  Only one count a partition is gathered and broadcast.
    """
    mid = F.monotonically_increasing_id()
    placed = scratch.keep(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_mid", mid), "ranges")
    placed = placed.withColumns({"_part": F.shiftright("_mid", 33), "_at": F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1))})
    before = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = placed.groupBy("_part").agg(F.count("*").alias("_n")).select("_part", F.coalesce(before, F.lit(0)).alias("_before"))
    out = placed.join(F.broadcast(offsets), "_part").withColumn("row_number", F.col("_before") + F.col("_at"))
    return out.drop("_mid", "_part", "_at", "_before"), placed.count()


def keyed(docs: DataFrame, scratch: Scratch, whole: bool = False) -> DataFrame:
    """doc_id, text and a unique long ``key`` in the order of doc_id; ``whole``: also ``_row``, a struct of all columns.

    The key is doc_id itself unless one repeats or is null; then it is the row number by doc_id and
    the text's crc32, nulls first.
    """
    row = [F.struct(*[docs[c] for c in docs.columns]).alias("_row")] if whole else []
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *row)
    if not docs.groupBy("doc_id").count().where("count > 1 OR doc_id IS NULL").limit(1).count():
        return docs.withColumn("key", F.col("doc_id"))
    crc = F.crc32(F.coalesce("text", F.lit("")))
    columns = ["doc_id", "text", *["_row"] * whole]
    return numbered(docs.withColumn("_crc", crc), scratch, ["doc_id", "_crc"])[0].select(*columns, F.col("row_number").alias("key"))


def shard_rows(docs: DataFrame, shards: int = 16, seed: int = 0) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard, row_number: a reproducible shuffle.

    Law ``rows``: shard counts differ by one at most.  Row numbers follow (doc_id,
    crc32, size), so the result depends on the rows alone, not on files or
    partitions.  Null texts count as empty (size 1, crc32 0); null doc_ids come first;
    repeated rows are rows of their own; an empty table gives no rows.  Other columns are dropped.
    """
    scratch = Scratch(docs.sparkSession, "sharding")
    text = F.coalesce(F.col("text"), F.lit(""))
    slim = docs.select(F.col("doc_id").cast("long"), (F.octet_length(text).cast("long") + 1).alias("size"), F.crc32(text).alias("text_crc32"))
    rows, n = numbered(slim, scratch, ["doc_id", "text_crc32", "size"])
    place = permute(F.col("row_number"), n, seed)
    return rows.withColumn("_p", place).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), (F.col("_p") % shards).cast("int").alias("shard"),
        F.floor(F.col("_p") / shards).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "row_number",
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_rows(spark.read.parquet(f"{sf_dir}/documents.parquet"))
