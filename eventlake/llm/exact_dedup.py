"""Exact deduplication by deterministic block naming.

A text is cut into blocks of a fixed number of bytes.  Distinct blocks are sorted and named by
integers; then adjacent names are paired, distinct pairs are named in turn, and so on
until every document has one name.  Names stand for contents, not for hashes of
them, so two documents have the same (level, name) exactly when their texts are equal.
Blocks are sorted inside hash partitions, so which integer a content gets depends on the
number of shuffle partitions; which documents share a name doesn't.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, join_groups

#: Characters that don't count when texts are compared.
SPACE = r"[\x20\x09-\x0D]"
BLOCK = 1024


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, "")


def named(keys: DataFrame, scratch: Scratch, table: str) -> DataFrame:
    """The distinct rows of ``keys`` with an integer name and their number each; equal rows meet map-side first, so a hot key costs one row a task."""
    cols = keys.columns
    counted = keys.groupBy(*cols).agg(F.count("*").alias("times"))
    return scratch.keep(counted.sortWithinPartitions(*cols).withColumn("name", F.monotonically_increasing_id()), table)


def digest(block: str) -> Column:
    return F.unhex(F.sha2(block, 256)).alias("digest")


def block_names(blocks: DataFrame, scratch: Scratch) -> DataFrame:
    """(digest, times, name) of the distinct blocks: names follow the sorted contents, digests serve to look them up.

    That no two contents share a digest is checked over all of them, so a look-up is as good as by content.
    """
    counted = blocks.groupBy("block").agg(F.count("*").alias("times"))
    names = counted.sortWithinPartitions("block").select(digest("block"), "times", F.monotonically_increasing_id().alias("name"))
    names = scratch.keep(names, "blocks")
    if names.groupBy("digest").count().where("count > 1").limit(1).count():
        raise RuntimeError("two blocks share a digest")
    return names


def rows_of(names: DataFrame) -> int:
    return names.agg(F.sum("times")).first()[0] or 0


def identities(docs: DataFrame, scratch: Scratch, block: int = BLOCK) -> DataFrame:
    """row, doc_id, n_points, text_sha256, level, name for every row of ``docs`` (doc_id, text)."""
    norm = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
        F.char_length(F.coalesce(F.col("text"), F.lit(""))).cast("long").alias("n_points"), normalised(F.col("text")).cast("binary").alias("norm"),
    )
    count = F.greatest(F.lit(1), F.ceil(F.octet_length("norm") / block)).cast("int")
    # Cut as bytes, since a place among characters is found by a walk from the text's start; and after the explode of
    # places, inside one generated loop, since each read of a binary column from a row copies the whole of it.
    places = norm.select("*", count.alias("n"), F.explode(F.sequence(F.lit(0), count - 1)).alias("pos"))
    blocks = places.withColumn("block", F.substring(F.col("norm"), F.col("pos") * block + 1, F.lit(block)))
    names = block_names(blocks.select("block"), scratch)
    first = F.col("pos") == 0  # what belongs to the document travels with its first block only
    facts = [F.when(first, F.col(c)).alias(c) for c in ("doc_id", "n_points")] + [F.when(first, F.sha2(F.col("norm"), 256)).alias("text_sha256")]
    cut_rows = blocks.select("row", "n", "pos", digest("block"), *facts)
    level0 = scratch.keep(join_groups(cut_rows, names, ["digest"], "times", rows_of(names), "row").drop("digest", "times"), "level0")
    most = level0.agg(F.max("n")).first()[0] or 1
    now, done, level = level0.select("row", "n", "pos", "name"), [], 0
    while True:
        done.append(now.where("n = 1").select("row", F.lit(level).alias("level"), "name"))
        if most <= 1:
            break
        # adjacent names meet in one row; an odd last name is paired with -1
        pairs = now.where("n > 1").groupBy("row", F.expr("pos div 2").alias("pos")).agg(
            F.first("n").alias("n"), F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("a"),
            F.coalesce(F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))), F.lit(-1)).alias("b"))
        level += 1
        pairs = scratch.keep(pairs, f"pairs{level}")
        names = named(pairs.select("a", "b"), scratch, f"names{level}")
        now = scratch.keep(join_groups(pairs, names, ["a", "b"], "times", rows_of(names), "row").select("row", F.expr("int((n + 1) div 2)").alias("n"), F.col("pos").cast("int"), "name"), f"level{level}")
        scratch.drop(f"pairs{level}", f"names{level}")
        most = (most + 1) // 2
    scratch.drop("blocks")
    last = done[0]
    for df in done[1:]:
        last = last.union(df)
    return level0.where("pos = 0").select("row", "doc_id", "n_points", "text_sha256").join(last, "row")


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical without ASCII white space.  Of a group the row with the most
    code points, then the smallest doc_id stays; of repeated rows that tie in both, one
    stays.  Null texts count as empty and form one group with other empty ones; a null doc_id comes
    last among ties; an empty table gives no rows.  Other columns are ignored.
    """
    scratch = Scratch(docs.sparkSession, "exact-dedup")
    ids = scratch.keep(identities(docs, scratch), "identities")
    scratch.drop(*[f"level{k}" for k in range(1, 40)])
    best = F.min(F.struct((-F.col("n_points")).alias("p"), F.col("doc_id").isNull().alias("z"), F.col("doc_id").alias("d"), F.col("row").alias("r")))
    groups = ids.groupBy("level", "name").agg(best.alias("best"), F.count("*").alias("group_size"))
    return join_groups(ids, groups, ["level", "name"], "group_size", ids.count(), "row").select(
        "doc_id", F.col("best.d").alias("keep_id"), "group_size", (F.col("row") == F.col("best.r")).alias("kept"), "text_sha256")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the rows that stay, with all their columns as they are.

    Of rows that share both doc_id (null is an id like others) and text up to white space one stays, the longest; rows that share only one of these are judged
    like any others.  Null and empty texts are one group; extra columns may have any names; an empty table gives no rows.
    """
    kept = exact_duplicates(docs).where("kept").select("doc_id", "text_sha256").distinct()
    text = F.coalesce(docs["text"], F.lit(""))
    same = docs["doc_id"].eqNullSafe(kept["doc_id"]) & (F.sha2(normalised(text), 256) == kept["text_sha256"])
    out = docs.join(kept, same, "left_semi").select(docs.columns)
    if docs.groupBy("doc_id").count().where("count > 1").limit(1).count():  # repeated rows: one of each
        best = F.min_by(F.struct(*docs.columns), -F.char_length(F.coalesce("text", F.lit(""))))
        out = out.groupBy(F.col("doc_id"), F.sha2(normalised(F.col("text")), 256)).agg(best.alias("r")).select("r.*")
    return out


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
