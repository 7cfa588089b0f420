"""Silver: typed events, one row each, from Bronze commits."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.functions.columns import at_uri, once
from eventlake.model import FOLLOW, LIKE, POST, REPOST, envelope_schema


def _parsed(bronze: DataFrame, condition, family: str) -> DataFrame:
    """Matching rows with their commit; the filter comes first, so other rows are never parsed."""
    return once(bronze.where(condition), "commit", F.from_json("message_value", envelope_schema(family))["payload"]["commit"])


def posts(bronze: DataFrame) -> DataFrame:
    """A row for each create and update of a post; not deduplicated."""
    rows = _parsed(bronze, (F.col("collection") == POST) & F.col("operation").isin("create", "update"), "post")
    return rows.select(
        at_uri("repository_did", F.lit(POST), "commit.rkey").alias("post_uri"), F.col("repository_did").alias("author_did"), "operation", "commit.rkey", "commit.cid",
        F.col("commit.record.`$type`").alias("record_type"), F.col("commit.record.createdAt").alias("record_created_at"), "received_at", "jetstream_time_us",
        F.col("commit.record.text").alias("text"), F.length("commit.record.text").alias("text_length"), F.col("commit.record.reply.root.uri").isNotNull().alias("is_reply"),
        F.col("commit.record.reply.root.uri").alias("reply_root_uri"), F.col("commit.record.reply.parent.uri").alias("reply_parent_uri"), "ingest_date", "ingest_hour",
    )


def engagements(bronze: DataFrame) -> DataFrame:
    """A row for each created like or repost."""
    rows = _parsed(bronze, F.col("collection").isin(LIKE, REPOST) & (F.col("operation") == "create"), "engagement")
    return rows.select(
        at_uri("repository_did", "collection", "commit.rkey").alias("engagement_uri"), F.col("repository_did").alias("actor_did"),
        F.when(F.col("collection") == LIKE, "like").otherwise("repost").alias("engagement_type"), "operation", "commit.rkey", "commit.cid",
        F.col("commit.record.`$type`").alias("record_type"), F.col("commit.record.createdAt").alias("record_created_at"), "received_at", "jetstream_time_us",
        F.col("commit.record.subject.uri").alias("subject_uri"), F.col("commit.record.subject.cid").alias("subject_cid"), "ingest_date", "ingest_hour",
    )


def follows(bronze: DataFrame) -> DataFrame:
    """A row for each created follow."""
    rows = _parsed(bronze, (F.col("collection") == FOLLOW) & (F.col("operation") == "create"), "follow")
    return rows.select(
        at_uri("repository_did", F.lit(FOLLOW), "commit.rkey").alias("follow_uri"), F.col("repository_did").alias("actor_did"), F.col("commit.record.subject").alias("target_actor_did"),
        "operation", "commit.rkey", "commit.cid", F.col("commit.record.`$type`").alias("record_type"), F.col("commit.record.createdAt").alias("record_created_at"),
        "received_at", "jetstream_time_us", "ingest_date", "ingest_hour",
    )


def deleted_records(bronze: DataFrame) -> DataFrame:
    """A row for each delete, of any collection."""
    rows = _parsed(bronze, F.col("operation") == "delete", "delete")
    return rows.select(
        at_uri("repository_did", "collection", "commit.rkey").alias("record_uri"), "repository_did", "collection", "operation", "commit.rkey",
        "received_at", "jetstream_time_us", "ingest_date", "ingest_hour",
    )


TABLES: dict[str, Callable[[DataFrame], DataFrame]] = {"silver_posts": posts, "silver_engagements": engagements, "silver_follows": follows, "silver_deleted_records": deleted_records}


def build_all(bronze: DataFrame) -> dict[str, DataFrame]:
    return {name: build(bronze) for name, build in TABLES.items()}


def deduplicated(df: DataFrame, uri: str) -> DataFrame:
    """One row for each delivered event: redelivery repeats (uri, operation, time)."""
    return df.dropDuplicates([uri, "operation", "jetstream_time_us"])
