"""Gold: dimensions of actors and posts, facts of content, engagement and network events."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.functions.columns import event_id, event_time, utc
from eventlake.model import FOLLOW, POST
from eventlake.operators.scope import latest_by, union

STAMP = ("received_at", "jetstream_time_us", "ingest_date", "ingest_hour")


def deleted(records: DataFrame, collection: str) -> DataFrame:
    return records.where(F.col("collection") == collection)


def dim_actors(posts: DataFrame, engagements: DataFrame, follows: DataFrame, deletes: DataFrame) -> DataFrame:
    """A row for each actor ever seen as author, engager, follower, followee or deleter."""
    def seen(df: DataFrame, who: str, created: str | None = "record_created_at") -> DataFrame:
        return df.select(F.col(who).alias("actor_did"), event_time(created).alias("at"), "ingest_date")

    # a follow is read once and counts for both of its sides
    sides = follows.select(F.explode(F.array("actor_did", "target_actor_did")).alias("actor_did"), event_time().alias("at"), "ingest_date")
    rows = union([seen(posts, "author_did"), seen(engagements, "actor_did"), sides, seen(deletes, "repository_did", None)])
    return rows.where(F.col("actor_did").isNotNull()).groupBy("actor_did").agg(
        F.min("at").alias("first_seen_at"), F.max("at").alias("last_seen_at"), F.min("ingest_date").alias("first_ingest_date"),
        F.max("ingest_date").alias("last_ingest_date"), F.count("*").alias("source_event_count"),
    )


def dim_posts(posts: DataFrame, deletes: DataFrame) -> DataFrame:
    """A row for each post: latest state and lifecycle; a post seen only when deleted has no state.  Deleted once is deleted for good."""
    gone = deleted(deletes, POST).withColumnRenamed("record_uri", "post_uri")
    lifecycle = union([
        posts.select("post_uri", event_time().alias("at"), "ingest_date", "ingest_hour"),
        gone.select("post_uri", event_time(None).alias("at"), "ingest_date", "ingest_hour"),
    ]).groupBy("post_uri").agg(
        F.min("at").alias("first_seen_at"), F.max("at").alias("last_seen_at"), F.max("ingest_date").alias("ingest_date"), F.max("ingest_hour").alias("ingest_hour"))
    state = latest_by(posts, "post_uri").drop("ingest_date", "ingest_hour")
    end = latest_by(gone, "post_uri").select("post_uri", event_time(None).alias("deleted_at"))
    return lifecycle.join(state, "post_uri", "left").join(end, "post_uri", "left").select(
        "post_uri", "author_did", F.col("cid").alias("post_cid"), F.col("text").alias("post_text"), utc("record_created_at").alias("post_created_at"), "text_length",
        F.coalesce("is_reply", F.lit(False)).alias("is_reply"), "reply_root_uri", "reply_parent_uri", F.col("deleted_at").isNotNull().alias("is_deleted"), "deleted_at",
        "first_seen_at", "last_seen_at", "ingest_date", "ingest_hour",
    )


def fact_content_events(posts: DataFrame, deletes: DataFrame, history: DataFrame | None = None) -> DataFrame:
    """A row for each create, update and delete of a post or reply.

    A delete has no body: whether it was a reply comes from the latest state in ``history`` (all posts; by default
    ``posts``), so a windowed run classifies deletes of older posts as a full one does.
    """
    kind = F.concat(F.when(F.col("is_reply"), "reply").otherwise("post"), F.lit("_"), F.col("operation"))
    state = latest_by(posts if history is None else history, "post_uri").select("post_uri", "is_reply", "reply_root_uri", "reply_parent_uri")
    gone = deleted(deletes, POST).withColumnsRenamed({"record_uri": "post_uri", "repository_did": "author_did"})
    gone = gone.join(state, "post_uri", "left").withColumn("is_reply", F.coalesce("is_reply", F.lit(False)))
    shared = ["author_did", "post_uri", "is_reply", "reply_root_uri", "reply_parent_uri", "operation", *STAMP]
    rows = union([posts.select(*shared, event_time().alias("event_time")), gone.select(*shared, event_time(None).alias("event_time"))])
    return rows.withColumn("content_event_type", kind).select(
        event_id("post_uri", "content_event_type").alias("content_event_id"), F.col("post_uri").alias("content_uri"), "author_did", F.lit("post").alias("content_type"),
        "content_event_type", "post_uri", "is_reply", "reply_root_uri", "reply_parent_uri", "event_time", *STAMP,
    )


def fact_engagement_events(engagements: DataFrame) -> DataFrame:
    """A row for each like and repost."""
    return engagements.select(
        F.col("engagement_uri").alias("engagement_event_id"), "engagement_uri", "actor_did", F.col("subject_uri").alias("target_post_uri"), F.col("subject_cid").alias("target_cid"),
        "engagement_type", F.concat_ws("_", "engagement_type", F.lit("create")).alias("engagement_event_type"), event_time().alias("event_time"), *STAMP,
    )


def fact_network_events(follows: DataFrame, deletes: DataFrame, history: DataFrame | None = None) -> DataFrame:
    """A row for each follow and unfollow; an unfollow's target comes from ``history`` and is null if never seen."""
    target = latest_by(follows if history is None else history, "follow_uri").select("follow_uri", "target_actor_did")
    gone = deleted(deletes, FOLLOW).withColumnsRenamed({"record_uri": "follow_uri", "repository_did": "actor_did"}).join(target, "follow_uri", "left")
    shared = ["follow_uri", "actor_did", "target_actor_did", *STAMP]
    rows = union([
        follows.select(*shared, event_time().alias("event_time"), F.lit("follow_create").alias("network_event_type")),
        gone.select(*shared, event_time(None).alias("event_time"), F.lit("follow_delete").alias("network_event_type")),
    ])
    return rows.select(event_id("follow_uri", "network_event_type").alias("network_event_id"), "follow_uri", "actor_did", "target_actor_did", "network_event_type", "event_time", *STAMP)


#: name -> builder from the four Silver tables
BUILDERS = {
    "dim_actors": lambda s: dim_actors(s["silver_posts"], s["silver_engagements"], s["silver_follows"], s["silver_deleted_records"]),
    "dim_posts": lambda s: dim_posts(s["silver_posts"], s["silver_deleted_records"]),
    "fact_content_events": lambda s: fact_content_events(s["silver_posts"], s["silver_deleted_records"]),
    "fact_engagement_events": lambda s: fact_engagement_events(s["silver_engagements"]),
    "fact_network_events": lambda s: fact_network_events(s["silver_follows"], s["silver_deleted_records"]),
}


def build_all(s: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Dimensions and facts of the four Silver tables."""
    return {name: build(s) for name, build in BUILDERS.items()}
