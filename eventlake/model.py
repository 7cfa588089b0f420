"""Data model: names of collections, and the schemas of raw events, layers and marts."""

from __future__ import annotations

from pyspark.sql import types as T

#: Fixed values of the event format.
POST, LIKE, REPOST, FOLLOW = "app.bsky.feed.post", "app.bsky.feed.like", "app.bsky.feed.repost", "app.bsky.graph.follow"
COLLECTIONS = (POST, LIKE, REPOST, FOLLOW)
SCHEMA_VERSION = 1
SOURCE = "firehose"

REF = "struct<uri: string, cid: string>"
#: Record bodies by family.  A subject is an object for likes and reposts and a string for follows, so each family is parsed with a schema of its own.
RECORDS = {
    "post": f"struct<`$type`: string, createdAt: string, text: string, reply: struct<root: {REF}, parent: {REF}>>",
    "engagement": f"struct<`$type`: string, createdAt: string, subject: {REF}>",
    "follow": "struct<`$type`: string, createdAt: string, subject: string>",
    "delete": "struct<`$type`: string>",
}


def envelope_schema(family: str) -> T.StructType:
    """What Silver needs of an envelope of ``family``: only the commit, since the rest is hoisted into Bronze columns."""
    return T._parse_datatype_string(f"payload struct<commit: struct<rkey: string, cid: string, record: {RECORDS[family]}>>")


#: The hoisted fields of an envelope.
ENVELOPE = "schema_version long, source string, event_kind string, received_at string, collection string, operation string, repository_did string, jetstream_time_us long"
RAW_EVENT = "did string, time_us long, kind string, commit struct<operation: string, collection: string>"
KAFKA = "key string, value string, topic string, partition int, offset long, timestamp timestamp"
BRONZE = (
    "message_key string, message_value string, schema_version long, source string, event_kind string, received_at string, operation string, repository_did string, "
    "jetstream_time_us long, topic string, partition int, offset long, kafka_timestamp timestamp, ingest_date date, ingest_hour string, collection string"
)
STAMP = "received_at string, jetstream_time_us long"
INGEST = "ingest_date date, ingest_hour string"
SILVER = {
    "silver_posts": f"post_uri string, author_did string, operation string, rkey string, cid string, record_type string, record_created_at string, {STAMP}, text string, text_length int, is_reply boolean, reply_root_uri string, reply_parent_uri string, {INGEST}",
    "silver_engagements": f"engagement_uri string, actor_did string, engagement_type string, operation string, rkey string, cid string, record_type string, record_created_at string, {STAMP}, subject_uri string, subject_cid string, {INGEST}",
    "silver_follows": f"follow_uri string, actor_did string, target_actor_did string, operation string, rkey string, cid string, record_type string, record_created_at string, {STAMP}, {INGEST}",
    "silver_deleted_records": f"record_uri string, repository_did string, collection string, operation string, rkey string, {STAMP}, {INGEST}",
}
#: Keys (grain) of the modelled tables and marts.
KEYS = {
    "dim_actors": ["actor_did"],
    "dim_posts": ["post_uri"],
    "fact_content_events": ["content_event_id"],
    "fact_engagement_events": ["engagement_event_id"],
    "fact_network_events": ["network_event_id"],
    "post_performance": ["post_uri"],
    "content_quality_hourly": ["window_start"],
    "thread_conversation_summary": ["reply_root_uri"],
    "actor_activity_daily": ["activity_date", "actor_did"],
    "network_growth_daily": ["activity_date", "target_actor_did"],
    "event_volume_by_type": ["event_type"],
}
#: Count measures whose sums are reconciled.
MEASURES = {
    "post_performance": ["like_count", "repost_count", "engagement_count", "engagement_actor_count", "engagement_score"],
    "content_quality_hourly": ["original_post_create_count", "reply_create_count", "post_update_count", "reply_update_count", "post_delete_count", "reply_delete_count", "total_content_events"],
    "thread_conversation_summary": ["reply_count", "reply_author_count", "deleted_reply_count"],
    "actor_activity_daily": ["original_posts_created", "replies_created", "posts_updated", "posts_deleted", "likes_given", "reposts_given", "follows_created", "follows_deleted", "engagements_given", "received_likes", "received_reposts", "received_engagements", "activity_score"],
    "network_growth_daily": ["follow_count", "unfollow_count", "net_follow_count", "unique_follower_count"],
}
#: Buckets of tables that are keyed but have no day: a merge rewrites the buckets of its keys.
BUCKETS = 64
#: Layout on disk: tables are foldered by day or bucket, so a refresh window prunes to a few folders and rewrites a few.  A fact's folder is the day of its
#: event, which is part of its id: whether an event is there already is asked of its own day alone, however late it came.
PARTITIONS: dict[str, list[str] | dict[str, str]] = {name: ["ingest_date"] for name in SILVER}
PARTITIONS |= {name: {"event_day": "date_from_unix_date(CAST(jetstream_time_us div 86400000000 AS INT))"} for name in ("fact_content_events", "fact_engagement_events", "fact_network_events")}
PARTITIONS |= {name: ["activity_date"] for name in ("actor_activity_daily", "network_growth_daily")}
PARTITIONS |= {"content_quality_hourly": {"day": "CAST(window_start AS DATE)"}}
PARTITIONS |= {name: {"bucket": f"CAST(pmod(xxhash64({KEYS[name][0]}), {BUCKETS}) AS INT)"} for name in ("dim_actors", "dim_posts", "post_performance", "thread_conversation_summary")}
