"""Marts: what dashboards read, one row a grain, derived from dimensions and facts."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake.functions.columns import count_where, ratio, seconds_between, zero
from eventlake.operators.scope import union


def kind_counts(column: str, measures: dict[str, str | list[str]]) -> list[Column]:
    """A conditional count for each measure: rows whose ``column`` is one of the given values."""
    return [count_where(F.col(column).isin(*([v] if isinstance(v, str) else v))).alias(name) for name, v in measures.items()]


ENGAGEMENTS = {"like_count": "like", "repost_count": "repost"}


def post_performance(dim_posts: DataFrame, engagements: DataFrame) -> DataFrame:
    """By post: engagement counts, first and last times, lifetime, score.  Posts seen only as targets are kept without state."""
    known = engagements.where(F.col("target_post_uri").isNotNull())
    # A full outer join of posts and rollups has the keys of both, so no separate union of keys is shuffled.
    rollup = known.groupBy(F.col("target_post_uri").alias("post_uri")).agg(
        *kind_counts("engagement_type", ENGAGEMENTS), F.count("*").alias("engagement_count"), F.count_distinct("actor_did").alias("engagement_actor_count"),
        F.min("event_time").alias("first_engagement_at"), F.max("event_time").alias("last_engagement_at"))
    likes, reposts = zero("like_count"), zero("repost_count")
    return dim_posts.join(rollup, "post_uri", "full").select(
        "post_uri", "author_did", "post_created_at", "is_reply", "reply_root_uri", "reply_parent_uri", "text_length", "is_deleted", "deleted_at",
        seconds_between("post_created_at", "deleted_at").alias("post_lifetime_seconds"), likes.alias("like_count"), reposts.alias("repost_count"),
        zero("engagement_count").alias("engagement_count"), zero("engagement_actor_count").alias("engagement_actor_count"), "first_engagement_at", "last_engagement_at",
        seconds_between("post_created_at", "first_engagement_at").alias("time_to_first_engagement_seconds"), ratio(reposts, likes).alias("repost_to_like_ratio"),
        (likes + 2 * reposts).alias("engagement_score"),
    )


CONTENT = {
    "original_post_create_count": "post_create", "reply_create_count": "reply_create", "post_update_count": "post_update",
    "reply_update_count": "reply_update", "post_delete_count": "post_delete", "reply_delete_count": "reply_delete",
}


def content_quality_hourly(content: DataFrame, dim_posts: DataFrame) -> DataFrame:
    """By hour of event time: lifecycle counts and ratios; text length averages over creates, at the posts' latest length."""
    sized = content.join(dim_posts.select("post_uri", "text_length"), "post_uri", "left")
    is_create = F.col("content_event_type").isin("post_create", "reply_create")
    hours = sized.groupBy(F.date_trunc("hour", "event_time").cast("timestamp_ntz").alias("window_start")).agg(
        *kind_counts("content_event_type", CONTENT), F.count("*").alias("total_content_events"), F.avg(F.when(is_create, F.col("text_length").cast("double"))).alias("avg_text_length"))
    c, total = F.col, F.col("total_content_events")
    return hours.select(
        "window_start", *CONTENT, "total_content_events", ratio(c("reply_create_count"), c("original_post_create_count") + c("reply_create_count")).alias("reply_ratio"),
        ratio(c("post_delete_count") + c("reply_delete_count"), total).alias("delete_ratio"), ratio(c("post_update_count") + c("reply_update_count"), total).alias("update_ratio"), "avg_text_length",
    )


def thread_conversation_summary(dim_posts: DataFrame, content: DataFrame) -> DataFrame:
    """By root with at least one reply created: replies, authors, times, text length, deletions."""
    replies = content.where(F.col("content_event_type").isin("reply_create", "reply_delete") & F.col("reply_root_uri").isNotNull())
    # creates and deletes are rolled up in one pass; only creates carry measures besides the deletions
    made = F.col("content_event_type") == "reply_create"
    size = dim_posts.select("post_uri", "text_length")
    rollup = replies.join(size, "post_uri", "left").groupBy("reply_root_uri").agg(
        count_where(made).alias("reply_count"), F.count_distinct(F.when(made, F.col("author_did"))).alias("reply_author_count"), F.min(F.when(made, F.col("event_time"))).alias("first_reply_at"),
        F.max(F.when(made, F.col("event_time"))).alias("last_reply_at"), F.avg(F.when(made, F.col("text_length").cast("double"))).alias("avg_reply_text_length"), count_where(~made).alias("deleted_reply_count"))
    roots = dim_posts.select(F.col("post_uri").alias("reply_root_uri"), F.col("author_did").alias("root_author_did"), F.col("post_created_at").alias("root_post_created_at"))
    return rollup.where("reply_count > 0").join(roots, "reply_root_uri", "left").select(
        "reply_root_uri", "root_author_did", "root_post_created_at", "reply_count", "reply_author_count", "first_reply_at", "last_reply_at",
        seconds_between("root_post_created_at", "last_reply_at").alias("conversation_duration_seconds"), "avg_reply_text_length", "deleted_reply_count",
    )


ACTOR_COUNTS = (
    "original_posts_created", "replies_created", "posts_updated", "posts_deleted", "likes_given", "reposts_given", "follows_created", "follows_deleted", "engagements_given",
    "received_likes", "received_reposts", "received_engagements", "unique_posts_engaged", "unique_actors_followed",
)


def actor_activity_daily(dim_actors: DataFrame, dim_posts: DataFrame, content: DataFrame, engagements: DataFrame, network: DataFrame) -> DataFrame:
    """By day and known actor: what they did and received."""
    grain, day = ["activity_date", "actor_did"], F.to_date("event_time").alias("activity_date")

    def daily(df: DataFrame, who: str, *measures: Column) -> DataFrame:
        return df.where(F.col(who).isNotNull()).groupBy(day, F.col(who).alias("actor_did")).agg(*measures)

    authors = dim_posts.where(F.col("author_did").isNotNull()).select(F.col("post_uri").alias("target_post_uri"), "author_did")
    rollups = [
        daily(content, "author_did", *kind_counts("content_event_type", {"original_posts_created": "post_create", "replies_created": "reply_create", "posts_updated": ["post_update", "reply_update"], "posts_deleted": ["post_delete", "reply_delete"]})),
        daily(engagements, "actor_did", *kind_counts("engagement_type", {"likes_given": "like", "reposts_given": "repost"}), F.count("*").alias("engagements_given"), F.count_distinct("target_post_uri").alias("unique_posts_engaged")),
        daily(network, "actor_did", *kind_counts("network_event_type", {"follows_created": "follow_create", "follows_deleted": "follow_delete"}), F.count_distinct(F.when(F.col("network_event_type") == "follow_create", F.col("target_actor_did"))).alias("unique_actors_followed")),
        daily(engagements.join(authors, "target_post_uri"), "author_did", *kind_counts("engagement_type", {"received_likes": "like", "received_reposts": "repost"}), F.count("*").alias("received_engagements")),
    ]
    # Rollups are stacked and summed instead of joined one by one: a single shuffle on the grain, and null days stay apart.
    zeros = [r.select(*grain, *[(F.col(c) if c in r.columns else F.lit(0).cast("long")).alias(c) for c in ACTOR_COUNTS]) for r in rollups]
    stacked = union(zeros)
    # rows without a day never meet in a join, so there each rollup's measures are lost and only its key stays
    alone = F.col("activity_date").isNull()
    total = stacked.groupBy(*grain).agg(*[F.sum(F.when(~alone, F.col(c)).otherwise(0)).alias(c) for c in ACTOR_COUNTS])
    total = total.join(dim_actors.select("actor_did"), "actor_did", "left_semi")
    c = F.col
    made = c("original_posts_created") + c("replies_created")
    return total.select(
        *grain, "original_posts_created", "replies_created", "posts_updated", "posts_deleted", "likes_given", "reposts_given", "follows_created", "follows_deleted", "engagements_given",
        made.alias("content_events_created"), "received_likes", "received_reposts", "received_engagements", "unique_posts_engaged", "unique_actors_followed",
        (made * 2 + c("engagements_given") + c("follows_created") + c("received_engagements")).alias("activity_score"), ratio(made, c("engagements_given")).alias("creator_engager_ratio"),
    )


def network_growth_daily(network: DataFrame) -> DataFrame:
    """By day and followed actor: follows, unfollows, followers; an unknown target is a group of its own."""
    made = F.col("network_event_type") == "follow_create"
    days = network.groupBy(F.to_date("event_time").alias("activity_date"), "target_actor_did").agg(
        count_where(made).alias("follow_count"), count_where(F.col("network_event_type") == "follow_delete").alias("unfollow_count"), F.count_distinct(F.when(made, F.col("actor_did"))).alias("unique_follower_count"),
        F.min(F.when(made, F.col("event_time"))).alias("first_follow_at"), F.max(F.when(made, F.col("event_time"))).alias("last_follow_at"))
    return days.select("activity_date", "target_actor_did", "follow_count", "unfollow_count", (F.col("follow_count") - F.col("unfollow_count")).alias("net_follow_count"), "unique_follower_count", "first_follow_at", "last_follow_at")


def event_volume_by_type(posts: DataFrame, engagements: DataFrame, follows: DataFrame, deletes: DataFrame) -> DataFrame:
    """Events of each Silver type; updates of posts count as posts."""
    kinds = [posts.select(F.lit("post").alias("event_type")), engagements.select(F.col("engagement_type").alias("event_type")), follows.select(F.lit("follow").alias("event_type")), deletes.select(F.lit("deleted_record").alias("event_type"))]
    return union(kinds).groupBy("event_type").agg(F.count("*").alias("event_count"))


def post_engagement_rows(posts: DataFrame, engagements: DataFrame) -> DataFrame:
    """By Silver post row (an updated post has several): engagement counts of its uri, zero if none."""
    counts = engagements.groupBy(F.col("subject_uri").alias("post_uri")).agg(*kind_counts("engagement_type", ENGAGEMENTS), F.count("*").alias("engagement_count"))
    return posts.join(counts, "post_uri", "left").select(
        "post_uri", F.col("cid").alias("post_cid"), "author_did", F.col("text").alias("post_text"), F.col("record_created_at").alias("post_created_at"),
        zero("like_count").alias("like_count"), zero("repost_count").alias("repost_count"), zero("engagement_count").alias("engagement_count"), "ingest_date", "ingest_hour",
    )


#: name -> builder from Silver tables s and modelled tables g
BUILDERS = {
    "post_performance": lambda s, g: post_performance(g["dim_posts"], g["fact_engagement_events"]),
    "content_quality_hourly": lambda s, g: content_quality_hourly(g["fact_content_events"], g["dim_posts"]),
    "thread_conversation_summary": lambda s, g: thread_conversation_summary(g["dim_posts"], g["fact_content_events"]),
    "actor_activity_daily": lambda s, g: actor_activity_daily(g["dim_actors"], g["dim_posts"], g["fact_content_events"], g["fact_engagement_events"], g["fact_network_events"]),
    "network_growth_daily": lambda s, g: network_growth_daily(g["fact_network_events"]),
    "event_volume_by_type": lambda s, g: event_volume_by_type(s["silver_posts"], s["silver_engagements"], s["silver_follows"], s["silver_deleted_records"]),
    "post_engagement_rows": lambda s, g: post_engagement_rows(s["silver_posts"], s["silver_engagements"]),
}


def build_all(s: Mapping[str, DataFrame], g: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """All marts."""
    return {name: build(s, g) for name, build in BUILDERS.items()}
