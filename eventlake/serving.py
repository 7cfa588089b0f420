"""Queries of the serving side: previews of marts and views over one-minute metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.operators.scope import union
from eventlake.streaming.realtime import METRICS

#: mart -> (order, rows): every order ends in the grain, so ties can't reorder.
PREVIEWS = {
    "post_performance": (["engagement_score DESC", "engagement_count DESC", "post_uri"], 20),
    "content_quality_hourly": (["window_start DESC"], 24),
    "thread_conversation_summary": (["reply_count DESC", "reply_author_count DESC", "reply_root_uri"], 20),
    "actor_activity_daily": (["activity_score DESC", "activity_date DESC", "actor_did"], 20),
    "network_growth_daily": (["net_follow_count DESC", "follow_count DESC", "activity_date DESC", "target_actor_did ASC NULLS LAST"], 20),
    "post_engagement_rows": (["engagement_count DESC", "post_uri", "post_cid"], 20),
}


def preview(mart: str, df: DataFrame) -> DataFrame:
    """The top rows of a mart."""
    order, n = PREVIEWS[mart]
    return df.orderBy(*[F.expr(o.split()[0]).desc() if " DESC" in o else F.expr(o.split()[0]).asc_nulls_last() for o in order]).limit(n)


def all_metrics(m: dict[str, DataFrame]) -> DataFrame:
    """(metric_group, window_start, metric_name, metric_count) of the four metrics."""
    return union([m[k].select(F.lit(k).alias("metric_group"), "window_start", F.col(name).alias("metric_name"), F.col(count).alias("metric_count")) for k, (name, count) in METRICS.items()])


def latest_metrics(m: dict[str, DataFrame], n: int = 60) -> DataFrame:
    return all_metrics(m).orderBy(F.desc("window_start"), "metric_group", "metric_name").limit(n)


def metric_summary(m: dict[str, DataFrame]) -> DataFrame:
    """First and last window, rows and total of each metric."""
    return all_metrics(m).groupBy("metric_group").agg(F.min("window_start").alias("first_window"), F.max("window_start").alias("last_window"), F.count("*").alias("row_count"), F.sum("metric_count").alias("total"))


def seconds_since_load(loaded: DataFrame) -> DataFrame:
    """Freshness of a metric table, by its loaded_at."""
    return loaded.agg(F.max("loaded_at").alias("last_loaded_at")).select("last_loaded_at", F.timestamp_diff("SECOND", F.col("last_loaded_at"), F.current_timestamp()).alias("seconds_since_load"))


def event_share(volume: DataFrame, n: int = 30) -> DataFrame:
    """Share of each event type in its minute, in per cent; ties round to even."""
    total = volume.groupBy("window_start").agg(F.sum("event_count").alias("total_event_count"))
    share = F.bround(F.col("event_count") * F.lit(100.0) / F.col("total_event_count"), 2)
    return volume.join(total, "window_start").select("window_start", "event_type", "event_count", "total_event_count", share.alias("share_pct")).orderBy(F.desc("window_start"), F.desc("share_pct"), "event_type").limit(n)


def engagement_to_post_ratio(content: DataFrame, engagement: DataFrame, n: int = 20) -> DataFrame:
    posts = content.groupBy("window_start").agg(F.sum(F.when(F.col("content_activity_type") == "post", F.col("activity_count")).otherwise(0)).alias("post_count"))
    sums = engagement.groupBy("window_start").agg(F.sum("engagement_count").alias("engagement_count"))
    ratio = F.bround(F.col("engagement_count").cast("double") / F.col("post_count"), 2)
    return posts.where("post_count > 0").join(sums, "window_start").select("window_start", "post_count", "engagement_count", ratio.alias("engagement_to_post_ratio")).orderBy(F.desc("window_start")).limit(n)


def net_follows(network: DataFrame, n: int = 20) -> DataFrame:
    part = lambda kind: F.sum(F.when(F.col("network_activity_type") == kind, F.col("activity_count")).otherwise(0))
    out = network.groupBy("window_start").agg(part("follow").alias("follow_count"), part("unfollow").alias("unfollow_count"))
    return out.withColumn("net_follow_count", F.col("follow_count") - F.col("unfollow_count")).orderBy(F.desc("window_start")).limit(n)


def batch_summary(batches: DataFrame) -> DataFrame:
    return batches.agg(
        F.count("*").alias("batch_count"), F.max("spark_batch_id").alias("max_batch_id"), F.sum(F.col("is_empty").cast("long")).alias("empty_batches"),
        F.bround(F.avg("batch_duration_ms"), 2).alias("avg_duration_ms"), F.max("batch_duration_ms").alias("max_duration_ms"), F.sum("input_rows").alias("total_input_rows"))


def latest_batches(batches: DataFrame, n: int = 20) -> DataFrame:
    return batches.orderBy(F.desc("spark_batch_id")).limit(n)


def minute_reply_counts(content: DataFrame, dim_posts: DataFrame) -> DataFrame:
    """Content events by minute and by whether their post is a reply."""
    minute = F.date_trunc("minute", "event_time").cast("timestamp_ntz").alias("minute")
    return content.select("post_uri", minute).join(dim_posts.select("post_uri", "is_reply"), "post_uri").groupBy("minute", "is_reply").agg(F.count("*").alias("total_content_events"))


def reply_vs_original(performance: DataFrame) -> DataFrame:
    """Engagement of replies against original posts."""
    return performance.where(F.col("is_reply").isNotNull()).groupBy("is_reply").agg(F.count("*").alias("post_count"), F.sum("like_count").alias("like_count"), F.sum("repost_count").alias("repost_count"), F.sum("engagement_score").alias("engagement_score"))


def ttfe_distribution(performance: DataFrame) -> DataFrame:
    """Posts by time to first engagement."""
    s = F.col("time_to_first_engagement_seconds")
    bucket = F.when(s < 0, "before").when(s < 60, "under 1 minute").when(s < 3600, "under 1 hour").when(s < 86400, "under 1 day").otherwise("1 day or more")
    return performance.where(s.isNotNull()).groupBy(bucket.alias("bucket")).agg(F.count("*").alias("post_count"))


def lifecycle_hourly(hourly: DataFrame) -> DataFrame:
    """Creates, updates and deletes by hour, of posts and replies together."""
    c = F.col
    return hourly.select("window_start", (c("original_post_create_count") + c("reply_create_count")).alias("creates"), (c("post_update_count") + c("reply_update_count")).alias("updates"), (c("post_delete_count") + c("reply_delete_count")).alias("deletes"))


def engagement_mix(engagements: DataFrame) -> DataFrame:
    """Likes and reposts by day."""
    return engagements.groupBy(F.to_date("event_time").alias("activity_date"), "engagement_type").agg(F.count("*").alias("engagement_count"))
