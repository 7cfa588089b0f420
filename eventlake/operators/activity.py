"""Sessions, sliding velocity and first engagements: the same functions over tables and, with a watermark, over streams.

Times are those of the event stream itself (``jetstream_time_us``), which no client can set.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake.functions.columns import ratio


def stream_time() -> Column:
    return F.timestamp_micros("jetstream_time_us")


def stamped(df: DataFrame, delay: str | None = None) -> DataFrame:
    """``df`` with the time ``at`` of each event; with ``delay``, watermarked: a stream then takes events up to that late and forgets older state."""
    out = df.withColumn("at", stream_time())
    return out.withWatermark("at", delay) if delay else out


def wall(column: str | Column) -> Column:
    """A time as UTC wall-clock time, as the other tables have it (sessions are in UTC)."""
    return (F.col(column) if isinstance(column, str) else column).cast("timestamp_ntz")


def actor_sessions(commits: DataFrame, gap_minutes: int = 30, delay: str | None = None) -> DataFrame:
    """Runs of an actor's events with at most ``gap_minutes`` between neighbours: actor_did, started_at, ended_at, seconds, event_count, creates, deletes.

    A task sums up its part of a session before rows are shuffled.  In a stream a session comes out once the watermark has passed its gap.
    Events without an actor or time belong to no session.
    """
    rows = stamped(commits, delay).where("repository_did IS NOT NULL AND at IS NOT NULL")
    session = F.session_window("at", f"{gap_minutes} minutes").alias("s")
    out = rows.groupBy(session, "repository_did").agg(
        F.min("at").alias("first"), F.max("at").alias("last"), F.count("*").alias("event_count"),
        F.count_if(F.col("operation") == "create").alias("creates"), F.count_if(F.col("operation") == "delete").alias("deletes"))
    seconds = (F.unix_micros("last") - F.unix_micros("first")) / 1e6
    return out.select(F.col("repository_did").alias("actor_did"), wall("first").alias("started_at"), wall("last").alias("ended_at"), seconds.alias("seconds"), "event_count", "creates", "deletes")


def sliding_counts(commits: DataFrame, minutes: int = 10, slide: int = 5, delay: str | None = None) -> DataFrame:
    """window_start, collection, event_count of each window of ``minutes`` that begins every ``slide`` minutes and has events."""
    window = F.window("at", f"{minutes} minutes", f"{slide} minutes").alias("w")
    counts = stamped(commits, delay).where("at IS NOT NULL").groupBy(window, "collection").agg(F.count("*").alias("event_count"))
    return counts.select(wall("w.start").alias("window_start"), "collection", "event_count")


def velocity(counts: DataFrame, minutes: int = 10) -> DataFrame:
    """Sliding counts with their rate and growth over the window that ended where they begin (0 without one)."""
    before = counts.select((F.col("window_start") + F.make_dt_interval(mins=F.lit(minutes))).alias("window_start"), "collection", F.col("event_count").alias("before"))
    both = counts.join(before, ["window_start", "collection"], "left").withColumn("before", F.coalesce("before", F.lit(0)).cast("long"))
    growth = F.col("event_count") - F.col("before")
    return both.select("window_start", "collection", "event_count", (F.col("event_count") / F.lit(float(minutes))).alias("per_minute"), "before", growth.alias("growth"), ratio(growth, F.col("before")).alias("growth_ratio"))


def engagement_pairs(posts: DataFrame, engagements: DataFrame, within_minutes: int = 60, delay: str | None = None) -> DataFrame:
    """Each created post with each engagement of its uri from then on up to ``within_minutes``; a post without any has one row of nulls.

    In a stream both sides are watermarked, so state is kept for that long only, and a row of nulls comes out when no engagement can come any more.
    """
    p = stamped(posts.where("operation = 'create'"), delay).select("post_uri", F.col("at").alias("posted_at"))
    e = stamped(engagements, delay).select("subject_uri", "engagement_uri", "engagement_type", F.col("at").alias("engaged_at"))
    near = (F.col("engaged_at") >= F.col("posted_at")) & (F.col("engaged_at") <= F.col("posted_at") + F.expr(f"INTERVAL {within_minutes} MINUTES"))
    pairs = p.join(e, (p["post_uri"] == e["subject_uri"]) & near, "left_outer")
    return pairs.select("post_uri", "posted_at", "engagement_uri", "engagement_type", "engaged_at")


def first_engagements(pairs: DataFrame) -> DataFrame:
    """post_uri, posted_at and the first engagement of each post: when, by what, after how many seconds; ties go to the least uri."""
    first = F.min(F.when(F.col("engaged_at").isNotNull(), F.struct("engaged_at", "engagement_uri", "engagement_type"))).alias("f")
    out = pairs.groupBy("post_uri", "posted_at").agg(first)
    seconds = (F.unix_micros("f.engaged_at") - F.unix_micros("posted_at")) / 1e6
    return out.select("post_uri", wall("posted_at").alias("posted_at"), wall("f.engaged_at").alias("engaged_at"), "f.engagement_uri", "f.engagement_type", seconds.alias("seconds"))
