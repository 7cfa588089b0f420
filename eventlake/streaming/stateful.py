"""Stateful streams: each is the batch function under a watermark, written once by a checkpointed query.

State is bounded by the watermark: events later than ``delay`` behind the newest are left out here, and what the batch layer
derives from loads has them.  A query that is started again with its checkpoint goes on where it stopped.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming.query import StreamingQuery

from eventlake.operators import activity
from eventlake.streaming.lake import EVERY_MINUTE, Trigger

#: What tells an event from others, besides its uri.
IDENTITY = ("operation", "jetstream_time_us")


def deduplicated(rows: DataFrame, uri: str | Sequence[str], delay: str) -> DataFrame:
    """One row for each event of a stream, the first that was delivered; keys are forgotten once they are ``delay`` behind the newest event.

    An event that comes again has the time it had, so what comes after its key is forgotten is late and left out, never doubled.
    """
    keys = [uri] if isinstance(uri, str) else list(uri)
    return activity.stamped(rows, delay).dropDuplicatesWithinWatermark([*keys, *IDENTITY]).drop("at")


def sessions(commits: DataFrame, delay: str, gap_minutes: int = 30) -> DataFrame:
    return activity.actor_sessions(commits, gap_minutes, delay)


def sliding_counts(commits: DataFrame, delay: str, minutes: int = 10, slide: int = 5) -> DataFrame:
    """Counts of windows that are over; their growth is derived when they are read (``activity.velocity``)."""
    return activity.sliding_counts(commits, minutes, slide, delay)


def engagement_pairs(posts: DataFrame, engagements: DataFrame, delay: str, within_minutes: int = 60) -> DataFrame:
    """Posts with their engagements within a time, joined as both sides stream in; read with ``activity.first_engagements``."""
    return activity.engagement_pairs(posts, engagements, within_minutes, delay)


def start(rows: DataFrame, path: str, checkpoint: str, name: str, trigger: Trigger = EVERY_MINUTE) -> StreamingQuery:
    """Append finished rows to Parquet; Spark's file sink logs its batches, so one that runs again isn't seen twice."""
    return rows.writeStream.format("parquet").outputMode("append").option("path", path).option("checkpointLocation", checkpoint).trigger(**trigger).queryName(name).start()
