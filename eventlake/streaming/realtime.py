"""One-minute metrics straight from the topic."""

from __future__ import annotations

from collections.abc import Callable
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from eventlake.functions.columns import once, utc
from eventlake.model import FOLLOW, LIKE, POST, REPOST
from eventlake.streaming.lake import EVERY_MINUTE, Trigger

ENVELOPE = (
    "event_kind string, received_at string, collection string, operation string, repository_did string, jetstream_time_us long, "
    "payload struct<commit: struct<record: struct<reply: struct<root: struct<uri: string>>>>>"
)
#: metric -> (name column, count column)
METRICS = {
    "event_volume": ("event_type", "event_count"),
    "content_activity": ("content_activity_type", "activity_count"),
    "engagement": ("engagement_type", "engagement_count"),
    "network_activity": ("network_activity_type", "activity_count"),
}


def classified(messages: DataFrame) -> DataFrame:
    """event_timestamp, event_type, collection, operation, reply_root_uri of commit messages.

    A delete of any collection is a deleted record; other operations on unknown collections are dropped.
    """
    e = once(messages.select(F.col("value").cast("string").alias("value"), F.col("timestamp").cast("timestamp_ntz").alias("at")), "e", F.from_json("value", ENVELOPE)).where(F.col("e.event_kind") == "commit")
    known = F.when(F.col("collection") == POST, "post").when(F.col("collection") == LIKE, "like").when(F.col("collection") == REPOST, "repost").when(F.col("collection") == FOLLOW, "follow")
    rows = e.select(F.coalesce(utc("e.received_at"), F.col("at")).alias("event_timestamp"), "e.collection", "e.operation", F.col("e.payload.commit.record.reply.root.uri").alias("reply_root_uri"))
    return rows.withColumn("event_type", F.when(F.col("operation") == "delete", "deleted_record").otherwise(known)).where(F.col("event_type").isNotNull())


def names_of(metric: str) -> Column:
    """The metric names that one event counts for: none, one or two, without a scan for each."""
    if metric == "event_volume":
        return F.array("event_type")
    on = lambda collection, operation: (F.col("collection") == collection) & (F.col("operation") == operation)
    reply = F.col("reply_root_uri").isNotNull()
    cases = {
        "content_activity": {"post": on(POST, "create"), "original_post": on(POST, "create") & ~reply, "reply": on(POST, "create") & reply, "post_update": on(POST, "update"), "post_delete": on(POST, "delete")},
        "engagement": {"like": on(LIKE, "create"), "repost": on(REPOST, "create"), "reply": on(POST, "create") & reply},
        "network_activity": {"follow": on(FOLLOW, "create"), "unfollow": on(FOLLOW, "delete")},
    }[metric]
    return F.array_compact(F.array(*[F.when(condition, name) for name, condition in cases.items()]))


def minute_counts(events: DataFrame, metric: str) -> DataFrame:
    """(window_start, name, count) by minute of the event's time."""
    name, count = METRICS[metric]
    minute = F.date_trunc("minute", "event_timestamp").cast("timestamp_ntz")
    return events.select(minute.alias("window_start"), F.explode(names_of(metric)).alias(name)).groupBy("window_start", name).agg(F.count("*").alias(count))


def watermarked_counts(events: DataFrame, metric: str, delay: str) -> DataFrame:
    """The stateful alternative: windows with a watermark, so events later than ``delay`` are dropped.  Never the default."""
    name, count = METRICS[metric]
    rows = events.withColumn("event_timestamp", F.col("event_timestamp").cast("timestamp")).withWatermark("event_timestamp", delay)
    rows = rows.select("event_timestamp", F.explode(names_of(metric)).alias(name))
    return rows.groupBy(F.window("event_timestamp", "1 minute"), name).agg(F.count("*").alias(count)).select(F.col("window.start").cast("timestamp_ntz").alias("window_start"), name, count)


def metrics_batch(root: str, clock: Callable[[], datetime] = lambda: datetime.now(UTC)) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function that writes the four metrics and a health row of each batch.

    Each table is partitioned by spark_batch_id and a batch overwrites its own partition, so a batch that runs
    again changes nothing.  An empty batch is still recorded.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        began = clock()
        spark = batch.sparkSession
        batch.persist()  # the source is read once, for the count and for what is classified
        events = classified(batch).persist()
        try:
            written = {}
            n = batch.count()
            for metric in METRICS:
                path = f"{root}/{metric}/spark_batch_id={batch_id}"
                minute_counts(events, metric).withColumn("loaded_at", F.current_timestamp()).coalesce(1).write.mode("overwrite").parquet(path)  # a few rows a minute
                written[metric] = spark.read.parquet(path).count()
        finally:
            events.unpersist()
            batch.unpersist()
        done = clock()
        stamp = lambda t: t.astimezone(UTC).replace(tzinfo=None)
        row = (stamp(began), stamp(done), int((done - began).total_seconds() * 1000), n, *[written[m] for m in METRICS], n == 0, stamp(done))
        schema = "batch_started_at timestamp_ntz, batch_finished_at timestamp_ntz, batch_duration_ms long, input_rows long, event_volume_rows long, content_activity_rows long, engagement_rows long, network_activity_rows long, is_empty boolean, loaded_at timestamp_ntz"
        spark.createDataFrame([row], schema).write.mode("overwrite").parquet(f"{root}/batches/spark_batch_id={batch_id}")

    return write


def realtime_stream(messages: DataFrame, root: str, checkpoint: str, trigger: Trigger = EVERY_MINUTE) -> StreamingQuery:
    return messages.writeStream.foreachBatch(metrics_batch(root)).option("checkpointLocation", checkpoint).trigger(**trigger).queryName("realtime").start()


def read_metric(spark, root: str, metric: str) -> DataFrame:
    """A metric over all batches: equal windows of different batches are added up when read."""
    name, count = METRICS[metric]
    return spark.read.parquet(f"{root}/{metric}").groupBy("window_start", name).agg(F.sum(count).alias(count))


def read_batches(spark, root: str) -> DataFrame:
    return spark.read.parquet(f"{root}/batches").withColumn("spark_batch_id", F.col("spark_batch_id").cast("long"))
