"""A first look at raw events: a small enveloped sample with its counters, and the sample as flat records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake.operators.bronze import build_envelope, commit_profile, normalize_events

#: Events of a sample: it is to be looked at, not to be complete.
SAMPLE = 1000


def write_sample(events: DataFrame, path: str, most: int = SAMPLE, received_at: Column | None = None) -> DataFrame:
    """Append up to ``most`` raw events (JSON as ``value``) to ``path``, enveloped, as JSON lines.

    Returns the counters of what was appended: collection, operation, event_count, with nulls where an event has no commit.
    """
    spark = events.sparkSession
    at = received_at if received_at is not None else F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")
    rows = events.limit(most).select(build_envelope("value", at).alias("value")).persist()  # written and counted alike
    try:
        rows.write.mode("append").text(path)
        counts = commit_profile(rows.select(F.get_json_object("value", "$.collection").alias("collection"), F.get_json_object("value", "$.operation").alias("operation")))
        return spark.createDataFrame(counts.collect(), counts.schema)  # as many rows as the sample at most
    finally:
        rows.unpersist()


def write_normalized(sample: DataFrame, path: str) -> None:
    """Flat records of an enveloped sample (``value``) as JSON lines; absent fields are written as nulls."""
    normalize_events(sample).write.mode("overwrite").option("ignoreNullFields", "false").json(path)
