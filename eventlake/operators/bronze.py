"""Envelopes and Bronze: from raw events to typed, partitioned rows that keep the raw JSON."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake.functions.columns import _col, once
from eventlake.model import ENVELOPE, RAW_EVENT, SCHEMA_VERSION, SOURCE

FAMILIES = ("commit", "identity", "account")


def build_envelope(raw: str | Column, received_at: Column, source: str = SOURCE) -> Column:
    """Envelope JSON of a raw event's JSON: hoisted fields around the untouched payload.

    A missing commit gives null collection and operation; an empty event nulls throughout, but for
    version, source and time.
    """
    raw = _col(raw)
    event = F.from_json(raw, RAW_EVENT)
    head = F.to_json(F.struct(
        F.lit(SCHEMA_VERSION).alias("schema_version"), F.lit(source).alias("source"), event["kind"].alias("event_kind"), received_at.alias("received_at"),
        event["commit"]["collection"].alias("collection"), event["commit"]["operation"].alias("operation"), event["did"].alias("repository_did"), event["time_us"].alias("jetstream_time_us"),
    ), {"ignoreNullFields": "false"})
    return F.concat(F.substring(head, 1, F.length(head) - 1), F.lit(',"payload":'), raw, F.lit("}"))


def normalize_events(messages: DataFrame, value: str = "value") -> DataFrame:
    """Flat records of envelopes; a subject may be an object (uri and cid) or a string (uri only)."""
    at = lambda path: F.get_json_object(value, "$." + path)
    commit, record = "payload.commit.", "payload.commit.record."
    subject = at(record + "subject")
    is_object = subject.startswith("{")
    return messages.select(
        at("schema_version").cast("long").alias("schema_version"), at("source").alias("source"), at("received_at").alias("received_at"), at("repository_did").alias("repository_did"),
        at("jetstream_time_us").cast("long").alias("jetstream_time_us"), at("collection").alias("collection"), at("operation").alias("operation"), at(commit + "rkey").alias("rkey"),
        at(commit + "cid").alias("cid"), F.get_json_object(value, "$.payload.commit.record['$type']").alias("record_type"), at(record + "createdAt").alias("record_created_at"), at(record + "text").alias("text"),
        F.when(is_object, at(record + "subject.uri")).otherwise(subject).alias("subject_uri"), F.when(is_object, at(record + "subject.cid")).alias("subject_cid"), at("payload").alias("raw_event"),
    )


def to_bronze(messages: DataFrame) -> DataFrame:
    """Bronze rows of topic messages (key, value, topic, partition, offset, timestamp); ingest time is the broker's."""
    stamp = F.col("timestamp").cast("timestamp")
    return once(messages.select(
        F.col("key").cast("string").alias("message_key"), F.col("value").cast("string").alias("message_value"),
        "topic", "partition", "offset", stamp.alias("kafka_timestamp"), F.to_date(stamp).alias("ingest_date"), F.date_format(stamp, "HH").alias("ingest_hour"),
    ), "e", F.from_json("message_value", ENVELOPE)).select(
        "message_key", "message_value", "e.schema_version", "e.source", "e.event_kind", "e.received_at", "e.operation", "e.repository_did", "e.jetstream_time_us",
        "topic", "partition", "offset", "kafka_timestamp", "ingest_date", "ingest_hour", "e.collection",
    )


def to_messages(bronze: DataFrame) -> DataFrame:
    """The topic messages that Bronze rows were made from."""
    return bronze.select(F.col("message_key").alias("key"), F.col("message_value").alias("value"), "topic", "partition", "offset", F.col("kafka_timestamp").alias("timestamp"))


def family(bronze: DataFrame, kind: str) -> DataFrame:
    """Rows of one event kind; other and missing kinds belong to no family.  Only commits have a collection."""
    rows = bronze.where(F.col("event_kind") == kind)
    return rows if kind == "commit" else rows.drop("collection")


def commit_profile(commits: DataFrame) -> DataFrame:
    """Events by collection and operation."""
    return commits.groupBy("collection", "operation").agg(F.count("*").alias("event_count"))


def field_matrix(messages: DataFrame) -> DataFrame:
    """Which fields occur together, by collection and operation."""
    n = normalize_events(messages)
    has = {"has_rkey": "rkey", "has_cid": "cid", "has_record": "record_type", "has_created_at": "record_created_at", "has_text": "text", "has_subject_uri": "subject_uri", "has_subject_cid": "subject_cid"}
    flags = [F.col(c).isNotNull().alias(k) for k, c in has.items()]
    return n.where(F.col("collection").isNotNull()).select("collection", "operation", *flags).groupBy("collection", "operation", *has).agg(F.count("*").alias("event_count"))


def sample_profile(messages: DataFrame, value: str = "value") -> DataFrame:
    """(profile, name, event_count): collections, operations, record types, shapes of subjects, and sets of record fields."""
    record = F.get_json_object(value, "$.payload.commit.record")
    subject = F.get_json_object(value, "$.payload.commit.record.subject")
    shape = F.when(subject.isNull(), "missing").when(subject.startswith("{"), "object").otherwise("string")
    facts = {
        "collection": F.get_json_object(value, "$.collection"), "operation": F.get_json_object(value, "$.operation"),
        "record_type": F.coalesce(F.get_json_object(value, "$.payload.commit.record['$type']"), F.lit("missing")), "subject": shape, "fields": F.array_join(F.array_sort(F.json_object_keys(record)), ","),
    }
    rows = messages.select(F.explode(F.array(*[F.struct(F.lit(k).alias("profile"), v.alias("name")) for k, v in facts.items()])).alias("x"))
    return rows.groupBy("x.profile", "x.name").agg(F.count("*").alias("event_count"))
