"""The sample of raw events, and what a Kafka stream is asked for."""

import json

import pytest
from helpers import FOLLOW, POST, event, rows

from eventlake.sources.probe import write_normalized, write_sample
from eventlake.sources.readers import kafka_options, read_lines, stream_kafka


def test_sample_is_enveloped_appended_and_counted(spark, tmp_path):
    events = [event(1, "did:a", "create", POST, "p", text="one"), event(2, "did:a", "create", POST, "q"), event(3, "did:a", "delete", FOLLOW, "f")]
    raw = [json.dumps(json.loads(e["value"])["payload"]) for e in events] + [json.dumps({"did": "did:b", "time_us": 4, "kind": "identity"})]
    frame = spark.createDataFrame([(r,) for r in raw], "value string")
    counts = write_sample(frame, f"{tmp_path}/sample")
    expected = [(POST, "create", 2), (FOLLOW, "delete", 1), (None, None, 1)]
    assert sorted(map(tuple, counts.collect()), key=str) == sorted(expected, key=str)
    assert write_sample(frame, f"{tmp_path}/sample", most=2).groupBy().sum("event_count").first()[0] == 2
    lines = read_lines(spark, f"{tmp_path}/sample")
    found = [json.loads(r.value) for r in lines.collect()]
    assert len(found) == 6 and all(f["payload"]["did"] == f["repository_did"] and f["received_at"] for f in found)
    write_normalized(lines, f"{tmp_path}/flat")
    flat = [json.loads(r.value) for r in read_lines(spark, f"{tmp_path}/flat").collect()]
    assert len(flat) == 6 and all("subject_uri" in f for f in flat) and "one" in {f["text"] for f in flat}
    assert rows(write_sample(frame.limit(0), f"{tmp_path}/none")) == []


def test_kafka_options(spark):
    assert kafka_options("h:9092", "raw") == {"kafka.bootstrap.servers": "h:9092", "subscribe": "raw", "startingOffsets": "earliest", "maxOffsetsPerTrigger": "5000"}
    assert kafka_options("h:9092", "raw", "latest", 7)["startingOffsets"] == "latest" and kafka_options("h:9092", "raw", "latest", 7)["maxOffsetsPerTrigger"] == "7"
    try:
        stream = stream_kafka(spark, "h:9092", "raw", "latest")
    except Exception as e:
        if "kafka" not in str(e).lower():
            raise
        pytest.skip("Spark's Kafka package isn't on the class path")
    assert stream.isStreaming and stream.columns == ["key", "value", "topic", "partition", "offset", "timestamp"]
