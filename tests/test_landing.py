"""Landing: work is dealt out whatever the files of the input are like, and JSON is parsed once a row."""

import pyarrow.parquet as pq
import pytest
from helpers import FOLLOW, LIKE, POST, event, messages, rows, subject
from pyspark.sql import functions as F

from eventlake.operators import bronze, quarantine, silver
from eventlake.sources.fixture import kafka_messages
from eventlake.streaming import realtime

EVENTS = [event(0, "did:a", "create", POST, "1", text="x"), event(1, "did:b", "create", LIKE, "2", subject=subject("at://did:a/p/1")), event(2, "did:b", "delete", FOLLOW, "3"), event(3, "x", "create", POST, "", created="no time")]


def test_rows_of_one_row_group_are_dealt_to_all_tasks(spark, tmp_path):
    events = pq.read_table("/root/testdata/sf0.001/events.parquet")
    pq.write_table(events, tmp_path / "events.parquet", row_group_size=len(events))
    kept = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for k in kept:
            spark.conf.set(k, "1000")  # far more splits than tasks, but one alone has the row group
        held = [r["count"] for r in kafka_messages(spark, str(tmp_path)).groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    assert sum(held) == len(events) and len(held) >= spark.sparkContext.defaultParallelism and max(held) < len(events) // 2


def parses(df) -> int:
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return sum(plan.count(name) for name in ("from_json", "jsontostructs"))


@pytest.mark.parametrize("name", list(silver.TABLES))
def test_silver_parses_envelope_and_commit_once(spark, name):
    commits = bronze.family(bronze.to_bronze(messages(spark, EVENTS)), "commit")
    assert parses(silver.TABLES[name](commits)) <= 2


def test_rules_and_metrics_parse_once(spark):
    landed = messages(spark, EVENTS)
    judged = quarantine.judged(bronze.family(bronze.to_bronze(landed), "commit"))
    assert parses(quarantine.rejected(judged)) == 2 and parses(quarantine.counts(judged)) == 2
    assert parses(realtime.classified(landed)) == 1
    assert [r["offset"] for r in quarantine.rejected(judged).collect()] == [3]


def test_bronze_gives_the_messages_back(spark):
    landed = messages(spark, EVENTS)
    again = bronze.to_messages(bronze.to_bronze(landed))
    assert again.schema.simpleString() == landed.schema.simpleString() and rows(again) == rows(landed)
