"""Streams equal batches, and a batch delivered again changes nothing."""

from helpers import FOLLOW, LIKE, POST, event, messages, reply_to, rows, silver_of, subject, uri

from eventlake import serving
from eventlake.operators import bronze, silver
from eventlake.sources.readers import land_messages, read_bronze, read_lines, read_messages, serving_rows, stream_bronze, stream_messages, write_mart
from eventlake.streaming import lake, realtime
from eventlake.tables import Catalog

A, B = "did:a", "did:b"
ROOT = uri(B, "root")
EVENTS = [
    event(1, A, "create", POST, "p", 0, text="one"), event(2, A, "create", POST, "q", 0.5, text="two", reply=reply_to(ROOT)), event(3, A, "update", POST, "p", 1, text="three"), event(4, A, "delete", POST, "p", 1.2),
    event(5, B, "create", LIKE, "l", 2, subject=subject(uri(A, "p"))), event(6, B, "create", FOLLOW, "f", 2, subject=A), event(7, B, "delete", FOLLOW, "f", 3), event(8, B, "create", "app.other", "x", 3),
    event(9, B, "delete", "app.other", "x", 3), event(10, A, "create", "none", "x", 3, kind="identity"), event(11, A, "create", "none", "x", 3, kind="account"), event(12, A, "create", "none", "x", 3, kind="odd"),
]


def test_bronze_and_silver_streams_equal_batches_and_replay_is_harmless(spark, tmp_path):
    root = f"file://{tmp_path}"
    for part in (EVENTS[:5], EVENTS[5:]):
        land_messages(messages(spark, part), f"{root}/topic")
    assert read_messages(spark, f"{root}/topic").count() == len(EVENTS) and read_lines(spark, f"{root}/topic", 2).count() == 2
    for q in lake.bronze_streams(stream_messages(spark, f"{root}/topic", max_files=2), f"{root}/bronze", f"{root}/check/bronze", lake.ONCE):
        q.awaitTermination()
    found = read_bronze(spark, f"{root}/bronze/commit")
    assert found.count() == 9 and spark.read.parquet(f"{root}/bronze/identity").count() == 1 and spark.read.parquet(f"{root}/bronze/account").count() == 1
    tables = Catalog(spark, f"{root}/lake")
    lake.silver_stream(stream_bronze(spark, f"{root}/bronze/commit"), tables, f"{root}/check/silver", lake.ONCE).awaitTermination()
    expected = silver_of(spark, EVENTS)
    for name in silver.TABLES:
        assert rows(tables.table(name).read()) == rows(expected[name])
    again = lake.silver_batch(tables, "silver")
    again(found, 0)
    again(found.limit(0), 7)
    for name in silver.TABLES:
        assert rows(tables.table(name).read()) == rows(expected[name])
    lake.build_silver(found, tables)
    assert rows(tables.table("silver_posts").read()) == rows(expected["silver_posts"])


def test_realtime_metrics(spark, tmp_path):
    root = f"file://{tmp_path}/rt"
    land_messages(messages(spark, EVENTS), f"file://{tmp_path}/topic")
    realtime.realtime_stream(stream_messages(spark, f"file://{tmp_path}/topic"), root, f"file://{tmp_path}/check", lake.ONCE).awaitTermination()
    write = realtime.metrics_batch(root)
    first = rows(realtime.read_metric(spark, root, "event_volume"))
    write(messages(spark, EVENTS), 0)  # the same batch again
    assert rows(realtime.read_metric(spark, root, "event_volume")) == first
    write(messages(spark, []), 5)
    m = {name: realtime.read_metric(spark, root, name) for name in realtime.METRICS}
    total = lambda name: {r[0]: r[1] for r in m[name].groupBy(realtime.METRICS[name][0]).sum(realtime.METRICS[name][1]).collect()}
    assert total("event_volume") == {"post": 3, "like": 1, "follow": 1, "deleted_record": 3}
    assert total("content_activity") == {"post": 2, "original_post": 1, "reply": 1, "post_update": 1, "post_delete": 1}
    assert total("engagement") == {"like": 1, "reply": 1} and total("network_activity") == {"follow": 1, "unfollow": 1}
    batches = realtime.read_batches(spark, root)
    assert rows(batches, "spark_batch_id", "input_rows", "is_empty") == [(0, 12, False), (5, 0, True)]
    s = serving.batch_summary(batches).first()
    assert (s.batch_count, s.max_batch_id, s.empty_batches, s.total_input_rows) == (2, 5, 1, 12)
    assert serving.latest_batches(batches).first().spark_batch_id == 5
    assert serving.seconds_since_load(spark.read.parquet(f"{root}/event_volume")).first().seconds_since_load >= 0


def test_watermarked_mode_runs_statefully(spark, tmp_path):
    land_messages(messages(spark, EVENTS), f"file://{tmp_path}/topic")
    counts = realtime.watermarked_counts(realtime.classified(stream_messages(spark, f"file://{tmp_path}/topic")), "event_volume", "1 hour")
    q = counts.writeStream.format("memory").queryName("wm").outputMode("complete").trigger(availableNow=True).option("checkpointLocation", f"file://{tmp_path}/check").start()
    q.awaitTermination()
    expected = realtime.minute_counts(realtime.classified(messages(spark, EVENTS)), "event_volume")
    assert rows(spark.table("wm")) == rows(expected)


def test_profiles_and_serving_rows(spark, tmp_path):
    m = messages(spark, EVENTS)
    assert ("delete", 3) in {(r.operation, r.event_count) for r in bronze.commit_profile(bronze.family(bronze.to_bronze(m), "commit")).groupBy("operation").sum("event_count").withColumnRenamed("sum(event_count)", "event_count").collect()}
    assert {r.has_text for r in bronze.field_matrix(m).where(f"collection = '{POST}' AND operation = 'create'").collect()} == {True}
    df = spark.sql("SELECT true AS is_reply, CAST(NULL AS BOOLEAN) AS is_deleted, TIMESTAMP_NTZ '2024-01-01 00:00:01.5' AS t, DATE '2024-01-02' AS d, 1.5D AS x")
    assert rows(serving_rows(df)) == [(1, 0, "2024-01-01 00:00:01", "2024-01-02", 1.5)]
    for kind in ("parquet", "csv", "json"):
        write_mart(df, f"file://{tmp_path}/{kind}", kind, ["x"])
        assert spark.read.format(kind).option("header", "true").load(f"file://{tmp_path}/{kind}").count() == 1
