"""Hand-written events with literal results: envelopes, Silver, dimensions, facts and marts."""

from datetime import date, datetime, timedelta

from helpers import FOLLOW, LIKE, POST, REPOST, T0, event, messages, reply_to, rows, silver_of, subject, uri
from pyspark.sql import functions as F

from eventlake.functions.columns import utc
from eventlake.model import SILVER
from eventlake.operators import bronze, marts, modeled
from eventlake.operators.scope import exclude, latest_by, received_between, restrict

A, B, C = "did:a", "did:b", "did:c"


def at(minutes: float) -> datetime:
    return T0 + timedelta(minutes=minutes)


def test_envelope_of_create_delete_missing_commit_and_empty(spark):
    raw = ['{"did":"d","time_us":5,"kind":"commit","commit":{"operation":"create","collection":"c","record":{"text":"é"}}}', '{"did":"d","time_us":6,"commit":{"operation":"delete","collection":"c"}}', '{"did":"d","time_us":7,"kind":"identity"}', "{}"]
    df = spark.createDataFrame([(x,) for x in raw], "raw string")
    e = df.select("raw", bronze.build_envelope("raw", F.lit("now"), "src").alias("value"))
    got = e.select("raw", F.from_json("value", "schema_version long, source string, event_kind string, received_at string, collection string, operation string, repository_did string, jetstream_time_us long").alias("e"), F.get_json_object("value", "$.payload").alias("payload")).select("raw", "payload", "e.*").collect()
    by = {r.raw: r for r in got}
    assert all(r.payload == r.raw and r.schema_version == 1 and r.source == "src" and r.received_at == "now" for r in got)
    assert (by[raw[0]].event_kind, by[raw[0]].collection, by[raw[0]].operation) == ("commit", "c", "create")
    assert (by[raw[1]].event_kind, by[raw[1]].operation) == (None, "delete")
    assert (by[raw[2]].event_kind, by[raw[2]].collection) == ("identity", None)
    assert (by[raw[3]].event_kind, by[raw[3]].repository_did, by[raw[3]].jetstream_time_us) == (None, None, None)


def test_normalised_subjects_and_malformed_lines(spark):
    events = [event(1, A, "create", LIKE, "l", subject=subject("at://x")), event(2, A, "create", FOLLOW, "f", subject="did:x"), event(3, A, "create", POST, "p", text="hi")]
    bad = dict(event(4, A, "create", POST, "q"), value="{not json")
    got = rows(bronze.normalize_events(messages(spark, [*events, bad])), "rkey", "subject_uri", "subject_cid", "text", "record_type")
    assert got == sorted([("l", "at://x", "x", None, LIKE), ("f", "did:x", None, None, FOLLOW), ("p", None, None, "hi", POST), (None, None, None, None, None)], key=str)
    families = bronze.to_bronze(messages(spark, [*events, bad]))
    assert bronze.family(families, "commit").count() == 3 and bronze.family(families, "identity").count() == 0


def test_silver_schemas_and_a_follow_read_as_an_object(spark):
    s = silver_of(spark, [event(1, A, "create", LIKE, "l", subject="did:x"), event(2, A, "create", FOLLOW, "f", subject={"uri": "u"})])
    from pyspark.sql.types import _parse_datatype_string

    for name, df in s.items():
        assert df.dtypes == [(f.name, f.dataType.simpleString()) for f in _parse_datatype_string(SILVER[name])]
    assert rows(s["silver_engagements"], "subject_uri") == [(None,)]


def test_utc_of_offsets_and_malformed_text(spark):
    df = spark.createDataFrame([("2024-01-01T00:00:00Z",), ("2024-01-01T02:00:00+02:00",), ("yesterday",), (None,)], "t string")
    assert [r[0] for r in df.select(utc("t")).collect()] == [datetime(2024, 1, 1)] * 2 + [None] * 2


def test_latest_breaks_ties_and_puts_nulls_last(spark):
    df = spark.createDataFrame([("k", 1, "b", "create"), ("k", 1, "a", "create"), ("k", None, "z", "create"), ("j", None, None, "create")], "post_uri string, jetstream_time_us long, received_at string, operation string")
    assert rows(latest_by(df, "post_uri"), "post_uri", "received_at") == [("j", None), ("k", "b")]


def test_posts_deleted_recreated_and_seen_only_as_deletes_or_targets(spark):
    p, q, t = uri(A, "p"), uri(A, "q"), uri(B, "t")
    s = silver_of(spark, [
        event(1, A, "create", POST, "p", 0, text="one"), event(2, A, "delete", POST, "p", 5), event(3, A, "create", POST, "p", 10, text="three"), event(4, A, "update", POST, "p", 20, text="fours", created=None),
        event(5, A, "delete", POST, "q", 6), event(6, C, "create", LIKE, "l", 7, subject=subject(t)), event(7, C, "create", REPOST, "r", -3, subject=subject(p)), event(8, C, "create", LIKE, "n", 7),
    ])
    g = modeled.build_all(s)
    dim = {r.post_uri: r for r in g["dim_posts"].collect()}
    assert set(dim) == {p, q}
    assert (dim[p].post_text, dim[p].text_length, dim[p].is_deleted, dim[p].deleted_at, dim[p].post_created_at) == ("fours", 5, True, at(5), None)
    assert (dim[p].first_seen_at, dim[p].last_seen_at) == (at(0), at(20))
    assert (dim[q].author_did, dim[q].is_reply, dim[q].is_deleted) == (None, False, True)
    perf = {r.post_uri: r for r in marts.post_performance(g["dim_posts"], g["fact_engagement_events"]).collect()}
    assert set(perf) == {p, q, t}  # an engagement without target counts nowhere
    assert (perf[t].like_count, perf[t].is_deleted, perf[t].author_did) == (1, None, None)
    assert (perf[p].repost_to_like_ratio, perf[p].engagement_score, perf[p].time_to_first_engagement_seconds) == (None, 2, None)
    assert (perf[q].engagement_count, perf[q].post_lifetime_seconds) == (0, None)


def test_negative_seconds_before_creation(spark):
    p = uri(A, "p")
    s = silver_of(spark, [event(1, A, "create", POST, "p", 0, text="x"), event(2, B, "create", LIKE, "l", -2, subject=subject(p)), event(3, B, "create", LIKE, "m", 3, created="not-a-time", subject=subject(p))])
    g = modeled.build_all(s)
    r = marts.post_performance(g["dim_posts"], g["fact_engagement_events"]).first()
    assert (r.time_to_first_engagement_seconds, r.last_engagement_at, r.engagement_actor_count) == (-120, at(3), 1)


def test_deletes_take_their_kind_and_root_from_the_latest_state(spark):
    root = uri(B, "root")
    s = silver_of(spark, [event(1, A, "create", POST, "p", 0, text="x", reply=reply_to(root)), event(2, A, "delete", POST, "p", 1), event(3, A, "delete", POST, "other", 2), event(4, A, "update", POST, "p", 0.5, text="xyz", reply=reply_to(root))])
    g = modeled.build_all(s)
    assert rows(g["fact_content_events"], "content_event_type", "reply_root_uri") == sorted([("reply_create", root), ("reply_update", root), ("reply_delete", root), ("post_delete", None)], key=str)
    t = marts.thread_conversation_summary(g["dim_posts"], g["fact_content_events"]).first()
    assert (t.reply_root_uri, t.reply_count, t.deleted_reply_count, t.avg_reply_text_length, t.root_author_did, t.conversation_duration_seconds) == (root, 1, 1, 3.0, None, None)
    h = marts.content_quality_hourly(g["fact_content_events"], g["dim_posts"]).first()
    assert (h.window_start, h.reply_create_count, h.reply_delete_count, h.post_delete_count, h.total_content_events, h.reply_ratio, h.delete_ratio, h.avg_text_length) == (T0, 1, 1, 1, 4, 1.0, 0.5, 3.0)


def test_unknown_unfollows_share_a_null_target(spark):
    s = silver_of(spark, [event(1, A, "create", FOLLOW, "f", 0, subject=B), event(2, A, "delete", FOLLOW, "f", 1), event(3, A, "delete", FOLLOW, "g", 2), event(4, C, "delete", FOLLOW, "h", 3)])
    g = modeled.build_all(s)
    got = rows(marts.network_growth_daily(g["fact_network_events"]), "activity_date", "target_actor_did", "follow_count", "unfollow_count", "net_follow_count")
    assert got == sorted([(date(2024, 5, 1), B, 1, 1, 0), (date(2024, 5, 1), None, 0, 2, -2)], key=str)
    assert {r.actor_did: r.source_event_count for r in g["dim_actors"].collect()} == {A: 3, B: 1, C: 1}


def test_actor_days_split_at_midnight_and_count_what_is_received(spark):
    p = uri(B, "p")
    midnight = 14 * 60
    s = silver_of(spark, [event(1, B, "create", POST, "p", 0, text="x"), event(2, A, "create", LIKE, "l", midnight - 1, subject=subject(p)), event(3, A, "create", LIKE, "m", midnight, subject=subject(p))])
    g = modeled.build_all(s)
    m = marts.build_all(s, g)["actor_activity_daily"]
    got = rows(m, "activity_date", "actor_did", "engagements_given", "received_likes", "original_posts_created", "activity_score", "creator_engager_ratio")
    d1, d2 = date(2024, 5, 1), date(2024, 5, 2)
    assert got == sorted([(d1, A, 1, 0, 0, 1, 0.0), (d2, A, 1, 0, 0, 1, 0.0), (d1, B, 0, 1, 1, 3, None), (d2, B, 0, 1, 0, 1, None)], key=str)


def test_legacy_summary_has_a_row_for_each_post_event(spark):
    p = uri(A, "p")
    s = silver_of(spark, [event(1, A, "create", POST, "p", 0, text="x"), event(2, A, "update", POST, "p", 1, text="y"), event(3, B, "create", LIKE, "l", 1, subject=subject(p))])
    assert rows(marts.post_engagement_rows(s["silver_posts"], s["silver_engagements"]), "post_cid", "like_count") == [("c1", 1), ("c2", 1)]


def test_keys_scope_and_windows(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "b")], "n int, k string")
    keys = spark.createDataFrame([("a",), (None,), ("a",)], "k string")
    assert rows(restrict(df, keys, ["k"]), "n") == [(1,)] and rows(restrict(df, keys, ["k"], True), "n") == [(1,), (2,)]
    assert rows(exclude(df, keys, ["k"], True), "n") == [(3,)]
    s = silver_of(spark, [event(k, A, "create", POST, f"p{k}", k, text="x") for k in range(4)])["silver_posts"]
    assert rows(received_between(s, at(1), at(3)), "rkey") == [("p1",), ("p2",)]
    assert received_between(s, None, at(3)).count() == 3


def test_latest_by_equals_a_plain_maximum_for_any_rows(spark):
    from hypothesis import HealthCheck, given, settings
    from hypothesis import strategies as st

    row = st.tuples(st.sampled_from("ab"), st.none() | st.integers(0, 3), st.none() | st.sampled_from(["1", "2"]), st.sampled_from(["create", "update"]))

    @settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
    @given(st.lists(row, min_size=1, max_size=12))
    def check(found):
        df = spark.createDataFrame(found, "k string, jetstream_time_us long, received_at string, operation string")
        best = {}
        for r in found:
            rank = (r[1] is not None, r[1] or 0, r[2] is not None, r[2] or "", r[3])
            if r[0] not in best or rank > best[r[0]][0]:
                best[r[0]] = (rank, r)
        assert rows(latest_by(df, "k")) == sorted((tuple(v[1]) for v in best.values()), key=str)

    check()


def test_plans_push_filters_and_scan_once(spark):
    from eventlake.catalog import Lake

    plan = Lake(spark, "/root/testdata/sf0.001").rt["content_activity"]._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1
    s = silver_of(spark, [event(1, A, "create", POST, "p", 0, text="x")])
    latest = latest_by(s["silver_posts"], "post_uri")._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in latest
