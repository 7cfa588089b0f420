"""Stateful streams equal the batch functions on replays in any order within the watermark, across restarts, with bounded state."""

import random

import pytest
from helpers import FOLLOW, LIKE, POST, REPOST, event, messages, rows, subject, uri

from eventlake.operators import activity, bronze, history, silver
from eventlake.sources.readers import stream_bronze
from eventlake.streaming import lifecycle, stateful
from eventlake.streaming.lake import ONCE

PEOPLE = [f"did:{x}" for x in "abc"]
#: An event long after all others, which moves the watermark past them.
LAST = [event(9998, "did:z", "create", POST, "z", 9000, text="z"), event(9999, "did:z", "create", LIKE, "zz", 9001, subject=subject(uri("did:none", "p")))]


@pytest.fixture(autouse=True)
def one_partition(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def replay(seed: int, n: int = 60) -> list[dict]:
    """Events over three hours, some delivered twice, out of order by up to twenty minutes."""
    r = random.Random(seed)
    out = []
    for k in range(n):
        who, minute = r.choice(PEOPLE), r.uniform(0, 180)
        post = uri(r.choice(PEOPLE), f"k{r.randrange(6)}")
        kind = r.choice(["post", "post", "like", "repost", "follow", "delete"])
        made = {
            "post": lambda: event(k, who, "create", POST, f"k{r.randrange(6)}", minute, text="x"), "like": lambda: event(k, who, "create", LIKE, f"e{k}", minute, subject=subject(post)),
            "repost": lambda: event(k, who, "create", REPOST, f"e{k}", minute, subject=subject(post)), "follow": lambda: event(k, who, "create", FOLLOW, f"f{k}", minute, subject=r.choice(PEOPLE)),
            "delete": lambda: event(k, who, "delete", POST, f"k{r.randrange(6)}", minute),
        }[kind]()
        out += [(minute + r.uniform(0, 20), made)] * r.choice([1, 1, 2])
    return [e for _, e in sorted(out, key=lambda x: x[0] + r.uniform(0, 5))]


class Feed:
    """Bronze commits that arrive file by file, and queries over them that are started anew after each."""

    def __init__(self, spark, tmp_path) -> None:
        self.spark, self.root = spark, f"file://{tmp_path}"

    def land(self, events: list[dict]) -> None:
        bronze.family(bronze.to_bronze(messages(self.spark, events)), "commit").coalesce(1).write.mode("append").parquet(f"{self.root}/bronze")

    def commits(self):
        return stream_bronze(self.spark, f"{self.root}/bronze")

    def run(self, build, name: str):
        query = stateful.start(build(self.commits()), f"{self.root}/{name}", f"{self.root}/check/{name}", name, ONCE)
        query.awaitTermination()
        return query

    def replayed(self, events: list[dict], build, name: str):
        """All rows of a query that was stopped and started again after each third of the events, and the state it held at the end."""
        third = len(events) // 3
        for part in (events[:third], events[third : 2 * third], events[2 * third :], LAST):
            self.land(part)
            query = self.run(build, name)
        held = sum(op["numRowsTotal"] for op in query.lastProgress["stateOperators"])
        return self.spark.read.parquet(f"{self.root}/{name}"), held


def distinct(events: list[dict]) -> list[dict]:
    return list({e["value"]: e for e in events}.values())


def batch(spark, events: list[dict]):
    return bronze.family(bronze.to_bronze(messages(spark, events)), "commit")


def test_deduplicated_stream_equals_the_batch_rule_and_forgets(spark, tmp_path):
    events = replay(1)
    found, held = Feed(spark, tmp_path).replayed(events, lambda c: stateful.deduplicated(silver.engagements(c), "engagement_uri", "30 minutes"), "dedup")
    expected = silver.deduplicated(silver.engagements(batch(spark, distinct([*events, *LAST]))), "engagement_uri")
    assert rows(found, "engagement_uri", "jetstream_time_us") == rows(expected, "engagement_uri", "jetstream_time_us")
    assert len(events) > len(distinct(events)) and held <= 2  # of the replay nothing is left


def test_events_later_than_the_delay_are_left_out_of_the_stream(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    late = event(7777, "did:a", "create", LIKE, "late", 1, subject=subject(uri("did:b", "k1")))
    for part in (replay(2), LAST, [late], [event(8888, "did:z", "create", LIKE, "y", 9002, subject=subject(uri("did:none", "p")))]):
        feed.land(part)
        feed.run(lambda c: stateful.deduplicated(silver.engagements(c), "engagement_uri", "30 minutes"), "dedup")
    uris = {r.engagement_uri for r in spark.read.parquet(f"{feed.root}/dedup").collect()}
    assert uri("did:a", "late", LIKE) not in uris and uri("did:z", "y", LIKE) in uris


def test_interval_join_equals_the_batch_join(spark, tmp_path):
    events = distinct(replay(3, 80))
    found, _ = Feed(spark, tmp_path).replayed(events, lambda c: stateful.engagement_pairs(silver.posts(c), silver.engagements(c), "30 minutes"), "pairs")
    expected = activity.engagement_pairs(silver.posts(batch(spark, events)), silver.engagements(batch(spark, events)))
    pairs = rows(expected)
    assert [r for r in rows(found) if "did:z" not in r[0]] == pairs
    assert any(r[2] is None for r in pairs) and any(r[2] for r in pairs)
    first = rows(activity.first_engagements(found.where("post_uri NOT LIKE '%did:z%'")))
    assert first == rows(activity.first_engagements(expected))
    by_post = {}
    for post, posted, engagement, kind, at in pairs:
        by_post.setdefault((post, posted), []).append((at, engagement, kind)) if at else by_post.setdefault((post, posted), [])
    assert {(r[0], r[3]) for r in first} == {(k[0], min(v)[1] if v else None) for k, v in by_post.items()}


@pytest.mark.parametrize(("name", "build"), [("sessions", lambda c: stateful.sessions(c, "40 minutes", 10)), ("sliding", lambda c: stateful.sliding_counts(c, "40 minutes"))])
def test_sessions_and_windows_equal_the_batch(spark, tmp_path, name, build):
    events = distinct(replay(4))
    found, held = Feed(spark, tmp_path).replayed(events, build, name)
    expected = build(batch(spark, [*events, *LAST]))
    late = {r for r in rows(expected) if "datetime(2024, 5, 7" in str(r)}  # the last events' own sessions and windows are open still
    assert rows(found) == sorted((r for r in rows(expected) if r not in late), key=str) and held <= 4


def lives(seed: int, n: int = 45) -> list[tuple]:
    """Changes of three accounts over ninety minutes, out of order by up to ten."""
    r = random.Random(seed)
    out = []
    for _ in range(n):
        us = (r.randrange(90) * 60 + 1_714_557_600) * 1_000_000
        kind = r.choice(["identity", "account", "account"])
        state = (None, None) if kind == "identity" else r.choice([(True, None), (False, "suspended"), (False, "deactivated"), (False, None)])
        out.append((r.choice("abc"), us, kind, "h" if kind == "identity" else None, *state))
    return sorted(out, key=lambda x: x[1] + r.uniform(0, 600e6))


def test_account_lives_equal_the_batch_across_restarts(spark, tmp_path):
    root, given = f"file://{tmp_path}", lives(6)
    schema = "actor_did string, at_us long, event_kind string, handle string, is_active boolean, status string"
    end = [("z", 1_714_557_600_000_000 + 10**12, "identity", "h", None, None)]
    lifecycle.prepare(spark)
    for part in (given[:15], given[15:30], given[30:], end):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(f"{root}/changes")
        rows_in = spark.readStream.schema(schema).parquet(f"{root}/changes")
        stateful.start(lifecycle.stretches(rows_in, "15 minutes"), f"{root}/lives", f"{root}/check", "lives", ONCE).awaitTermination()
    batch_rows = history.account_lifecycle(spark.createDataFrame(given, schema))
    expected = [r for r in rows(batch_rows) if r[3] is not None]
    assert rows(spark.read.parquet(f"{root}/lives")) == expected and len(expected) > 5
    last, open_ = {}, {r[0]: r for r in rows(batch_rows) if r[3] is None}
    for who, state, start, to, _ in sorted(rows(batch_rows), key=lambda r: (r[0], r[2])):
        assert last.get(who, (None, start))[1] == start and last.get(who, (None,))[0] != state
        last[who] = (state, to)
    assert set(open_) == {x[0] for x in given}


def plain_sessions(events, gap=10):
    out, by = [], {}
    for e in events:
        by.setdefault(e["key"], []).append(e["value"])
    for who, values in by.items():
        import json

        times = sorted(json.loads(v)["jetstream_time_us"] for v in values)
        run = [times[0]]
        for t in times[1:]:
            if t - run[-1] > gap * 60_000_000:
                out.append((who, len(run)))
                run = []
            run.append(t)
        out.append((who, len(run)))
    return sorted(out)


def test_sessions_equal_a_plain_walk_and_velocity_has_the_window_before(spark):
    events = distinct(replay(5))
    assert rows(activity.actor_sessions(batch(spark, events), 10), "actor_did", "event_count") == plain_sessions(events)
    counts = activity.sliding_counts(batch(spark, events))
    n = {(r.window_start, r.collection): r.event_count for r in counts.collect()}
    from datetime import timedelta

    for r in activity.velocity(counts).collect():
        before = n.get((r.window_start - timedelta(minutes=10), r.collection), 0)
        assert (r.before, r.growth, r.per_minute) == (before, r.event_count - before, r.event_count / 10) and r.growth_ratio == (r.growth / before if before else None)
