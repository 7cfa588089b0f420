"""Incremental refresh equals a full rebuild, whatever the batches; modes, skipping and failures."""

import random
from datetime import UTC, datetime, timedelta

import pytest
from helpers import FOLLOW, LIKE, POST, REPOST, T0, event, messages, reply_to, subject, uri

from eventlake.model import MEASURES
from eventlake.operators import bronze, checks, marts, modeled, silver
from eventlake.plans.refresh import STEPS, Refresh
from eventlake.plans.state import StateStore, refresh_window
from eventlake.tables import Catalog

PEOPLE = [f"did:{x}" for x in "abcd"]


def random_events(seed: int, n: int) -> list[dict]:
    """Creates, updates and deletes of few keys, so that deletes come before creates, after them, and without them."""
    r = random.Random(seed)
    out = []
    for k in range(n):
        who, minutes = r.choice(PEOPLE), r.uniform(0, 3000)
        kind = r.choice(["post", "post", "update", "delete", "like", "repost", "follow", "unfollow"])
        rkey, target = f"k{r.randrange(4)}", uri(r.choice(PEOPLE), f"k{r.randrange(4)}")
        created = r.choice(["same", "same", None, "bad"])
        reply = {"reply": reply_to(target)} if r.random() < 0.5 else {}
        if kind in ("post", "update"):
            out.append(event(k, who, "create" if kind == "post" else "update", POST, rkey, minutes, created, text="x" * r.randrange(9), **reply))
        elif kind in ("delete", "unfollow"):
            out.append(event(k, who, "delete", POST if kind == "delete" else FOLLOW, rkey, minutes))
        elif kind == "follow":
            out.append(event(k, who, "create", FOLLOW, rkey, minutes, created, subject=r.choice(PEOPLE)))
        else:
            out.append(event(k, who, "create", LIKE if kind == "like" else REPOST, f"e{k}", minutes, created, subject=subject(target)))
    return out


@pytest.fixture(autouse=True)
def few_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


class Runner:
    def __init__(self, spark, tmp_path) -> None:
        self.spark, self.lake = spark, Catalog(spark, f"file://{tmp_path}/lake")
        self.now = datetime(2024, 1, 1, tzinfo=UTC)
        self.refresh = Refresh(self.lake, StateStore(tmp_path / "state"), timedelta(0), lambda: self.now)

    def load(self, events: list[dict], until: datetime) -> None:
        commits = bronze.family(bronze.to_bronze(messages(self.spark, events)), "commit")
        for name, build in silver.TABLES.items():
            self.refresh.table(name).append(build(commits))
        self.now = until.replace(tzinfo=UTC)

    def check_full(self) -> None:
        s = self.refresh.silver()
        g = modeled.build_all(s)
        full = {**g, **{k: v for k, v in marts.build_all(s, g).items() if k in MEASURES}}
        for name, df in full.items():
            wrong = checks.differences(df, self.refresh.table(name).read()).collect()
            assert not wrong, (name, wrong[:3])


@pytest.mark.parametrize("seed", [1])
def test_batches_in_any_split_equal_a_rebuild(spark, tmp_path, seed):
    events = sorted(random_events(seed, 60), key=lambda e: e["timestamp"])
    run = Runner(spark, tmp_path)
    cuts = sorted(random.Random(seed).sample(range(5, 55), 2))
    for a, b in zip([0, *cuts], [*cuts, len(events)], strict=True):
        run.load(events[a:b], events[b]["timestamp"] if b < len(events) else T0 + timedelta(days=9))
        run.refresh.run("fast")
    run.check_full()


def test_late_create_corrects_an_earlier_delete_and_an_unchanged_run_is_skipped(spark, tmp_path):
    root = uri("did:b", "root")
    run = Runner(spark, tmp_path)
    run.load([event(1, "did:a", "delete", POST, "p", 5), event(2, "did:a", "delete", FOLLOW, "f", 6)], T0 + timedelta(minutes=10))
    assert run.refresh.run("standard").has_changes
    late = [event(3, "did:a", "create", POST, "p", 1, received=12, text="x", reply=reply_to(root)), event(4, "did:a", "create", FOLLOW, "f", 2, received=12, subject="did:c")]
    run.load([*late, *late], T0 + timedelta(minutes=20))  # delivered twice
    assert run.refresh.run("strict").has_changes
    facts = {r.content_event_type for r in run.refresh.table("fact_content_events").read().collect()}
    assert facts == {"reply_create", "reply_delete"}
    run.check_full()
    run.now += timedelta(minutes=5)
    report = run.refresh.run()
    assert (report.mode, report.has_changes, report.skipped) == ("fast", False, True)
    assert not run.refresh.run(force=True).skipped


def test_facts_that_stopped_midway_are_caught_up(spark, tmp_path, monkeypatch):
    run = Runner(spark, tmp_path)
    run.load([event(1, "did:a", "create", POST, "p", 0, text="x")], T0 + timedelta(minutes=1))
    run.refresh.run()
    run.load([event(2, "did:b", "create", POST, "q", 2, text="y"), event(3, "did:b", "create", LIKE, "l", 2, subject=subject(uri("did:a", "p")))], T0 + timedelta(minutes=3))
    broken = Refresh(run.lake, run.refresh.states, timedelta(0), run.refresh.clock)
    store = broken._store
    monkeypatch.setattr(broken, "_store", lambda name, *a: store(name, *a) if name == "fact_content_events" else (_ for _ in ()).throw(checks.CheckFailed("stop")))
    with pytest.raises(checks.CheckFailed):
        broken.run()  # the new post is stored, and the next run finds it there
    assert run.refresh.run().has_changes
    run.check_full()


def test_a_failed_step_is_caught_up_and_bad_modes_raise(spark, tmp_path, monkeypatch):
    run = Runner(spark, tmp_path)
    run.load([event(1, "did:a", "create", POST, "p", 0, text="x")], T0 + timedelta(minutes=1))
    run.refresh.run()
    run.load([event(2, "did:b", "create", LIKE, "l", 2, subject=subject(uri("did:a", "p")))], T0 + timedelta(minutes=3))
    broken = Refresh(run.lake, run.refresh.states, timedelta(0), run.refresh.clock)
    monkeypatch.setattr(broken, "mart", lambda *a: (_ for _ in ()).throw(checks.CheckFailed("stop")))
    with pytest.raises(checks.CheckFailed):
        broken.run()
    run.now += timedelta(minutes=5)
    report = run.refresh.run()  # no new facts, yet the marts are behind
    assert not report.has_changes and not report.skipped and set(report.seconds) == set(STEPS)
    run.check_full()
    with pytest.raises(ValueError):
        run.refresh.run("careful")
    assert run.refresh.run(ignore_state=True).mode == "standard"


def test_rebuild(spark, tmp_path):
    run = Runner(spark, tmp_path)
    run.load(random_events(3, 30), T0 + timedelta(days=9))
    run.refresh.rebuild()
    run.check_full()
    assert run.refresh.states.read("facts") == run.now
    stored = {name: run.refresh.table(name).read() for name in silver.TABLES}
    for report in (run.refresh.check_keys(), run.refresh.check_serving(), run.refresh.check_silver(stored)):
        checks.require_ok(report)
    with pytest.raises(checks.CheckFailed):
        checks.require_ok(run.refresh.check_silver({**stored, "silver_posts": stored["silver_posts"].limit(1)}))


def test_the_window_prunes_the_scan_before_anything_is_compared(spark, tmp_path):
    run = Runner(spark, tmp_path)
    run.load(random_events(4, 30), T0 + timedelta(days=9))
    window = refresh_window(datetime(2024, 5, 2, tzinfo=UTC), datetime(2024, 5, 3, tzinfo=UTC), timedelta(0))
    for df in run.refresh.arrived(window).values():
        plan = df._jdf.queryExecution().executedPlan().toString()
        scan = next(line for line in plan.splitlines() if "FileScan" in line)
        assert "ingest_date" in scan.split("PartitionFilters:")[1].split("PushedFilters")[0]
