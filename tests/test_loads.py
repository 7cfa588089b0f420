"""Loads of a table, interrupted rewrites, derived folders, and refreshes that are fed by loads however late rows come."""

import os
import random
from datetime import UTC, date, datetime, timedelta

import pytest
from helpers import POST, T0, event, rows, uri
from test_refresh import Runner, few_partitions, random_events  # noqa: F401  the fixture applies here too

from eventlake.plans.refresh import Refresh
from eventlake.plans.state import StateStore
from eventlake.tables import Catalog, LoadSet, Table

#: Random histories that are refreshed in any order; ten take long.
SEEDS = range(1, 1 + int(os.environ.get("EVENTLAKE_SEEDS", "2")))


@pytest.fixture
def lake(spark, tmp_path):
    return Catalog(spark, f"file://{tmp_path}/lake")


def days(spark, *given):
    return spark.createDataFrame([(k, v, None if d is None else date(2024, 5, d)) for k, v, d in given], "k string, v string, day date")


def test_load_sets_keep_ranges():
    s, r = LoadSet(), random.Random(1)
    numbers = r.sample(range(300), 200)
    for n in numbers:
        s.add(f"silver-{n}")
    for x in ("abc", "silver-07", "-3", "other-5", "silver-x"):
        s.add(x)
    again = LoadSet(s.stored())
    assert [n for n in range(300) if f"silver-{n}" in again] == sorted(numbers)
    assert all(x in again for x in ("abc", "silver-07", "-3", "other-5")) and "other-6" not in again and "silver-7" in again or 7 not in numbers
    assert all(b[0] > a[1] + 1 for a, b in zip(again.ranges["silver"][:-1], again.ranges["silver"][1:], strict=True))


def test_a_batch_counts_once_even_after_a_replacement(spark, lake):
    t = lake.table("t", ["day"])
    first = days(spark, ("a", "1", 1), ("b", "2", 1), ("c", "3", 2))
    t.append(first, batch=("s", 1))
    t.replace(days(spark, ("a", "", 1)), days(spark, ("a", "new", 1)), ["k"])
    t.append(first, batch=("s", 1))
    t.append(days(spark, ("d", "4", 2)), batch=("s", 2))
    assert rows(t.read(), "k", "v") == [("a", "new"), ("b", "2"), ("c", "3"), ("d", "4")]


def test_an_append_that_was_cut_off_comes_again_whole(spark, lake):
    t = lake.table("t", ["day"])
    t.append(days(spark, ("a", "1", 1)), batch=("s", 1))
    broken = lake.table("t", ["day"])
    broken._done = lambda load: (_ for _ in ()).throw(OSError("cut off"))
    with pytest.raises(OSError):
        broken.append(days(spark, ("b", "2", 1)), batch=("s", 2))
    t.replace(days(spark, ("a", "", 1)), days(spark, ("a", "new", 1)), ["k"])  # takes the day into a load of its own
    t.append(days(spark, ("b", "2", 1), ("c", "3", 2)), batch=("s", 2))
    assert rows(t.read(), "k", "v") == [("a", "new"), ("b", "2"), ("c", "3")]


def test_reading_loads_scans_their_folders_only(spark, lake):
    t = lake.table("t", ["day"])
    t.append(days(spark, ("a", "1", 1), ("b", "2", 2)), batch=("s", 1))
    t.append(days(spark, ("c", "3", 2), ("d", "4", None)), batch=("s", 2))
    assert t.loads() == ["s-1", "s-2"]
    assert rows(t.read_loads(["s-2"]), "k") == [("c",), ("d",)] and rows(t.read_loads([]), "k") == [] and t.read_loads(["s-1", "s-2"]).count() == 4
    scan = next(x for x in t.read_loads(["s-1"])._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in x)
    filters = scan.split("PartitionFilters:")[1].split("PushedFilters")[0]
    assert "load" in filters and "day" in filters
    t.overwrite(t.read().where("k <> 'a'"))
    new = [x for x in t.loads() if x not in ("s-1", "s-2")]
    assert len(new) == 1 and t.read_loads(new).count() == 3 and t.read_loads(["s-1"]).count() == 0


def test_merge_moves_keys_between_days(spark, lake):
    t = lake.table("t", ["day"])
    t.overwrite(days(spark, ("a", "1", 1), ("b", "2", 1), (None, "3", 2)))
    t.merge(days(spark, ("a", "new", 3), (None, "null", 1), ("d", "4", 3)), ["k"])
    assert rows(t.read(), "k", "v") == sorted([("a", "new"), ("b", "2"), (None, "null"), ("d", "4")], key=str)


def test_derived_folders_are_not_columns_and_merges_touch_their_buckets_only(spark, lake, tmp_path):
    t = lake.table("t", {"bucket": "CAST(pmod(xxhash64(k), 8) AS INT)"})
    t.overwrite(spark.createDataFrame([(f"k{i}", i) for i in range(40)], "k string, v int"))
    assert t.read().columns == ["k", "v"] and t.read().count() == 40
    files = lambda: {p.parent.parent.name: p.name for p in sorted((tmp_path / "lake/t/rows").rglob("*.parquet"))}
    before = files()
    assert len(before) > 4
    t.merge(spark.createDataFrame([("k3", 300), ("k99", 99)], "k string, v int"), ["k"])
    assert dict(map(tuple, t.read().where("k IN ('k3', 'k99')").collect())) == {"k3": 300, "k99": 99} and t.read().count() == 41
    assert sum(before.get(k) != v for k, v in files().items()) <= 2
    assert t.read_beside(spark.createDataFrame([("k3",)], "k string")).count() < 41


class CutOff(Exception):
    pass


def breaking(table: Table, step: int) -> None:
    """Stops the table's work before its ``step``th action on files."""
    left = [step]

    def wrap(owner, name):
        real = getattr(owner, name)

        def act(*args, **kw):
            if left[0] == 0:
                raise CutOff
            left[0] -= 1
            return real(*args, **kw)

        setattr(table, name, act)

    for name in ("_write", "_store_json", "_move", "_done"):
        wrap(table, name)


@pytest.mark.parametrize("kind", ["days", "whole"])
def test_a_replacement_that_stops_anywhere_leaves_the_old_or_the_new_rows(spark, tmp_path, kind):
    old, new = [("a", "1"), ("b", "2"), ("c", "3")], [("a", "new"), ("b", "2"), ("d", "4")]
    outcomes = []
    for step in range(12):
        lake = Catalog(spark, f"file://{tmp_path}/{kind}{step}")
        make = lambda lake=lake: lake.table("t", ["day"] if kind == "days" else ())
        make().overwrite(days(spark, ("a", "1", 1), ("b", "2", 1), ("c", "3", 2)))
        broken = make()
        breaking(broken, step)
        gone, come = days(spark, ("a", "", 1), ("c", "", 2), ("d", "", 3)), days(spark, ("a", "new", 1), ("d", "4", 3))
        try:
            broken.replace(gone, come, ["k"])
        except CutOff:
            pass
        else:
            break
        make().finish()
        make().finish()
        found = rows(make().read(), "k", "v")
        assert found in (old, new), step
        outcomes.append(found == new)
        make().replace(gone, come, ["k"])  # done again, as a failed step is
        assert rows(make().read(), "k", "v") == new
    assert outcomes[0] is False and outcomes[-1] is True and outcomes == sorted(outcomes)


def test_state_on_a_shared_file_system(spark, tmp_path):
    root = f"file://{tmp_path}/state"
    s, now = StateStore(root, spark), datetime(2024, 1, 2, tzinfo=UTC)
    assert s.read("facts") is None and s.jobs() == [] and s.clear() == []
    had = LoadSet()
    had.add("s-1")
    s.write("facts", now, {"silver_posts": had})
    s.write("facts", now + timedelta(hours=1))  # loads stay
    again = StateStore(root, spark)
    assert again.read("facts") == now + timedelta(hours=1) and "s-1" in again.loads("facts", "silver_posts") and "s-2" not in again.loads("facts", "silver_posts")
    s.fs.rename(s._at("facts.json"), s._at("facts.json.new"))  # as a write that was cut off leaves it
    assert again.read("facts") == now + timedelta(hours=1) and again.jobs() == ["facts"]
    assert again.clear() == ["facts"] and s.read("facts") is None


@pytest.mark.parametrize("seed", SEEDS)
def test_rows_that_arrive_in_any_order_equal_a_rebuild(spark, tmp_path, seed):
    """Loads hold events of any age: many come days after later ones; the lookback is zero."""
    events = random_events(seed + 100, 40)
    random.Random(seed).shuffle(events)
    run = Runner(spark, tmp_path)
    run.refresh.states = StateStore(f"file://{tmp_path}/shared-state", spark)
    for k, part in enumerate((events[:20], events[20:])):
        run.load(part, T0 + timedelta(days=9 + k))
        run.refresh.run("fast")
    run.check_full()


def test_a_post_that_comes_a_week_late_is_in_facts_and_marts_and_a_window_misses_it(spark, tmp_path):
    run = Runner(spark, tmp_path)
    run.load([event(1, "did:a", "create", POST, "p", 0, text="x")], T0 + timedelta(minutes=1))
    run.refresh.run()
    week = T0 + timedelta(days=7)
    run.load([event(2, "did:b", "create", POST, "late", 0.5, text="late")], week)  # received a week before it is here
    window = Refresh(run.lake, run.refresh.states, timedelta(0), run.refresh.clock, feed="received")
    assert not window.arrived(__import__("eventlake.plans.state", fromlist=["x"]).refresh_window(run.refresh.states.read("facts"), run.now, timedelta(0)))["silver_posts"].count()
    assert run.refresh.run().has_changes
    assert uri("did:b", "late") in {r.post_uri for r in run.refresh.table("post_performance").read().collect()}
    facts = run.refresh.table("fact_content_events")
    plan = facts.read_beside(facts.read().where("author_did = 'did:b'"))._jdf.queryExecution().executedPlan().toString()
    assert "event_day" in plan.split("PartitionFilters:")[1].split("PushedFilters")[0]
    with pytest.raises(ValueError):
        Refresh(run.lake, run.refresh.states, feed="none")
