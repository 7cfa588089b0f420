"""Refresh of facts, dimensions and marts, incrementally or in full, in one session.

An incremental run gives what a full rebuild gives, however late rows come: by default a step works on the loads of Silver that it
hasn't had yet, whatever times they carry.  (With ``feed="received"`` it works on a window of receipt times with a lookback, and what comes later
than that is missed.)  Facts look up states in all of Silver, restricted to the new keys; deletes whose post or follow turns up later are
corrected; whether a fact is stored already is asked of the days of the new events only.  The rows that a run replaced and added are kept as
change tables, and downstream keys come from these.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import UTC, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.model import FOLLOW, KEYS, MEASURES, PARTITIONS, POST
from eventlake.operators import checks, marts, modeled, silver
from eventlake.operators.scope import exclude, received_between, restrict, union
from eventlake.plans import affected
from eventlake.plans.state import DEFAULT_LOOKBACK, RefreshWindow, StateStore, refresh_window
from eventlake.tables import Catalog, LoadSet

MODES = ("fast", "standard", "strict")
FEEDS = ("loads", "received")
URIS = {"silver_posts": "post_uri", "silver_engagements": "engagement_uri", "silver_follows": "follow_uri", "silver_deleted_records": "record_uri"}
FACTS = ("fact_content_events", "fact_engagement_events", "fact_network_events")
STEPS = ("facts", "dimensions", "content_quality_hourly", "post_performance", "thread_conversation_summary", "network_growth_daily", "actor_activity_daily")


@dataclass
class Report:
    mode: str
    has_changes: bool = False
    skipped: bool = False
    seconds: dict[str, float] = field(default_factory=dict)


class Refresh:
    def __init__(self, catalog: Catalog, states: StateStore, lookback=DEFAULT_LOOKBACK, clock: Callable[[], datetime] = lambda: datetime.now(UTC), feed: str = "loads") -> None:
        if feed not in FEEDS:
            raise ValueError(f"feed {feed!r} is none of {FEEDS}")
        self.catalog, self.states, self.lookback, self.clock, self.feed = catalog, states, lookback, clock, feed

    # tables

    def table(self, name: str):
        return self.catalog.table(name, PARTITIONS.get(name, ()))

    def silver(self) -> dict[str, DataFrame]:
        """All of Silver, one row for each delivered event."""
        return {name: silver.deduplicated(self.table(name).read(), uri) for name, uri in URIS.items()}

    def arrived(self, window: RefreshWindow) -> dict[str, DataFrame]:
        """What the window received, one row for each event of it; the window reaches the scan as a bound on the day, before anything is compared.

        An event that an earlier window had and this one got again is in it: facts that are there already are left out by their keys.
        """
        return {name: silver.deduplicated(received_between(self.table(name).read(), *window.bounds()), uri) for name, uri in URIS.items()}

    def fed(self, step: str, again: bool = False) -> tuple[dict[str, DataFrame], dict[str, LoadSet]]:
        """What arrived in loads that ``step`` hasn't had (``again``: in all), one row for each event; and the loads it has had then."""
        rows, had = {}, {}
        for name, uri in URIS.items():
            table, had[name] = self.table(name), self.states.loads(step, name)
            loads = table.loads()
            new = loads if again else [x for x in loads if x not in had[name]]
            rows[name] = silver.deduplicated(table.read() if len(new) == len(loads) else table.read_loads(new), uri)
            for x in new:
                had[name].add(x)
        return rows, had

    def gold(self) -> dict[str, DataFrame]:
        return {name: self.table(name).read() for name in ("dim_actors", "dim_posts", *FACTS)}

    def changes(self) -> list[DataFrame]:
        return [self.table(f"changed_{name}").read() for name in FACTS]

    # full

    def rebuild(self) -> None:
        """Everything from Silver."""
        end, had = self.clock(), self.fed("facts", again=True)[1]
        for name, df in modeled.build_all(self.silver()).items():
            self.table(name).overwrite(df)
            checks.require_keys(self.table(name).read(), KEYS[name], name)
        for name, df in marts.build_all(self.silver(), self.gold()).items():
            self.table(name).overwrite(df)
        for name in FACTS:
            self.table(f"changed_{name}").overwrite(self.table(name).read().limit(0))
        for step in STEPS:
            self.states.write(step, end, had)

    # incremental steps

    def facts(self, now: dict[str, DataFrame]) -> bool:
        """New facts of what arrived and corrected deletes; returns whether anything changed."""
        s = self.silver()
        changed = self._with_deletes("fact_content_events", "post_uri", POST, now["silver_posts"], s["silver_posts"], now["silver_deleted_records"], s["silver_deleted_records"], modeled.fact_content_events)
        changed |= self._with_deletes("fact_network_events", "follow_uri", FOLLOW, now["silver_follows"], s["silver_follows"], now["silver_deleted_records"], s["silver_deleted_records"], modeled.fact_network_events)
        changed |= self._store("fact_engagement_events", modeled.fact_engagement_events(now["silver_engagements"]), None)
        return changed

    def _with_deletes(self, name: str, uri: str, collection: str, rows: DataFrame, all_rows: DataFrame, deletes: DataFrame, all_deletes: DataFrame, build) -> bool:
        gone, all_gone = modeled.deleted(deletes, collection), modeled.deleted(all_deletes, collection)
        touched = rows.select(F.col(uri).alias("record_uri")).distinct()
        older = restrict(all_gone, touched, ["record_uri"])  # deletes whose state may have become known or different
        work = gone.unionByName(older).dropDuplicates(["record_uri", "operation", "jetstream_time_us"])
        history = restrict(all_rows, work.select(F.col("record_uri").alias(uri)).distinct(), [uri])
        fresh = build(rows, work, history)
        kind = "content_event_type" if name == "fact_content_events" else "network_event_type"
        return self._store(name, fresh, lambda facts: restrict(facts.where(F.col(kind).endswith("_delete")), touched.withColumnRenamed("record_uri", uri), [uri]))

    def _store(self, name: str, fresh: DataFrame, stale: Callable[[DataFrame], DataFrame] | None) -> bool:
        """Append facts that aren't there; those that ``stale`` picks are replaced if ``fresh`` has them otherwise.  Keeps both as the change table.

        ``fresh`` has every delete whose state may have changed, so the days of its events hold all facts that are compared or replaced.
        """
        (key,), table, log, work = KEYS[name], self.table(name), self.table(f"changed_{name}"), self.table(f"fresh_{name}")
        work.overwrite(fresh)  # computed once
        fresh = work.read()
        checks.require_keys(fresh, [key], name)
        if not table.exists():
            log.overwrite(fresh)
            table.overwrite(fresh)
            return fresh.limit(1).count() > 0
        current = table.read_beside(fresh)
        wrong = None
        if stale is not None:
            # rows of the present that the run derives differently: gone, or with another state
            old = stale(current)
            wrong = old.join(fresh.select(*old.columns), reduce_equal(old, fresh), "left_anti")
            if not wrong.limit(1).count():
                wrong = None
        if wrong is None:
            # ids are unique in fresh and absent from current, so the union needs no check of the whole table
            new = exclude(fresh, current, [key])
            log.overwrite(new)
            new = log.read()
            if not new.limit(1).count():
                return False
            table.append(new)
        else:
            old = wrong.select(key, "jetstream_time_us").distinct()
            log.overwrite(exclude(fresh, exclude(current, old, [key]), [key]).unionByName(wrong))
            both = log.read()
            new = both.join(fresh.select(*both.columns), reduce_equal(both, fresh), "left_semi").dropDuplicates([key])
            table.replace(old, new, [key])
        return True

    def dimensions(self, now: dict[str, DataFrame]) -> None:
        """Rows of touched actors and posts, recomputed from all of their Silver rows."""
        s = self.silver()
        posts, engagements, follows, deletes = (now[k] for k in URIS)
        keys = affected.post_keys(posts, deletes)
        own = restrict(s["silver_posts"], keys, ["post_uri"])
        ends = restrict(s["silver_deleted_records"], keys.withColumnRenamed("post_uri", "record_uri"), ["record_uri"])
        self._merge("dim_posts", modeled.dim_posts(own, ends))
        keys = affected.actor_keys(posts, engagements, follows, deletes)
        of = lambda name, who: restrict(s[name], keys.withColumnRenamed("actor_did", who), [who])
        either = of("silver_follows", "actor_did").unionByName(of("silver_follows", "target_actor_did")).dropDuplicates(["follow_uri", "operation", "jetstream_time_us"])
        parts = modeled.dim_actors(of("silver_posts", "author_did"), of("silver_engagements", "actor_did"), either, of("silver_deleted_records", "repository_did"))
        self._merge("dim_actors", restrict(parts, keys, ["actor_did"]))  # the other side of a follow is partial

    def _merge(self, name: str, df: DataFrame) -> None:
        work = self.table(f"changed_{name}")
        work.overwrite(df)  # computed once; checked, it can't bring a key twice into the merge
        checks.require_keys(work.read(), KEYS[name], name)
        self.table(name).merge(work.read(), KEYS[name])

    def mart_keys(self, name: str) -> DataFrame:
        """Grain keys that the last change touches."""
        content, engagement, network = self.changes()
        g = self.gold()
        return {
            "content_quality_hourly": lambda: affected.hours(content, g["fact_content_events"]),
            "post_performance": lambda: affected.performance_posts(content, engagement),
            "thread_conversation_summary": lambda: affected.threads(content, g["fact_content_events"]),
            "actor_activity_daily": lambda: affected.actor_days(content, engagement, network, g["fact_engagement_events"], g["dim_posts"]),
            "network_growth_daily": lambda: affected.network_days(network),
        }[name]()

    def mart_rows(self, name: str, keys: DataFrame | None) -> DataFrame:
        """The mart over the modelled tables, for ``keys`` only if given: inputs are restricted before they are aggregated."""
        g = self.gold()
        posts, content, engagement, network = (g[k] for k in ("dim_posts", *FACTS))
        if name == "content_quality_hourly":
            if keys is not None:
                content = restrict(content.withColumn("window_start", affected.hour()), keys, ["window_start"], null_safe=True).drop("window_start")
            return marts.content_quality_hourly(content, posts)
        if name == "post_performance":
            if keys is not None:
                posts = restrict(posts, keys, ["post_uri"])
                engagement = restrict(engagement, keys.withColumnRenamed("post_uri", "target_post_uri"), ["target_post_uri"])
            return marts.post_performance(posts, engagement)
        if name == "thread_conversation_summary":
            return marts.thread_conversation_summary(posts, content if keys is None else restrict(content, keys, ["reply_root_uri"]))
        if name == "network_growth_daily":
            if keys is not None:
                network = restrict(network.withColumn("activity_date", affected.day()), keys, KEYS[name], null_safe=True).drop("activity_date")
            return marts.network_growth_daily(network)
        out = marts.actor_activity_daily(g["dim_actors"], posts, content, engagement, network)
        return out if keys is None else restrict(out, keys, KEYS[name], null_safe=True)

    def mart(self, name: str, mode: str) -> None:
        """Replace the rows of touched keys; keys that have no row any more go."""
        work = self.table(f"keys_{name}")
        work.overwrite(self.mart_keys(name))
        keys, table = work.read(), self.table(name)
        table.replace(keys, self.mart_rows(name, keys), KEYS[name]) if table.exists() else table.overwrite(self.mart_rows(name, None))
        if mode == "standard":
            checks.require_reconciled(checks.reconcile(self.mart_rows(name, keys), table.read(), MEASURES[name], keys, KEYS[name]), name)
        elif mode == "strict":
            bad = checks.differences(self.mart_rows(name, None), table.read()).limit(3).collect()
            if bad:
                raise checks.CheckFailed(f"{name} differs from a full rebuild: {bad}")

    # checks of whole tables

    def check_keys(self) -> DataFrame:
        """The key check of every dimension and fact."""
        return union([checks.key_check(df, KEYS[name], name) for name, df in self.gold().items()])

    def check_silver(self, rebuilt: dict[str, DataFrame]) -> DataFrame:
        """Stored Silver against Silver rebuilt from Bronze."""
        return checks.silver_reconcile(rebuilt, {name: self.table(name).read() for name in URIS})

    def check_serving(self) -> DataFrame:
        """Every mart against one recomputed from the modelled tables."""
        reports = [checks.reconcile(self.mart_rows(name, None), self.table(name).read(), MEASURES[name]) for name in STEPS[2:]]
        return union([r.select(F.lit(name).alias("table_name"), "*") for name, r in zip(STEPS[2:], reports, strict=True)])

    # all

    def run(self, mode: str | None = None, ignore_state: bool = False, force: bool = False, skip_unchanged: bool = True) -> Report:
        """Facts, dimensions, then marts; stops at the first failure, and a step's state advances only when it succeeds.

        Downstream steps are skipped if there are no new facts and all of them are as new as the facts, unless forced.
        """
        mode = mode or ("standard" if ignore_state else "fast")
        if mode not in MODES:
            raise ValueError(f"mode {mode!r} is none of {MODES}")
        report = Report(mode)

        def step(name: str, work: Callable[[dict[str, DataFrame]], object], reads_silver: bool = False) -> object:
            last = None if ignore_state else self.states.read(name)
            window = refresh_window(last, self.clock(), self.lookback)
            began = time.monotonic()
            now, had = {}, None
            if reads_silver:
                now, had = self.fed(name, ignore_state or last is None) if self.feed == "loads" else (self.arrived(window), None)
            out = work(now)
            self.states.write(name, window.end, had)
            report.seconds[name] = time.monotonic() - began
            return out

        before = self.states.read("facts")
        behind = before is None or any((self.states.read(s) or before.replace(year=1)) < before for s in STEPS[1:])
        behind = behind or (self.states.read("facts_begun") or before) > before  # facts stopped midway
        self.states.write("facts_begun", self.clock())
        for name in KEYS:
            self.table(name).finish()
        report.has_changes = bool(step("facts", self.facts, True))
        if skip_unchanged and not report.has_changes and not behind and not ignore_state and not force and mode != "strict":
            for name in STEPS[1:]:
                self.states.write(name, self.states.read("facts"))
            report.skipped = True
            return report
        if behind and not ignore_state:  # an earlier run failed midway: the change tables may not cover it, so all rows count as changed
            for name in FACTS:
                self.table(f"changed_{name}").overwrite(self.table(name).read())
        step("dimensions", self.dimensions, True)
        for name in STEPS[2:]:
            step(name, lambda _w, name=name: self.mart(name, mode))
        if mode != "fast":
            checks.require_ok(self.check_keys())
        if mode == "strict":
            for name, df in modeled.build_all(self.silver()).items():
                bad = checks.differences(df, self.table(name).read()).limit(3).collect()
                if bad:
                    raise checks.CheckFailed(f"{name} differs from a full rebuild: {bad}")
        return report


def reduce_equal(left: DataFrame, right: DataFrame):
    """Null-safe equality of all columns."""
    out = F.lit(True)
    for c in left.columns:
        out = out & left[c].eqNullSafe(right[c])
    return out
