"""Every query of the engine by name: (spark, sf_dir) -> DataFrame, over the fixture projection of the driver's events."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable
from datetime import datetime, timedelta
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake import serving
from eventlake.model import KEYS, MEASURES
from eventlake.functions.pseudonyms import DEMO_KEYS, rotation
from eventlake.operators import activity, alerts, bronze, checks, history, marts, modeled, quarantine, silver
from eventlake.operators.scope import exclude, latest_by, received_between, restrict, union
from eventlake.plans import affected
from eventlake.session import shared_dir
from eventlake.sources.fixture import kafka_messages
from eventlake.sources.readers import serving_rows
from eventlake.streaming import realtime
from eventlake.tables import Catalog

Query = Callable[[SparkSession, str], DataFrame]


class Built(dict):
    """Frames by name, each built when first asked for."""

    def __init__(self, names: Iterable[str], build: Callable[[str], DataFrame]) -> None:
        super().__init__()
        self.names, self.build = list(names), build

    def __missing__(self, name: str) -> DataFrame:
        self[name] = self.build(name)
        return self[name]


def stored(spark: SparkSession, sf_dir: str, layer: str, fresh: Built) -> Built:
    """The tables of a layer, each written once an application and input version: a layer reads the tables of the one below, not its plan."""
    events = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/events.parquet")
    files, seen = events.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(events, True), [sf_dir]
    while files.hasNext():  # the files and not their folder, which a rewrite in place may leave as it was
        f = files.next()
        seen.append(f"{f.getPath()} {f.getModificationTime()} {f.getLen()}")
    version = hashlib.sha256("\n".join(sorted(seen)).encode()).hexdigest()[:16]
    tables = Catalog(spark, f"{shared_dir(spark)}/{layer}-{spark.sparkContext.applicationId}/{version}")

    def read(name: str) -> DataFrame:
        table = tables.table(name)
        if not table.exists():
            table.overwrite(fresh[name])
        return table.read()

    return Built(fresh.names, read)


class Lake:
    """The layers over one input: s, g and m are plans for Silver, Gold and marts, each over the stored tables of the layer below."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir

    @cached_property
    def bronze(self) -> DataFrame:
        """Bronze as landed: JSON and the fields hoisted from it are stored columns, not expressions that each use would evaluate again."""
        return stored(self.spark, self.sf_dir, "landing", Built(["bronze"], lambda _: bronze.to_bronze(kafka_messages(self.spark, self.sf_dir))))["bronze"]

    @cached_property
    def messages(self) -> DataFrame:
        return bronze.to_messages(self.bronze)

    @cached_property
    def s(self) -> Built:
        commits = bronze.family(self.bronze, "commit")
        return Built(silver.TABLES, lambda name: silver.TABLES[name](commits))

    @cached_property
    def silver(self) -> Built:
        return stored(self.spark, self.sf_dir, "silver", self.s)

    @cached_property
    def g(self) -> Built:
        return Built(modeled.BUILDERS, lambda name: modeled.BUILDERS[name](self.silver))

    @cached_property
    def gold(self) -> Built:
        return stored(self.spark, self.sf_dir, "gold", self.g)

    @cached_property
    def m(self) -> Built:
        return Built(marts.BUILDERS, lambda name: marts.BUILDERS[name](self.silver, self.gold))

    @cached_property
    def rt(self) -> Built:
        events = realtime.classified(self.messages)
        return Built(realtime.METRICS, lambda name: realtime.minute_counts(events, name))

    @cached_property
    def cut(self) -> datetime:
        """The full hour before the middle of the input's time span: what came earlier counts as known."""
        us = F.unix_micros(F.col("ts").cast("timestamp"))
        low, high = self.spark.read.parquet(f"{self.sf_dir}/events.parquet").agg(F.min(us), F.max(us)).first()
        return (datetime(1970, 1, 1) + timedelta(microseconds=(low + high) // 2)).replace(minute=0, second=0, microsecond=0)

    def since(self, df: DataFrame) -> DataFrame:
        return received_between(df, self.cut, datetime(9999, 1, 1))

    def until(self, df: DataFrame) -> DataFrame:
        return received_between(df, None, self.cut)


def facts_new_only(lake: Lake) -> DataFrame:
    """Candidates of all of Silver without the facts that are there already."""
    known = lake.until(lake.gold["fact_content_events"])
    return exclude(lake.g["fact_content_events"], known, ["content_event_id"]).select("content_event_id", "content_event_type", "post_uri", "jetstream_time_us")


def dim_posts_merge(lake: Lake) -> DataFrame:
    """The dimension of the first half, merged with rows recomputed for posts that the second half touches."""
    posts, deletes = lake.silver["silver_posts"], lake.silver["silver_deleted_records"]
    old = modeled.dim_posts(lake.until(posts), lake.until(deletes))
    keys = affected.post_keys(lake.since(posts), lake.since(deletes))
    own = restrict(posts, keys, ["post_uri"])
    ends = restrict(deletes, keys.withColumnRenamed("post_uri", "record_uri"), ["record_uri"])
    new = modeled.dim_posts(own, ends)
    return exclude(old, keys, ["post_uri"]).unionByName(new)


def mart_reconcile(lake: Lake) -> DataFrame:
    """Marts against marts recomputed from the touched and the untouched keys apart."""
    g = lake.gold
    keys = affected.performance_posts(lake.since(g["fact_content_events"]), lake.since(g["fact_engagement_events"]))
    parts = []
    for cut in (restrict, exclude):
        parts.append(marts.post_performance(cut(g["dim_posts"], keys, ["post_uri"]), cut(g["fact_engagement_events"], keys.withColumnRenamed("post_uri", "target_post_uri"), ["target_post_uri"])))
    days = affected.network_days(lake.since(g["fact_network_events"]))
    dated = g["fact_network_events"].withColumn("activity_date", affected.day())
    network = [marts.network_growth_daily(cut(dated, days, KEYS["network_growth_daily"], null_safe=True)) for cut in (restrict, exclude)]
    reports = [(name, checks.reconcile(lake.m[name], union(rebuilt), MEASURES[name])) for name, rebuilt in (("post_performance", parts), ("network_growth_daily", network))]
    return union([r.select(F.lit(name).alias("mart"), "*") for name, r in reports])


def key_checks(lake: Lake) -> DataFrame:
    return union([checks.key_check(lake.gold[name], KEYS[name], name) for name in lake.gold.names])


def family_counts(lake: Lake) -> DataFrame:
    return union([bronze.family(lake.bronze, k).select("event_kind", "ingest_date") for k in bronze.FAMILIES]).groupBy("event_kind").agg(F.count("*").alias("event_count"), F.count_distinct("ingest_date").alias("day_count"))


def commits(lake: Lake) -> DataFrame:
    return bronze.family(lake.bronze, "commit")


def first_engagements(lake: Lake) -> DataFrame:
    return activity.first_engagements(activity.engagement_pairs(lake.silver["silver_posts"], lake.silver["silver_engagements"], 24 * 60))


def actor_changes(lake: Lake) -> DataFrame:
    return history.actor_changes(bronze.family(lake.bronze, "identity"), bronze.family(lake.bronze, "account"))


def versions(lake: Lake) -> DataFrame:
    return history.actor_versions(actor_changes(lake))


def account_lifecycle(lake: Lake) -> DataFrame:
    return history.account_lifecycle(actor_changes(lake))


def content_actor_versions(lake: Lake) -> DataFrame:
    """Each content event with the version of its author that held then."""
    facts = lake.gold["fact_content_events"].select("content_event_id", "author_did", activity.wall(activity.stream_time()).alias("at"))
    return history.as_of(facts, versions(lake), "author_did", "at", ["version", "handle", "is_active"])


def lived(lake: Lake) -> DataFrame:
    """Lifetimes of likes, reposts and follows."""
    s = lake.silver
    engaged = s["silver_engagements"].selectExpr("engagement_uri AS record_uri", "engagement_type AS kind", "subject_uri AS target", "jetstream_time_us")
    followed = s["silver_follows"].selectExpr("follow_uri AS record_uri", "'follow' AS kind", "target_actor_did AS target", "jetstream_time_us")
    return history.lifetimes(history.transitions(engaged.unionByName(followed), s["silver_deleted_records"].select("record_uri", "jetstream_time_us")))


def spike_levels(lake: Lake) -> DataFrame:
    hour = activity.wall(F.date_trunc("hour", activity.stream_time()))
    counts = commits(lake).groupBy("collection", hour.alias("bucket")).agg(F.count("*").alias("n"))
    return alerts.levels(alerts.filled(counts, "collection", "1 HOUR"), "collection")


def changed(lake: Lake) -> list[DataFrame]:
    return [lake.since(lake.gold[n]) for n in ("fact_content_events", "fact_engagement_events", "fact_network_events")]


QUERIES: dict[str, Callable[[Lake], DataFrame]] = {
    "silver_posts": lambda x: x.s["silver_posts"], "silver_engagements": lambda x: x.s["silver_engagements"], "silver_follows": lambda x: x.s["silver_follows"], "silver_deletes": lambda x: x.s["silver_deleted_records"],
    "bronze_family_counts": family_counts, "normalize_events": lambda x: bronze.normalize_events(x.messages).drop("schema_version", "source", "raw_event"),
    "commit_profile": lambda x: bronze.commit_profile(bronze.family(x.bronze, "commit")), "field_matrix": lambda x: bronze.field_matrix(x.messages), "sample_profile": lambda x: bronze.sample_profile(x.messages),
    "dim_actors": lambda x: x.g["dim_actors"], "dim_posts": lambda x: x.g["dim_posts"], "dim_posts_merge": dim_posts_merge, "latest_post_state": lambda x: latest_by(x.s["silver_posts"], "post_uri"),
    "fact_content": lambda x: x.g["fact_content_events"], "fact_engagement": lambda x: x.g["fact_engagement_events"], "fact_network": lambda x: x.g["fact_network_events"], "facts_new_only": facts_new_only,
    "post_performance": lambda x: x.m["post_performance"], "content_hourly": lambda x: x.m["content_quality_hourly"], "thread_summary": lambda x: x.m["thread_conversation_summary"],
    "actor_daily": lambda x: x.m["actor_activity_daily"], "network_daily": lambda x: x.m["network_growth_daily"], "event_volume": lambda x: x.m["event_volume_by_type"], "post_engagement_rows": lambda x: x.m["post_engagement_rows"],
    "top_posts": lambda x: serving.preview("post_performance", x.m["post_performance"]), "latest_hours": lambda x: serving.preview("content_quality_hourly", x.m["content_quality_hourly"]),
    "top_threads": lambda x: serving.preview("thread_conversation_summary", x.m["thread_conversation_summary"]), "top_actors": lambda x: serving.preview("actor_activity_daily", x.m["actor_activity_daily"]),
    "top_network": lambda x: serving.preview("network_growth_daily", x.m["network_growth_daily"]), "top_post_rows": lambda x: serving.preview("post_engagement_rows", x.m["post_engagement_rows"]),
    "rt_event_volume": lambda x: x.rt["event_volume"], "rt_content": lambda x: x.rt["content_activity"], "rt_engagement": lambda x: x.rt["engagement"], "rt_network": lambda x: x.rt["network_activity"],
    "rt_latest_metrics": lambda x: serving.latest_metrics(x.rt), "rt_metric_summary": lambda x: serving.metric_summary(x.rt), "rt_event_share": lambda x: serving.event_share(x.rt["event_volume"]),
    "rt_engagement_ratio": lambda x: serving.engagement_to_post_ratio(x.rt["content_activity"], x.rt["engagement"]), "rt_net_follow": lambda x: serving.net_follows(x.rt["network_activity"]),
    "rt_minute_activity": lambda x: x.rt["content_activity"].where((F.col("window_start") >= F.lit(x.cut).cast("timestamp_ntz")) & (F.col("window_start") < F.lit(x.cut + timedelta(days=1)).cast("timestamp_ntz"))),
    "affected_posts": lambda x: affected.performance_posts(*changed(x)[:2]), "affected_threads": lambda x: affected.threads(changed(x)[0], x.gold["fact_content_events"]),
    "affected_hours": lambda x: affected.hours(changed(x)[0], x.gold["fact_content_events"]), "affected_actor_days": lambda x: affected.actor_days(*changed(x), x.gold["fact_engagement_events"], x.gold["dim_posts"]),
    "affected_network_days": lambda x: affected.network_days(changed(x)[2]), "received_window": lambda x: received_between(x.s["silver_posts"], x.cut, x.cut + timedelta(hours=6)),
    "silver_reconcile": lambda x: checks.silver_reconcile({n: x.s[n] for n in x.s.names}, {n: x.silver[n] for n in x.silver.names}), "key_check": key_checks, "mart_reconcile": mart_reconcile, "silver_readiness": lambda x: checks.readiness({name: x.s[name] for name in x.s.names}),
    "reply_vs_original": lambda x: serving.reply_vs_original(x.m["post_performance"]), "adhoc_minute_reply": lambda x: serving.minute_reply_counts(x.gold["fact_content_events"], x.gold["dim_posts"]),
    "ttfe_distribution": lambda x: serving.ttfe_distribution(x.m["post_performance"]), "lifecycle_hourly": lambda x: serving.lifecycle_hourly(x.m["content_quality_hourly"]), "engagement_mix": lambda x: serving.engagement_mix(x.gold["fact_engagement_events"]),
    "actor_sessions": lambda x: activity.actor_sessions(commits(x)), "activity_velocity": lambda x: activity.velocity(activity.sliding_counts(commits(x))), "post_first_engagement": first_engagements,
    "actor_versions": versions, "account_lifecycle": account_lifecycle, "content_actor_versions": content_actor_versions, "record_lifetimes": lived, "net_record_counts": lambda x: history.net_counts(lived(x)),
    "spike_levels": spike_levels, "spike_alerts": lambda x: alerts.alerts(spike_levels(x), "collection"),
    "quarantined_events": lambda x: quarantine.rejected(quarantine.judged(commits(x))).select("offset", "collection", "operation", F.concat_ws("; ", "reasons").alias("reasons")),
    "quarantine_counts": lambda x: quarantine.counts(quarantine.judged(commits(x))), "pseudonym_rotation": lambda x: rotation(x.gold["dim_actors"], "actor_did", DEMO_KEYS, 1, 2),
    "serving_rows": lambda x: serving_rows(x.m["post_performance"]).select("post_uri", "is_deleted", "is_reply", "post_created_at", "engagement_score"),
}


def queries() -> dict[str, Query]:
    return {name: (lambda spark, sf_dir, build=build: build(Lake(spark, sf_dir))) for name, build in QUERIES.items()}
