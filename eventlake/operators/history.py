"""What held when: versions of actors, the version of an actor at an event, lifetimes of records that are created and deleted."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventlake.operators.activity import wall
from eventlake.operators.scope import restrict
from eventlake.tables import Table

CHANGE = "payload struct<identity: struct<handle: string>, account: struct<active: boolean, status: string>>"
STATE = ("handle", "is_active", "status")


def actor_changes(identities: DataFrame, accounts: DataFrame) -> DataFrame:
    """actor_did, at_us, event_kind, handle, is_active, status from the identity and account families of Bronze."""
    rows = identities.unionByName(accounts).withColumn("p", F.from_json("message_value", CHANGE)["payload"])
    return rows.select(F.col("repository_did").alias("actor_did"), F.col("jetstream_time_us").alias("at_us"), "event_kind", "p.identity.handle", F.col("p.account.active").alias("is_active"), "p.account.status")


def actor_versions(changes: DataFrame) -> DataFrame:
    """The slowly changing dimension: a row for each stretch of time in which an actor's handle and account state stayed as they were.

    Identity events set the handle and account events the state; what an event doesn't set goes on.  Stretches of an actor follow one another without gap
    or overlap, from the first change (``version`` 1) to now (``valid_to`` null).  Changes are ordered by their own time, so one that arrives late splits the
    stretch it falls into; of several at one time the state after the last counts; redelivered ones change nothing.  Rows without actor or time are left out.
    """
    rows = changes.where("actor_did IS NOT NULL AND at_us IS NOT NULL")
    so_far = Window.partitionBy("actor_did").orderBy("at_us", "event_kind", *STATE)
    account = F.last(F.when(F.col("event_kind") == "account", F.struct("is_active", "status")), ignorenulls=True).over(so_far.rowsBetween(Window.unboundedPreceding, 0))
    handle = F.last("handle", ignorenulls=True).over(so_far.rowsBetween(Window.unboundedPreceding, 0))
    filled = rows.select("actor_did", "at_us", handle.alias("handle"), account.alias("account"), (F.lead("at_us").over(so_far)).alias("next_us"))
    in_time = Window.partitionBy("actor_did").orderBy("at_us")
    state = F.struct("handle", "account.is_active", "account.status")
    after = filled.where("next_us IS NULL OR next_us > at_us").withColumn("state", state)
    starts = after.withColumn("before", F.lag("state").over(in_time)).where("before IS NULL OR NOT before <=> state")
    return starts.select(
        "actor_did", F.row_number().over(in_time).cast("long").alias("version"), "state.handle", "state.is_active", "state.status",
        wall(F.timestamp_micros("at_us")).alias("valid_from"), wall(F.timestamp_micros(F.lead("at_us").over(in_time))).alias("valid_to"))


def account_state() -> Column:
    """The state that an event sets: an account event 'active', its status, or 'inactive' without one; an identity event none."""
    return F.when(F.col("event_kind") == "account", F.when(F.col("is_active"), "active").otherwise(F.coalesce("status", F.lit("inactive"))))


def account_lifecycle(changes: DataFrame) -> DataFrame:
    """actor_did, state, from_us, to_us, seconds: the stretches of an account's life; the last one is open.

    An account that is first seen by an identity event is active.  Events count in the order of their own time; of several at one time the last by kind, state and
    status does; an event that sets the state that holds already changes nothing.  ``streaming.lifecycle`` gives the same stretches, each when it ends.
    """
    rows = changes.where("actor_did IS NOT NULL AND at_us IS NOT NULL").withColumn("sets", account_state())
    so_far = Window.partitionBy("actor_did").orderBy("at_us", "event_kind", "is_active", "status")
    known = F.coalesce(F.last("sets", ignorenulls=True).over(so_far.rowsBetween(Window.unboundedPreceding, 0)), F.lit("active"))
    after = rows.select("actor_did", "at_us", known.alias("state"), F.lead("at_us").over(so_far).alias("next_us")).where("next_us IS NULL OR next_us > at_us")
    in_time = Window.partitionBy("actor_did").orderBy("at_us")
    starts = after.withColumn("before", F.lag("state").over(in_time)).where("before IS NULL OR before <> state")
    ends = starts.select("actor_did", "state", F.col("at_us").alias("from_us"), F.lead("at_us").over(in_time).alias("to_us"))
    return ends.withColumn("seconds", (F.col("to_us") - F.col("from_us")) / 1e6)


def refresh_versions(table: Table, new: DataFrame, changes: DataFrame) -> None:
    """``table`` of versions after ``new`` changes, out of all ``changes``: only the actors of the new ones are derived again."""
    touched = new.select("actor_did").where("actor_did IS NOT NULL").distinct()
    table.replace(touched, actor_versions(restrict(changes, touched, ["actor_did"])), ["actor_did"])


def as_of(facts: DataFrame, versions: DataFrame, actor: str, at: str, columns: Sequence[str]) -> DataFrame:
    """``facts`` with ``columns`` of the actor's version that held at the time ``at``; null before the first one.

    Facts and starts of versions are sorted together by actor and time, and each fact takes the last start before it: one shuffle of either side and no
    product of the two, however many versions an actor has.
    """
    body = F.struct(*[F.col(c) for c in facts.columns])
    left = facts.select(F.col(actor).alias("_who"), F.col(at).alias("_at"), F.lit(1).alias("_side"), body.alias("_fact"))
    right = versions.select(F.col("actor_did").alias("_who"), F.col("valid_from").alias("_at"), F.lit(0).alias("_side"), F.struct(*columns).alias("_version"))
    last = F.last("_version", ignorenulls=True).over(Window.partitionBy("_who").orderBy("_at", "_side").rowsBetween(Window.unboundedPreceding, 0))
    both = left.unionByName(right, allowMissingColumns=True).withColumn("_found", last)
    return both.where("_side = 1").select("_fact.*", *[F.col(f"_found.{c}").alias(c) for c in columns])


def transitions(creates: DataFrame, deletes: DataFrame) -> DataFrame:
    """record_uri, kind, target, at_us, opens: the creates and deletes that change whether a record is there.

    ``creates`` has record_uri, kind, target and jetstream_time_us, ``deletes`` record_uri and jetstream_time_us.  Events of a uri count in the order of their
    own time, not of arrival; at one time a create comes before a delete.  A create of what is there, and a delete of what isn't, changes nothing.
    """
    nothing = F.lit(None).cast("string")
    up = creates.select("record_uri", "kind", "target", F.col("jetstream_time_us").alias("at_us"), F.lit(True).alias("opens"))
    down = deletes.select("record_uri", nothing.alias("kind"), nothing.alias("target"), F.col("jetstream_time_us").alias("at_us"), F.lit(False).alias("opens"))
    in_time = Window.partitionBy("record_uri").orderBy("at_us", F.desc("opens"), "kind", "target")
    rows = up.unionByName(down).where("record_uri IS NOT NULL AND at_us IS NOT NULL").withColumn("was", F.coalesce(F.lag("opens").over(in_time), F.lit(False)))
    return rows.where("was <> opens").drop("was")


def lifetimes(changes: DataFrame) -> DataFrame:
    """record_uri, kind, target, started_at, ended_at, seconds of each time that a record was there; one that still is has no end."""
    in_time = Window.partitionBy("record_uri").orderBy("at_us", F.desc("opens"))
    rows = changes.withColumn("end_us", F.lead("at_us").over(in_time)).where("opens")
    return rows.select(
        "record_uri", "kind", "target", wall(F.timestamp_micros("at_us")).alias("started_at"), wall(F.timestamp_micros("end_us")).alias("ended_at"),
        ((F.col("end_us") - F.col("at_us")) / 1e6).alias("seconds"))


def net_counts(lived: DataFrame) -> DataFrame:
    """target, kind, at, net_count: how many records of a kind a target has from each instant on at which that changes, by a sweep over starts and ends."""
    steps = F.explode(F.array(F.struct(F.col("started_at").alias("at"), F.lit(1).alias("step")), F.struct(F.col("ended_at").alias("at"), F.lit(-1).alias("step"))))
    moves = lived.where("target IS NOT NULL").select("target", "kind", steps.alias("s")).where("s.at IS NOT NULL")
    moves = moves.groupBy("target", "kind", "s.at").agg(F.sum("s.step").alias("step")).where("step <> 0")
    return moves.select("target", "kind", "at", F.sum("step").over(Window.partitionBy("target", "kind").orderBy("at")).alias("net_count"))
