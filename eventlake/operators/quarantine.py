"""Invalid events set apart: a table of rules, all evaluated in one pass, and every row ends up on just one side."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlake.functions.columns import once, utc
from eventlake.model import COLLECTIONS
from eventlake.operators.scope import union
from eventlake.tables import Catalog

BODY = "payload struct<commit: struct<rkey: string, record: struct<`$type`: string, createdAt: string>>>"
OPERATIONS = ("create", "update", "delete")


def rules() -> dict[str, Column]:
    """Reason -> whether a row breaks the rule, over a commit row of Bronze with its parsed ``commit``; a rule that can't be judged (null) isn't broken."""
    created, written = F.col("commit.record.createdAt"), F.col("operation").isin("create", "update")
    return {
        "no actor": F.col("repository_did").isNull() | ~F.col("repository_did").startswith("did:"),
        "unknown collection": F.col("collection").isNull() | ~F.col("collection").isin(*COLLECTIONS),
        "unknown operation": F.col("operation").isNull() | ~F.col("operation").isin(*OPERATIONS),
        "no record key": F.col("commit.rkey").isNull() | (F.col("commit.rkey") == ""),
        "no event time": F.col("jetstream_time_us").isNull(),
        "no record": written & F.col("commit.record").isNull(),
        "record of another type": written & (F.col("commit.record.`$type`") != F.col("collection")),
        "no client time": written & created.isNull(),
        "malformed client time": created.isNotNull() & utc(created).isNull(),
        "client time after receipt": utc(created) > utc("received_at") + F.expr("INTERVAL 1 DAY"),
    }


def judged(commits: DataFrame) -> DataFrame:
    """Commit rows of Bronze with ``reasons``, all the rules they break in the order of the table; JSON is parsed once a row."""
    rows = once(commits, "commit", F.from_json("message_value", BODY)["payload"]["commit"])
    reasons = F.array_compact(F.array(*[F.when(broken, F.lit(name)) for name, broken in rules().items()]))
    return once(rows, "reasons", reasons).drop("commit")


def accepted(rows: DataFrame) -> DataFrame:
    return rows.where(F.size("reasons") == 0).drop("reasons")


def rejected(rows: DataFrame) -> DataFrame:
    return rows.where(F.size("reasons") > 0)


def counts(rows: DataFrame) -> DataFrame:
    """outcome, event_count: read, accepted and rejected rows, and rows for each reason; accepted and rejected add up to read."""
    ok = F.size("reasons") == 0
    outcomes = F.concat(F.array(F.lit("read"), F.when(ok, "accepted").otherwise("rejected")), F.transform("reasons", lambda r: F.concat(F.lit("rejected: "), r)))
    return rows.select(F.explode(outcomes).alias("outcome")).groupBy("outcome").agg(F.count("*").alias("event_count"))


def quarantine_batch(catalog: Catalog, stream: str) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function that appends the two sides of a batch to ``accepted_commits`` and ``quarantined_commits``, once however often it is delivered."""

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = judged(batch).persist()
        try:
            for name, side in (("accepted_commits", accepted(rows)), ("quarantined_commits", rejected(rows))):
                catalog.table(name, ["ingest_date"]).append(side, batch=(stream, batch_id))
        finally:
            rows.unpersist()

    return write


def conserved(catalog: Catalog, read: DataFrame) -> DataFrame:
    """read, accepted, rejected, ok: whether the two tables hold just the rows that were read."""
    sides = [catalog.table(n, ["ingest_date"]).read().agg(F.count("*").alias("n")).select(F.lit(k).alias("side"), "n") for k, n in (("accepted", "accepted_commits"), ("rejected", "quarantined_commits"))]
    total = union([*sides, read.agg(F.count("*").alias("n")).select(F.lit("read").alias("side"), "n")])
    out = total.agg(*[F.sum(F.when(F.col("side") == k, F.col("n"))).alias(k) for k in ("read", "accepted", "rejected")])
    return out.withColumn("ok", F.col("read") == F.col("accepted") + F.col("rejected"))
