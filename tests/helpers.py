"""Events and comparisons that several tests use."""

from __future__ import annotations

import json
from datetime import datetime, timedelta

from eventlake.model import FOLLOW, LIKE, POST, REPOST
from eventlake.operators import bronze, silver

T0 = datetime(2024, 5, 1, 10, 0)


def iso(t: datetime) -> str:
    return t.isoformat(timespec="microseconds") + "Z"


def event(n: int, did: str, operation: str, collection: str, rkey: str, minutes: float = 0, created: str | None = "same", received: float | None = None, kind: str = "commit", **record) -> dict:
    """A topic message: the event happens ``minutes`` after T0 and is received then, or ``received`` minutes after T0."""
    at = T0 + timedelta(minutes=minutes)
    got = T0 + timedelta(minutes=minutes if received is None else received)
    us = int((at - datetime(1970, 1, 1)).total_seconds() * 1e6) + n
    commit = {"operation": operation, "collection": collection, "rkey": rkey, "cid": f"c{n}"}
    if operation != "delete":
        commit["record"] = {"$type": collection, **({"createdAt": iso(at) if created == "same" else created} if created else {}), **record}
    payload = {"did": did, "time_us": us, "kind": kind, "commit": commit}
    value = {"schema_version": 1, "source": "t", "event_kind": kind, "received_at": iso(got), "collection": collection, "operation": operation, "repository_did": did, "jetstream_time_us": us, "payload": payload}
    return {"key": did, "value": json.dumps(value), "topic": "raw", "partition": 0, "offset": n, "timestamp": got}


def uri(did: str, rkey: str, collection: str = POST) -> str:
    return f"at://{did}/{collection}/{rkey}"


def reply_to(root: str) -> dict:
    return {"root": {"uri": root, "cid": "x"}, "parent": {"uri": root, "cid": "x"}}


def subject(target: str) -> dict:
    return {"uri": target, "cid": "x"}


def messages(spark, events: list[dict]):
    rows = [(e["key"], e["value"], e["topic"], e["partition"], e["offset"], e["timestamp"]) for e in events]
    return spark.createDataFrame(rows, "key string, value string, topic string, partition int, offset long, timestamp timestamp")


def silver_of(spark, events: list[dict]) -> dict:
    return silver.build_all(bronze.family(bronze.to_bronze(messages(spark, events)), "commit"))


def rows(df, *cols: str) -> list[tuple]:
    return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=str)


__all__ = ["FOLLOW", "LIKE", "POST", "REPOST", "T0", "event", "iso", "messages", "reply_to", "rows", "silver_of", "subject", "uri"]
