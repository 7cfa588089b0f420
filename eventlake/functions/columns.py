"""Column expressions shared by the layers.  All are built-in functions and stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Name = str | Column


def _col(x: Name) -> Column:
    return F.col(x) if isinstance(x, str) else x


def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` with a column that is evaluated once a row: filters are not pushed below a generator, so none repeats ``value`` in front of it."""
    return df.select("*", F.inline_outer(F.array(F.struct(value.alias(name)))))


def utc(text: Name) -> Column:
    """An ISO string as UTC wall-clock time; null if malformed (ANSI parsing would raise)."""
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), _col(text).try_cast("timestamp").cast("timestamp_ntz"))


def event_time(created: Name | None = "record_created_at", received: Name = "received_at") -> Column:
    """When an event happened: the client's time if it parses, else the time it was received.  Deletes have no client time."""
    return utc(received) if created is None else F.coalesce(utc(created), utc(received))


def at_uri(did: Name, collection: Name, rkey: Name) -> Column:
    """at://did/collection/rkey; null if a part is."""
    return F.concat(F.lit("at://"), _col(did), F.lit("/"), _col(collection), F.lit("/"), _col(rkey))


def event_id(uri: Name, kind: Name, time_us: Name = "jetstream_time_us") -> Column:
    """SHA-256 of uri, event type and time, joined by two pipes."""
    return F.sha2(F.concat_ws("||", _col(uri), _col(kind), _col(time_us).cast("string")), 256)


def count_where(condition: Column) -> Column:
    return F.count_if(condition)


def ratio(part: Column, whole: Column) -> Column:
    """part / whole as double; null where whole isn't positive."""
    return F.when(whole > 0, part.cast("double") / whole.cast("double"))


def seconds_between(start: Name, end: Name) -> Column:
    """Whole seconds from start to end, both floored first; may be negative, null if either is."""
    return F.unix_timestamp(_col(end).cast("timestamp")) - F.unix_timestamp(_col(start).cast("timestamp"))


def zero(x: Name) -> Column:
    return F.coalesce(_col(x), F.lit(0)).cast("long")
