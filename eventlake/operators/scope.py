"""Keys: latest row by key, restriction to keys, exclusion of keys, unions of key sources."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_by(df: DataFrame, key: str) -> DataFrame:
    """The latest row of each key: by event time, then receipt, nulls last; remaining ties by content, so a rerun agrees.

    A filtered row_number, which Spark plans as a partial and a final group limit: a task sends one row a key.
    """
    ties = [F.desc_nulls_last(c) for c in ("operation", "cid", "rkey") if c in df.columns]
    order = [F.desc_nulls_last("jetstream_time_us"), F.desc_nulls_last("received_at"), *ties]
    return df.withColumn("_rn", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where("_rn = 1").drop("_rn")


def same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    """Null-safe equality: a null key is a group like any other."""
    return reduce(Column.__and__, [left[k].eqNullSafe(right[k]) for k in keys])


def restrict(df: DataFrame, keys: DataFrame, on: Sequence[str], null_safe: bool = False) -> DataFrame:
    """Rows of ``df`` whose keys are in ``keys``; a semi-join, so keys never reach the driver and repeat harmlessly."""
    keys = keys.select(*on)
    return df.join(keys, same_keys(df, keys, on) if null_safe else list(on), "left_semi")


def exclude(df: DataFrame, keys: DataFrame, on: Sequence[str], null_safe: bool = False) -> DataFrame:
    """Rows of ``df`` whose keys aren't in ``keys``."""
    keys = keys.select(*on)
    return df.join(keys, same_keys(df, keys, on) if null_safe else list(on), "left_anti")


def union(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def key_union(frames: Sequence[DataFrame], drop_nulls: bool = True) -> DataFrame:
    """Distinct keys of several sources with the same columns."""
    keys = union(frames)
    return (keys.dropna() if drop_nulls else keys).distinct()


def received_between(df: DataFrame, start, end) -> DataFrame:
    """Rows received in [start, end); no lower bound if start is None.

    The string column is ISO in UTC, so besides the parsed bound there is one on ingest_date, a real column
    (and directory) that prunes files: nothing is ingested before the day it was received.
    """
    from eventlake.functions.columns import utc

    out = df.where(utc("received_at") < F.lit(end).cast("timestamp_ntz"))
    if start is not None:
        out = out.where(utc("received_at") >= F.lit(start).cast("timestamp_ntz"))
        if "ingest_date" in df.columns:
            out = out.where(F.col("ingest_date") >= F.lit(start).cast("date"))
    return out
