"""Data-quality checks: keys, reconciliation of measures, contracts, readiness."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventlake.operators.scope import restrict, union


class CheckFailed(ValueError):
    """A check found wrong data."""


def key_check(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """One row: rows, rows without a null key, distinct keys, and whether all three agree.

    Counted by grouping on the key rather than by a distinct count, so one shuffle serves all three.
    """
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    per_key = df.groupBy(*keys).agg(F.count("*").alias("n"))
    out = per_key.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"), F.coalesce(F.sum(F.when(known, F.col("n"))), F.lit(0)).alias("non_null_count"), F.count_if(known).alias("distinct_count"))
    ok = (F.col("row_count") == F.col("non_null_count")) & (F.col("row_count") == F.col("distinct_count"))
    return out.select(F.lit(name).alias("table_name"), "row_count", "non_null_count", "distinct_count", ok.alias("ok"))


def require_keys(df: DataFrame, keys: Sequence[str], name: str) -> None:
    row = key_check(df, keys, name).first()
    if not row.ok:
        raise CheckFailed(f"{name}: {row.row_count} rows, {row.non_null_count} with a key, {row.distinct_count} keys")


def metrics(df: DataFrame, measures: Sequence[str]) -> DataFrame:
    """(metric, value): the row count and the sum of each measure, from one aggregate."""
    sums = df.agg(F.count("*").alias("row_count"), *[F.coalesce(F.sum(m).cast("long"), F.lit(0)).alias(m) for m in measures])
    return sums.select(F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("long").alias("value")) for m in ("row_count", *measures)])).alias("x")).select("x.*")


def reconcile(expected: DataFrame, actual: DataFrame, measures: Sequence[str], keys: DataFrame | None = None, on: Sequence[str] = ()) -> DataFrame:
    """(metric, expected, actual, ok), over all rows or only those of ``keys``."""
    if keys is not None:
        expected, actual = restrict(expected, keys, on, null_safe=True), restrict(actual, keys, on, null_safe=True)
    both = metrics(expected, measures).withColumnRenamed("value", "expected").join(metrics(actual, measures).withColumnRenamed("value", "actual"), "metric", "full")
    return both.select("metric", "expected", "actual", F.col("expected").eqNullSafe(F.col("actual")).alias("ok"))


def differences(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Rows that only one side has, with how often: stricter than sums, whose errors may cancel."""
    cols = expected.columns
    both = expected.withColumn("_n", F.lit(1)).unionByName(actual.select(*cols).withColumn("_n", F.lit(-1)))
    return both.groupBy(*cols).agg(F.sum("_n").alias("surplus")).where("surplus <> 0")


def require_reconciled(report: DataFrame, name: str) -> None:
    bad = report.where(~F.col("ok")).collect()  # a row for each measure at most
    if bad:
        raise CheckFailed(f"{name}: " + ", ".join(f"{r.metric} {r.expected} != {r.actual}" for r in bad))


def require_ok(report: DataFrame) -> None:
    """Raise if a row of a report isn't ok."""
    bad = report.where(~F.col("ok")).collect()  # reports have a row a table or measure
    if bad:
        raise CheckFailed("; ".join(str(r.asDict()) for r in bad))


#: Counts by kind that Silver is reconciled on, besides rows.
SILVER_COUNTS = {
    "silver_posts": {"replies": "is_reply", "updates": "operation = 'update'", "texts": "text IS NOT NULL"},
    "silver_engagements": {"likes": "engagement_type = 'like'", "reposts": "engagement_type = 'repost'", "targets": "subject_uri IS NOT NULL"},
    "silver_follows": {"targets": "target_actor_did IS NOT NULL"},
    "silver_deleted_records": {"keys": "record_uri IS NOT NULL"},
}


def silver_reconcile(expected: Mapping[str, DataFrame], actual: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, metric, expected, actual, ok) of the Silver tables."""
    def counted(name: str, df: DataFrame) -> DataFrame:
        return df.select(*[F.expr(c).cast("int").alias(k) for k, c in SILVER_COUNTS[name].items()])

    return union([reconcile(counted(name, expected[name]), counted(name, actual[name]), list(SILVER_COUNTS[name])).select(F.lit(name).alias("table_name"), "*") for name in SILVER_COUNTS])


def check_contract(df: DataFrame, columns: Sequence[str], name: str) -> None:
    """Column names and their order have to be those declared."""
    if df.columns != list(columns):
        raise CheckFailed(f"{name}: columns {df.columns}, declared {list(columns)}")


def readiness(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, row_count, ready)."""
    return union([df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count", (F.col("row_count") > 0).alias("ready")) for name, df in tables.items()])
