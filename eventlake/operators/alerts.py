"""Spike alerts over a filled grid of time: median and MAD of what came before, and hysteresis."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Buckets that a level is judged against; fewer than ``LEAST`` give no judgement.
BACK, LEAST = 24, 6
#: An alert opens at so many scaled MADs over the median and closes at so many.
OPEN, CLOSE = 3.0, 1.0
#: A MAD times this estimates a standard deviation; it counts as one event at least, so quiet series don't alert at every event.
SCALE = 1.4826


def filled(counts: DataFrame, series: str, every: str) -> DataFrame:
    """``counts`` (series, bucket, n) with a row of zero for each bucket that is missing between a series' first and last."""
    spans = counts.groupBy(series).agg(F.min("bucket").alias("from"), F.max("bucket").alias("to"))
    grid = spans.select(series, F.explode(F.sequence("from", "to", F.expr(f"INTERVAL {every}"))).alias("bucket"))
    return grid.join(counts, [series, "bucket"], "left").withColumn("n", F.coalesce("n", F.lit(0)).cast("long"))


def middle(values: Column) -> Column:
    """The median of an array of numbers."""
    ordered, n = F.array_sort(values), F.size(values)
    return (F.get(ordered, F.floor((n - 1) / 2).cast("int")) + F.get(ordered, F.floor(n / 2).cast("int"))) / F.lit(2.0)


def levels(grid: DataFrame, series: str) -> DataFrame:
    """The grid with median, spread and score of each bucket against the ``BACK`` before it, and whether an alert is on there."""
    in_time = Window.partitionBy(series).orderBy("bucket")
    rows = grid.withColumn("before", F.collect_list("n").over(in_time.rowsBetween(-BACK, -1)))  # at most BACK numbers
    rows = rows.withColumn("median", F.when(F.size("before") >= LEAST, middle(F.col("before"))))
    rows = rows.withColumn("spread", F.greatest(F.lit(1.0), F.lit(SCALE) * middle(F.transform("before", lambda x: F.abs(x - F.col("median"))))))
    rows = rows.withColumn("score", (F.col("n") - F.col("median")) / F.when(F.col("median").isNotNull(), F.col("spread"))).drop("before")
    signal = F.when(F.col("score") >= OPEN, True).when(F.col("score") <= CLOSE, False)
    state = F.last(signal, ignorenulls=True).over(in_time.rowsBetween(Window.unboundedPreceding, 0))
    return rows.withColumn("on", F.coalesce(state, F.lit(False)))


def alerts(rows: DataFrame, series: str) -> DataFrame:
    """series, started_at, last_at, buckets, peak, peak_score of each run of buckets with an alert on."""
    in_time = Window.partitionBy(series).orderBy("bucket")
    starts = (F.col("on") & ~F.coalesce(F.lag("on").over(in_time), F.lit(False))).cast("int")
    runs = rows.withColumn("starts", starts).withColumn("run", F.sum("starts").over(in_time)).where("on")
    return runs.groupBy(series, "run").agg(
        F.min("bucket").alias("started_at"), F.max("bucket").alias("last_at"), F.count("*").alias("buckets"), F.max("n").alias("peak"), F.max("score").alias("peak_score")).drop("run")
