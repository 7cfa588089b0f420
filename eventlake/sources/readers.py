"""Sources and landing sinks: topic or directory streams of messages, Bronze batches and streams, JSON lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.model import BRONZE, KAFKA

PARTITION_BY = ["ingest_date", "ingest_hour"]


def land_messages(messages: DataFrame, path: str, mode: str = "append") -> None:
    """Messages as JSON lines in a directory that stands in for the topic."""
    messages.select("key", "value", "topic", "partition", "offset", "timestamp").write.mode(mode).json(path)


def stream_messages(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Landed messages as a stream; ``max_files`` a trigger is the back-pressure."""
    reader = spark.readStream.schema(KAFKA)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(path)


def kafka_options(servers: str, topic: str, starting: str = "earliest", max_offsets: int = 5000) -> dict[str, str]:
    """Options of the topic's stream: Bronze starts at the earliest offset, live metrics at ``latest``; ``max_offsets`` a trigger is the back-pressure."""
    return {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting, "maxOffsetsPerTrigger": str(max_offsets)}


def stream_kafka(spark: SparkSession, servers: str, topic: str, starting: str = "earliest", max_offsets: int = 5000) -> DataFrame:
    """The topic itself; needs Spark's Kafka package on the class path."""
    return spark.readStream.format("kafka").options(**kafka_options(servers, topic, starting, max_offsets)).load().select("key", "value", "topic", "partition", "offset", "timestamp")


def read_messages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(KAFKA).json(path)


def read_bronze(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(BRONZE).parquet(path)


def stream_bronze(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(BRONZE)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def read_mart(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_lines(spark: SparkSession, path: str, first: int | None = None) -> DataFrame:
    """Raw JSON lines as ``value``; the first lines only if asked for (a probe)."""
    lines = spark.read.text(path)
    return lines if first is None else lines.limit(first)


def write_mart(df: DataFrame, path: str, kind: str = "parquet", sort_by: list[str] | None = None) -> None:
    """A mart as Parquet, CSV or JSON lines, written by the tasks; sorted within files if asked for, which lets readers skip row groups."""
    out = df.sortWithinPartitions(*sort_by) if sort_by else df
    out.write.mode("overwrite").format(kind).option("header", "true").save(path)


def serving_rows(df: DataFrame) -> DataFrame:
    """The text forms a serving store takes: times without fractions, booleans as 0 and 1 (an unknown deletion counts as none), nulls kept."""
    def shown(name: str, kind: str):
        if kind.startswith("timestamp"):
            return F.date_format(name, "yyyy-MM-dd HH:mm:ss")
        if kind == "date":
            return F.date_format(name, "yyyy-MM-dd")
        if kind == "boolean":
            bit = F.col(name).cast("int")
            return F.coalesce(bit, F.lit(0)) if name == "is_deleted" else bit
        return F.col(name)

    return df.select(*[shown(name, kind).alias(name) for name, kind in df.dtypes])
