"""Streams into Bronze and Silver."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming.query import StreamingQuery

from eventlake.model import PARTITIONS
from eventlake.operators import bronze, silver
from eventlake.sources.readers import PARTITION_BY
from eventlake.tables import Catalog

Trigger = dict[str, object]
EVERY_MINUTE: Trigger = {"processingTime": "60 seconds"}
ONCE: Trigger = {"availableNow": True}


def bronze_streams(messages: DataFrame, root: str, checkpoints: str, trigger: Trigger = EVERY_MINUTE) -> list[StreamingQuery]:
    """Three appending queries, one for each family; commits are also laid out by collection, which Silver filters on.

    Spark's file sink logs the files of each batch, so a batch that runs again isn't seen twice.
    """
    rows = bronze.to_bronze(messages)
    queries = []
    for kind in bronze.FAMILIES:
        layout = [*PARTITION_BY, "collection"] if kind == "commit" else PARTITION_BY
        writer = bronze.family(rows, kind).writeStream.format("parquet").partitionBy(*layout).option("path", f"{root}/{kind}").option("checkpointLocation", f"{checkpoints}/{kind}")
        queries.append(writer.trigger(**trigger).queryName(f"bronze_{kind}").start())
    return queries


def silver_batch(catalog: Catalog, stream: str) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function that appends a Bronze batch to the Silver tables, each once a batch.

    The appends carry the batch's number: when a batch is delivered again, its rows take their own place.
    An empty batch only makes sure that the tables exist.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for name, build in silver.TABLES.items():
                rows = build(batch)
                table = catalog.table(name, PARTITIONS[name])
                table.create(rows.schema)
                if not batch.isEmpty():
                    table.append(rows, batch=(stream, batch_id))
        finally:
            batch.unpersist()

    return write


def silver_stream(bronze_commits: DataFrame, catalog: Catalog, checkpoint: str, trigger: Trigger = EVERY_MINUTE, stream: str = "silver") -> StreamingQuery:
    return bronze_commits.writeStream.foreachBatch(silver_batch(catalog, stream)).option("checkpointLocation", checkpoint).trigger(**trigger).queryName(stream).start()


def build_silver(bronze_commits: DataFrame, catalog: Catalog) -> None:
    """The batch twin: Silver from all of Bronze, in place of what is there."""
    for name, build in silver.TABLES.items():
        catalog.table(name, PARTITIONS[name]).overwrite(build(bronze_commits))
