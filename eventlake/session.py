"""Session factory."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

#: Settings that results or plans rely on; sizes are left to the cluster and to AQE.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
}


def session(app: str = "eventlake", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the defaults; settings in ``conf`` and ``EVENTLAKE_MASTER`` override."""
    builder = SparkSession.builder.appName(app)
    master = master or os.environ.get("EVENTLAKE_MASTER")
    if master:
        builder = builder.master(master)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from ``spark.checkpoint.dir``; in local mode without the setting, a temporary one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    folder = "file://" + tempfile.mkdtemp(prefix="eventlake-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder
