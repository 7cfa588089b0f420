import os

import sys
import pytest

os.environ.setdefault("TZ", "UTC")
sys.path.insert(0, os.path.dirname(__file__))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    shared = tmp_path_factory.mktemp("shared")
    s = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.warehouse.dir", str(shared / "warehouse"))
        .config("spark.checkpoint.dir", f"file://{shared}/checkpoint")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    return s
