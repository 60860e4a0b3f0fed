from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    root = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[8]")
        .appName("meterwell-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.coalescePartitions.initialPartitionNum", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", str(root / "shared"))
        .config("spark.sql.warehouse.dir", str(root / "warehouse"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def stored_wide(spark, tmp_path_factory):
    """The derived wide table, written once so tests scan files."""
    from meterwell.sources.star import wide_usage

    path = str(tmp_path_factory.mktemp("wide") / "wide")
    wide_usage(spark, SF_DIR).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def usage(spark):
    """All derived events, kept small by the scale of the tables."""
    from meterwell.sources.star import star_events

    return star_events(spark, SF_DIR)
