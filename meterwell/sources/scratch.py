"""Working folders that every executor can reach."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import SparkSession


def shared_root(spark: SparkSession) -> str:
    """The cluster's shared folder from `spark.checkpoint.dir`, else the warehouse folder.

    Both are folders that the driver and all executors reach. On a cluster that sets
    neither, Spark's own choice is a folder beside the driver, which is refused.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir")
    if re.match(r"(file:)?/", warehouse) and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors reach")
    return warehouse.rstrip("/")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder path below the shared root, removed when the driver ends."""
    path = f"{shared_root(spark)}/meterwell/{name}-{uuid.uuid4().hex}"
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hadoop_path)
    return path
