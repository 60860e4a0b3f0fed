"""Report extracts as CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as t


def write_extract(df: DataFrame, path: str) -> str:
    """CSV with a header, in the order of `df`.

    A top-k extract has a limit and so comes from one task, as one file. Anything else
    is written by the tasks that hold it; files in name order keep a sorted order.
    Nothing passes the driver.
    """
    df.write.mode("overwrite").option("header", True).csv(path)
    return path


def read_extract(spark: SparkSession, path: str, schema: t.StructType) -> DataFrame:
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)
