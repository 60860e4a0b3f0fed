"""Warehouse tables: Parquet, partitioned, overwritten partition by partition."""

from __future__ import annotations

from collections.abc import Collection, Iterable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as t

from meterwell.schemas import PARTITIONED_BY, TABLES, declared_schema, mismatches


def table_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


def _unfit(schema: t.StructType, name: str) -> list[str]:
    """What keeps rows out of a table. The raw and the detail table take further metrics."""
    if name in TABLES:
        return mismatches(schema, TABLES[name])
    have = set(schema.names)
    needed = {"mobile_number", PARTITIONED_BY[name]}
    shared = [f for f in declared_schema(name).fields if f.name in have | needed]
    return mismatches(schema, t.StructType(shared))


def folder_names(spark: SparkSession, folder: str) -> set[str]:
    """Names of the files and folders in one folder; none if it isn't there."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(path):
        return set()
    return {status.getPath().getName() for status in files.listStatus(path)}


def _remove(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def write_table(
    df: DataFrame,
    root: str,
    name: str,
    pack: bool = True,
    months: Collection[str] | None = None,
    written: dict[str, int] | None = None,
) -> str:
    """Write one warehouse table and return its path.

    Without `months` it replaces what was there. With them it replaces exactly those
    months' partitions: a month without rows in `df` ends up empty, and all others are
    left alone. Each partition changes at once. Months that end up empty are removed
    last; a run that dies before that leaves their old rows, and running it again ends it.

    `pack` shuffles rows to their partition first, into files of the session's
    advisory size: few files, and a partition value that holds most rows is
    still spread over many tasks. Without it each task writes a file for every
    partition value it meets, which suits tables of a few large partitions.

    The rows are counted on their way to the files and put into `written` by name.
    """
    wrong = _unfit(df.schema, name)
    if wrong:
        raise ValueError(f"{name} does not fit its contract: " + "; ".join(wrong))
    by = PARTITIONED_BY[name]
    path = table_path(root, name)
    spark, before = df.sparkSession, {}
    if months is not None:
        before = {f"{path}/{by}={m}": folder_names(spark, f"{path}/{by}={m}") for m in months}
        df = df.filter(F.col(by).isin([*months]))
    out = df.hint("rebalance", F.col(by)) if pack else df
    seen = Observation()
    (
        out.observe(seen, F.count(F.lit(1)).alias("rows"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static" if months is None else "dynamic")
        .option("compression", "snappy")
        .partitionBy(by)
        .parquet(path)
    )
    if written is not None:
        written[name] = seen.get["rows"]
    for folder, old in before.items():
        if old & folder_names(spark, folder):  # no new rows replaced the old ones
            _remove(spark, folder)
    return path


def is_written(spark: SparkSession, root: str, name: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(table_path(root, name))
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def stored_schema(spark: SparkSession, root: str, name: str) -> t.StructType:
    """Declared columns, or the file columns of a table that takes further metrics.

    The partition column comes last and is text, whatever its values look like.
    """
    by = PARTITIONED_BY[name]
    if name in TABLES or not is_written(spark, root, name):
        known = declared_schema(name)
    else:
        known = spark.read.parquet(table_path(root, name)).schema
    return t.StructType([f for f in known.fields if f.name != by]).add(by, "string")


def read_table(
    spark: SparkSession, root: str, name: str, months: Iterable[str] | None = None
) -> DataFrame:
    """A warehouse table; `months` prunes to those partitions."""
    schema = stored_schema(spark, root, name)
    df = spark.read.schema(schema).parquet(table_path(root, name))
    if months is not None:
        df = df.filter(F.col("report_month").isin(*months))
    return df.select(*TABLES[name].names) if name in TABLES else df


def read_table_if_written(spark: SparkSession, root: str, name: str) -> DataFrame | None:
    """The table, or None before its first run."""
    return read_table(spark, root, name) if is_written(spark, root, name) else None


def read_latest_month(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The newest month of a warehouse table, of which only that partition's files are read.

    The month is a subquery over the partition column, answered while the query runs.
    """
    rows = read_table(spark, root, name)
    newest = read_table(spark, root, name).agg(F.max("report_month")).scalar()
    return rows.filter(F.col("report_month") == newest)


def register_tables(
    spark: SparkSession, root: str, database: str, names: Iterable[str] | None = None
) -> list[str]:
    """Declare the warehouse tables in the session catalog, replacing older ones.

    External tables: dropping them leaves the files, and they may be declared
    before the first run writes any.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    done = []
    for name in names or PARTITIONED_BY:
        full = f"`{database}`.`{name}`"
        by = PARTITIONED_BY[name]
        columns = ", ".join(
            f"`{f.name}` {f.dataType.simpleString()}"
            for f in stored_schema(spark, root, name).fields
        )
        spark.sql(f"DROP TABLE IF EXISTS {full}")
        spark.sql(
            f"CREATE TABLE {full} ({columns}) USING parquet "
            f"PARTITIONED BY (`{by}`) LOCATION '{table_path(root, name)}'"
        )
        if is_written(spark, root, name):
            spark.sql(f"ALTER TABLE {full} RECOVER PARTITIONS")
        done.append(f"{database}.{name}")
    return done
