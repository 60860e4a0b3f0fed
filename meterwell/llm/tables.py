"""Written intermediate tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterwell.sources.scratch import scratch_dir

# A key is heavy if more than this part of all rows have it, so fewer keys than this are.
HEAVY = 1_000


def stored(df: DataFrame, name: str) -> DataFrame:
    """`df` written once to the shared folder and read back.

    It cuts the lineage: a lost executor costs a re-read, not the work before it.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stored_in_buckets(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """`df` written once to the shared folder, in buckets by `keys` sorted by them, and read back.

    There are as many buckets as the session shuffles to, so what was just grouped or
    joined by `keys` is written without a shuffle, and later joins by them need none on
    this side. The catalog entry goes at once: the returned frame knows the buckets.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    table = f"meterwell_{path.rsplit('-', 1)[1]}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    writer = df.write.bucketBy(buckets, *keys).sortBy(*keys).option("path", path)
    writer.format("parquet").saveAsTable(table)
    found = spark.table(table)
    spark.sql(f"DROP TABLE {table}")
    return found


def joined_by_weight(rows: DataFrame, labels: DataFrame, key: str, n: str) -> DataFrame:
    """The inner join of `rows` with `labels`, one row a `key`, where no key fills a task.

    `n` is the column of `labels` that counts the rows with its key, and is dropped. The
    labels of heavy keys, fewer than HEAVY whatever the data, are broadcast, and their
    rows stay where they are; all other rows are shuffled. Both frames are read twice, so
    they should be stored ones.
    """
    heavy = F.col(n) * HEAVY > rows.count()
    few = F.broadcast(labels.where(heavy).drop(n))
    usual = rows.join(few.select(key), key, "left_anti").join(labels.where(~heavy).drop(n), key)
    return rows.join(few, key).unionByName(usual)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores before it as keep it apart from `df`'s columns."""
    taken = {column.lower() for column in df.columns}
    free = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        free.append(name)
    return free
