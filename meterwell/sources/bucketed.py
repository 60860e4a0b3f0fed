"""A long table kept in buckets of customers, for reports that look at a customer's rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterwell.operators.neighbours import CROWD, with_bits
from meterwell.sources.scratch import scratch_dir

# Rows that a bucket holds on average, and the fewest and the most buckets of a table.
BUCKET_ROWS, FEWEST, MOST = 2_000_000, 8, 100_000


@dataclass(frozen=True)
class Buckets:
    """Catalog names of a table's two parts, and the column whose values lie together."""

    usual: str
    crowded: str
    key: str

    def read(self, spark: SparkSession) -> tuple[DataFrame, DataFrame]:
        """The rows of usual keys, in buckets, and those of crowded keys with `_bits`."""
        return spark.table(self.usual), spark.table(self.crowded)

    def drop(self, spark: SparkSession) -> None:
        """Forget both parts. Their files stay where they were written."""
        for name in (self.usual, self.crowded):
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def bucket_count(rows: int) -> int:
    """Buckets for a number of rows: a power of two, so that tables of one key fit together."""
    count = FEWEST
    while count * BUCKET_ROWS < rows and count < MOST:
        count *= 2
    return count


def write_buckets(
    long: DataFrame,
    root: str,
    name: str,
    key: str = "mobile_number",
    order: str = "report_month",
    buckets: int | None = None,
    crowd: int = CROWD,
) -> Buckets:
    """Write `long` below `root` as the catalog tables `name` and `name`_crowded.

    One shuffle by `key` pays for every later window, group or join by it. Each bucket
    is one file, sorted by `key` and `order`. A key with more than `crowd` rows, such as
    a placeholder id or null, would fill a bucket of its own; its rows go to the second
    table, which is dealt evenly, with the number of segments that a window over it
    should use. No row is in both or in neither.

    `long` is read twice, to count its keys and to store its rows with their segments;
    the tables are written from the stored rows. An empty table has empty buckets.
    """
    spark = long.sparkSession
    staged = scratch_dir(spark, "bucket-rows")
    placed = with_bits(long, key, crowd)
    placed.write.parquet(staged)
    placed = spark.read.schema(placed.schema).parquet(staged)

    usual = placed.filter("_bits IS NULL").drop("_bits")
    count = buckets or bucket_count(usual.count())
    made = Buckets(f"`{name}`", f"`{name}_crowded`", key)
    made.drop(spark)
    (
        usual.repartition(count, F.col(key))
        .write.bucketBy(count, key)
        .sortBy(key, order)
        .mode("overwrite")
        .option("path", f"{root.rstrip('/')}/{name}")
        .saveAsTable(made.usual)
    )
    (
        placed.filter("_bits IS NOT NULL")
        .write.mode("overwrite")
        .option("path", f"{root.rstrip('/')}/{name}_crowded")
        .saveAsTable(made.crowded)
    )
    return made
