"""`lag` that stays distributed when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from meterwell.sources.scratch import scratch_dir

# Keys with more rows than this are split into segments of about as many rows.
CROWD = 100_000
_COPIES_PER_TASK_ROW = 10_000


def with_previous_row(
    df: DataFrame, key: str, order: str, values: list[str], crowd: int = CROWD
) -> DataFrame:
    """Add `before`: a struct of `values` from the key's preceding row, or null.

    Rows of a key are ordered by `order` and, within equal values, by a digest of
    the row, so the result does not depend on partitioning.

    A usual key goes through one window. Every crowded key, such as a null or
    placeholder id, is cut into segments of that same order instead, in proportion
    to its rows: `lag` runs inside each segment, and a segment's first row takes
    the last row of the segment before it. Both ways give the same pairs. The
    number of segments is joined to the rows, by broadcast only where adaptive
    execution finds the crowded keys few enough.

    `df` is read twice: to count its keys, and to write its rows with their number
    of segments to the shared folder. The rest reads that table.
    """
    placed = _written(with_bits(df, key, crowd))
    usual = placed.filter("_bits IS NULL").drop("_bits")
    return previous_in_parts(usual, placed.filter("_bits IS NOT NULL"), key, order, values)


def with_bits(df: DataFrame, key: str, crowd: int = CROWD) -> DataFrame:
    """Add `_bits`: the log of the number of segments of the row's key, null if it isn't crowded."""
    crowded = (
        df.groupBy(key)
        .agg(F.count("*").alias("_rows"))
        .filter(F.col("_rows") > crowd)
        .select(
            F.col(key).alias("_key"),
            F.ceil(F.log2(F.col("_rows") / crowd)).cast("int").alias("_bits"),
        )
    )
    return df.join(crowded, F.col(key).eqNullSafe(F.col("_key")), "left").drop("_key")


def previous_in_parts(
    usual: DataFrame, crowded: DataFrame, key: str, order: str, values: list[str]
) -> DataFrame:
    """`with_previous_row` for rows that are parted: those of usual and of crowded keys.

    `crowded` has the column `_bits` beside those of `usual`. Usual keys that are stored
    in buckets need no shuffle.
    """
    helpers = {"_tie": F.xxhash64(*usual.columns), "_here": F.struct(*values)}
    history = Window.partitionBy(key).orderBy(order, "_tie", "_here")
    whole = usual.withColumns(helpers).withColumn("before", F.lag("_here").over(history))
    split = _by_segments(crowded.withColumns(helpers), key, order).drop("_bits")
    return whole.unionByName(split).drop("_tie", "_here")


def _written(rows: DataFrame) -> DataFrame:
    path = scratch_dir(rows.sparkSession, "placed-rows")
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def _by_segments(rows: DataFrame, key: str, order: str) -> DataFrame:
    """The split keys. Equal rows are counted, paired once, and repeated after."""
    place = [key, order, "_segment"]
    distinct = (
        rows.groupBy(*rows.columns)
        .agg(F.count("*").alias("_copies"))
        .withColumn("_segment", F.expr("shiftright(_tie, 64 - _bits)"))
    )

    inside = Window.partitionBy(*place).orderBy("_tie", "_here")
    local = distinct.withColumns(
        {
            "_local": F.lag("_here").over(inside),
            "_last": F.lead(F.lit(1)).over(inside).isNull(),
        }
    )

    # One row per segment and order value. Taken from the windowed rows, so both
    # branches share one shuffle.
    across = Window.partitionBy(key).orderBy(order, "_segment")
    carried = local.filter("_last").select(
        *(F.col(c).alias(f"_c{i}") for i, c in enumerate(place)),
        F.lag("_here").over(across).alias("_carried"),
    )
    same_place = [F.col(c).eqNullSafe(F.col(f"_c{i}")) for i, c in enumerate(place)]
    paired = local.join(carried, same_place[0] & same_place[1] & same_place[2]).withColumn(
        "_first", F.coalesce("_local", "_carried")
    )

    # Copies follow one another, so each but the first is preceded by itself.
    # Long runs are cut into blocks and spread before they are written out.
    block = F.lit(_COPIES_PER_TASK_ROW)
    blocks = paired.withColumn(
        "_from", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_copies") - 1, block))
    ).repartition(*place, "_tie", "_from")
    last = F.least(F.col("_from") + block, F.col("_copies")) - 1
    return (
        blocks.withColumn("_copy", F.explode(F.sequence(F.col("_from"), last)))
        .withColumn("before", F.when(F.col("_copy") == 0, F.col("_first")).otherwise(F.col("_here")))
        .select(*rows.columns, "before")
    )


def spread_copies(rows: DataFrame, copies: str) -> DataFrame:
    """Each row as often as its column `copies` says, without that column.

    Long runs are cut into blocks and dealt out before they are written, so that a row
    with a large share of all copies is the work of many tasks.
    """
    block = F.lit(_COPIES_PER_TASK_ROW)
    usual = rows.filter(F.col(copies) <= block)
    usual = usual.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col(copies))))
    blocks = rows.filter(F.col(copies) > block).withColumn(
        "_from", F.explode(F.sequence(F.lit(0).cast("long"), F.col(copies) - 1, block))
    )
    last = F.least(F.col("_from") + block, F.col(copies)) - 1
    dealt = blocks.repartition(*rows.columns, "_from")
    dealt = dealt.withColumn("_copy", F.explode(F.sequence(F.col("_from"), last))).drop("_from")
    return usual.unionByName(dealt).drop("_copy", copies)
