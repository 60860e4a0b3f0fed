"""Mixing sources to target weights with hash-threshold histograms."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterwell.llm.tables import free_names, stored

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
# A document's place is a number of 48 bits; each level of histograms settles 12 of them.
PLACE_BITS = 48
LEVEL_BITS = 12


def size_of(text: Column) -> Column:
    """Number of words of the whole text, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def place_of(id_: Column, text: Column) -> Column:
    """Where a document stands in its source's order: from its id and text, so reruns agree."""
    empty = F.lit("")
    named = F.concat(F.coalesce(id_.cast("string"), empty), F.lit(":"), F.coalesce(text, empty))
    return F.conv(F.substring(F.md5(named), 1, PLACE_BITS // 4), 16, 10).cast("long")


def source_targets(
    sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST
) -> DataFrame:
    """(source, source_size, target) from one row (source, source_size) per source.

    Sources in code point order, null last, weigh `weights` in turn and split `share`
    of all sizes. A target stops at `most` times its source's size and its excess goes
    to the others by weight: in the end all others get the same multiple of their
    weight. That multiple is found by going through the sources in the order in which
    they fill up. The windows here see one row per source.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    weight = reduce(
        lambda c, i: c.when(turn == i, weights[i]), range(1, len(weights)),
        F.when(turn == 0, weights[0]),
    )
    named = sizes.select("source", "source_size", weight.alias("weight")).withColumn(
        "cap", F.col("source_size") * most
    )
    fills = F.col("cap") / F.col("weight")
    filling = Window.orderBy(fills, F.col("source").asc_nulls_last())
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    after = filling.rowsBetween(0, Window.unboundedFollowing)
    everything = filling.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rest = F.sum("source_size").over(everything) * F.lit(float(share)) - F.coalesce(
        F.sum("cap").over(before), F.lit(0)
    )
    levels = named.select(
        "source", "source_size", "weight", "cap", fills.alias("fills"),
        (rest / F.sum("weight").over(after)).alias("level"),
    )
    fit = F.when(F.col("level") <= F.col("fills"), F.struct("fills", "level"))
    multiple = F.min(fit).over(Window.partitionBy())["level"]
    cap = F.col("cap").cast("double")
    return levels.select(
        "source", "source_size",
        F.coalesce(F.least(cap, multiple * F.col("weight")), cap).alias("target"),
    )


def _boundary(sized: DataFrame, state: DataFrame, column: str) -> DataFrame:
    """`state` with the one value of `column` at which a source's wanted words are reached.

    Nested histograms: each level sums sizes by source and the next bits of the column,
    within the bucket of the level before in which the words are reached, and only
    there. `at` is the place looked into, or -1 for all.
    """
    for bits in range(LEVEL_BITS, PLACE_BITS + 1, LEVEL_BITS):
        outer = F.shiftright(column, PLACE_BITS - bits + LEVEL_BITS)
        bucket = F.shiftright(column, PLACE_BITS - bits)
        inside = sized.alias("s").join(
            state.select("source", "wanted", "at", "prefix", "below").alias("p"),
            F.col("s.source").eqNullSafe(F.col("p.source"))
            & (outer == F.col("p.prefix"))
            & ((F.col("p.at") < 0) | (F.col("s.place") == F.col("p.at"))),
        )
        counts = inside.groupBy("p.source", "wanted", "at", "below", bucket.alias("bucket")).agg(
            F.sum("size").alias("weight"), F.count(F.lit(1)).alias("rows")
        )
        upto = F.col("below") + F.sum("weight").over(
            Window.partitionBy("source").orderBy("bucket")
        )
        reached = counts.select(
            "source", "wanted", "at", "bucket", "weight", "rows",
            (upto - F.col("weight")).alias("below"), (upto >= F.col("wanted")).alias("enough"),
        )
        first = F.min(F.when(F.col("enough"), F.struct("bucket", "below", "weight", "rows")))
        state = reached.groupBy("source", "wanted", "at").agg(first.alias("first")).select(
            "source", "wanted", "at", F.col("first.bucket").alias("prefix"),
            F.col("first.below").alias("below"), F.col("first.weight").alias("weight"),
            F.col("first.rows").alias("rows"),
        )
        state = stored(state, "boundary")
    return state


def _thresholds(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, source_size, target, base, at, last): each source's mix.

    Every row is taken `base` times, and once more if its place is before `at`, or is
    `at` and its tie at most `last`. Nested histograms find `at`; where several rows
    share that place, as rows that repeat do, histograms over their ties go on. At the
    end a single row is left, which is taken if that comes nearer to the target.
    """
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0)
    plan = targets.withColumn("base", F.floor(ratio)).withColumn(
        "wanted", F.col("target") - F.col("base") * F.col("source_size")
    )
    plan = stored(plan, "targets")
    zero, every = F.lit(0).cast("long"), F.lit(-1).cast("long")
    state = plan.where("wanted > 0").select(
        "source", "wanted", every.alias("at"), zero.alias("prefix"), zero.alias("below")
    )
    state = _boundary(sized, state, "place").withColumn("at", F.col("prefix"))
    shared = state.where("rows > 1")
    over = F.col("below") + F.col("weight") - F.col("wanted")
    nearer = over < F.col("wanted") - F.col("below")
    ends = state.where("rows = 1").select(
        "source", "at", F.when(nearer, F.lit((1 << PLACE_BITS) - 1)).otherwise(-1).alias("last")
    )
    if not shared.isEmpty():
        ties = _boundary(sized, shared.withColumn("prefix", zero), "tie")
        last = F.when(nearer, F.col("prefix")).otherwise(F.col("prefix") - 1)
        ends = ends.unionByName(ties.select("source", "at", last.alias("last")))
    ends = ends.withColumnRenamed("source", "of")
    return plan.join(ends, F.col("source").eqNullSafe(F.col("of")), "left").select(
        "source", "source_size", "target", "base",
        F.coalesce("at", every).alias("at"), F.coalesce("last", every).alias("last"),
    )


def tie_of() -> Column:
    """A number of its own for each row of a stored table, which parts rows that repeat."""
    return F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(1 << PLACE_BITS))


def _sized(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    return docs.select(
        F.col(id_col).alias("id"),
        F.col(source_col).alias("source"),
        size_of(F.col(text_col)).alias("size"),
        place_of(F.col(id_col), F.col(text_col)).alias("place"),
        tie_of().alias("tie"),
    )


def _plan(sized: DataFrame) -> DataFrame:
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    return stored(_thresholds(sized, source_targets(sizes)), "mix")


def _times(base: str, at: str, last: str, place: str, tie: str) -> Column:
    more = (F.col(place) < F.col(at)) | ((F.col(place) == F.col(at)) & (F.col(tie) <= F.col(last)))
    return F.col(base) + F.when(more, 1).otherwise(0)


def mixture(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source"
) -> DataFrame:
    """(id, size, source_size, target, taken) for every row of `docs`.

    Documents are taken whole, so a source's taken words differ from its target by
    at most half a document. No sort of documents: two passes, a histogram of at
    most 4,096 rows a source for each level, and a filter. Null and empty texts have
    size 0 and take nothing; a null source is a source of its own. Rows that repeat id
    and text are alike until the boundary falls among them: then as many of them are
    taken as come nearest, and it doesn't matter which. Other columns are ignored; an
    empty table gives an empty one.
    """
    sized = stored(_sized(docs, id_col, text_col, source_col), "sizes")
    plan = _plan(sized).withColumnRenamed("source", "of")
    mixed = sized.join(plan, F.col("source").eqNullSafe(F.col("of")))
    times = _times("base", "at", "last", "place", "tie")
    return mixed.select(
        F.col("id").alias(id_col), "size", "source_size", "target",
        (F.col("size") * times).cast("long").alias("taken"),
    )


def mixed_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source"
) -> DataFrame:
    """`docs` with its own columns, each row as often as the mix takes it.

    The mix is that of `mixture`, over whole texts; rows without words, null texts among
    them, follow their place like others. Texts are not shuffled: a row's number of
    copies follows from its source's row of the plan and its own place. `docs`
    must be a table or come in the same order each time it is read, as rows that repeat
    are told apart by their position. Columns may have any names; an empty table gives
    an empty one.
    """
    sized = stored(_sized(docs, id_col, text_col, source_col), "sizes")
    names = free_names(docs, "mix_source", "mix_base", "mix_at", "mix_last")
    place, tie, copy = free_names(docs, "mix_place", "mix_tie", "mix_copy")
    plan = _plan(sized).select("source", "base", "at", "last").toDF(*names)
    placed = docs.withColumns({place: place_of(F.col(id_col), F.col(text_col)), tie: tie_of()})
    mixed = placed.join(plan, F.col(source_col).eqNullSafe(F.col(names[0])))
    copies = F.array_repeat(F.lit(0), _times(*names[1:], place, tie).cast("int"))
    own = [F.col(f"`{c}`") for c in docs.columns]
    return mixed.withColumn(copy, F.explode(copies)).select(*own)


#: The same rows in DuckDB SQL, with a sort in place of the histograms.
SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)
           AS BIGINT) AS size,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' ||
           coalesce(text, '')), 1, 12) AS BIGINT) AS place
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, 2 * source_size AS cap,
        CASE (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3
          WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight FROM s),
f AS (SELECT *, cap / CAST(weight AS DOUBLE) AS fills,
        (sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(cap) OVER (
           ORDER BY cap / CAST(weight AS DOUBLE), source NULLS LAST
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
        / sum(weight) OVER (ORDER BY cap / CAST(weight AS DOUBLE), source NULLS LAST
           ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
m AS (SELECT arg_min(level, fills) AS multiple FROM f WHERE level <= fills),
t AS (SELECT source, source_size, coalesce(least(CAST(cap AS DOUBLE),
        (SELECT multiple FROM m) * weight), CAST(cap AS DOUBLE)) AS target FROM f),
b AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS base
      FROM t),
c AS (SELECT d.*, b.source_size, b.target, b.base, b.target - b.base * b.source_size AS wanted,
        sum(size) OVER (PARTITION BY d.source ORDER BY place, doc_id
                        ROWS UNBOUNDED PRECEDING) AS upto
      FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, size, source_size, target,
       CAST(size * (base + CASE WHEN wanted > 0 AND
         (upto <= wanted OR upto - wanted < wanted - (upto - size)) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM c
"""
