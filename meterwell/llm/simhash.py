"""SimHash near-duplicates: pigeonhole blocks, joined and verified."""

from __future__ import annotations

from itertools import accumulate, combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from meterwell.llm.components import connected_components
from meterwell.llm.tables import free_names, joined_by_weight, stored

BITS = 64
# Bits that may differ between linked fingerprints.
DISTANCE = 3
# Fingerprints are cut into six blocks; three differing bits leave three blocks alike.
WIDTHS = (11, 11, 11, 11, 10, 10)
# Buckets up to this size are compared pair by pair, larger ones by shared midpoints.
CROWD = 256
SHINGLE = 3
SEED = 42
# Hashes counted at once, so that a long text needs no more memory than a short one.
_CHUNK = 1 << 15


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The signed 64-bit SimHash of a whole text; 0 without words.

    A-Z are lower-cased and words are runs of characters other than 0x20 and
    0x09-0x0D, which is what `bytes` methods split and lower-case by.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        starts, ends = [0], [len(joined)]
    else:
        stops = np.fromiter(accumulate(len(w) + 1 for w in words), np.int64, len(words))
        starts = [0, *stops[: len(words) - shingle].tolist()]
        ends = (stops[shingle - 1 :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(starts), _CHUNK):
        spans = zip(starts[at : at + _CHUNK], ends[at : at + _CHUNK])
        hashes = np.array([digest(joined[i:j], seed) for i, j in spans], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(starts), bitorder="little").view("<i8")[0])


@F.pandas_udf(LongType())
def _fingerprints(texts: pd.Series) -> pd.Series:
    return pd.Series([fingerprint(t) for t in texts], dtype="int64")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp long), one row per document."""
    return docs.select(F.col(id_col), _fingerprints(F.col(text_col)).alias("fp"))


def _block_keys() -> Column:
    """The fingerprint reduced to each choice of three of its six blocks."""
    starts = [0, *accumulate(WIDTHS)]
    masks = [((1 << w) - 1) << s for w, s in zip(WIDTHS, starts)]
    choices = combinations(masks, len(WIDTHS) - DISTANCE)
    keys = [_signed(sum(choice)) for choice in choices]
    return F.explode(
        F.array(
            *(
                F.struct(F.lit(i).cast("byte").alias("choice"),
                         F.col("fp").bitwiseAND(F.lit(m)).alias("key"))
                for i, m in enumerate(keys)
            )
        )
    )


def _signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


def _links_in_buckets(buckets: DataFrame) -> DataFrame:
    """Verified links (a, b) inside buckets whose member lists are bounded."""
    close = F.expr(
        f"""flatten(transform(members, (x, i) ->
              transform(filter(slice(members, i + 2, {CROWD}), y -> bit_count(x ^ y) <= {DISTANCE}),
                        y -> struct(x AS a, y AS b))))"""
    )
    return buckets.select(F.explode(close).alias("link")).select("link.*")


def _links_by_midpoint(crowded: DataFrame) -> DataFrame:
    """Links (a, b) that connect exactly what lies within three bits, without pairs.

    Fingerprints three bits apart have a point one bit from one and two bits from
    the other, and exactly one of the two has an even number of ones. So each emits
    its points at distance 0 and 1, and the even ones also those at distance 2. All
    that meet in a point that some member is within one bit of are within three
    bits of that member: one link each to it suffices. A point is met by at most
    2,081 fingerprints, which bounds the lists.
    """
    one = [1 << i for i in range(BITS)]
    near = F.array(*(F.lit(_signed(m)) for m in (0, *one)))
    far = F.array(*(F.lit(_signed(x | y)) for x, y in combinations(one, 2)))
    even = F.bit_count("fp") % 2 == 0

    def points(masks: Column, is_near: bool) -> Column:
        return F.transform(
            masks,
            lambda m: F.struct(
                F.col("fp").bitwiseXOR(m).alias("point"), F.lit(is_near).alias("near")
            ),
        )

    emitted = F.when(even, F.concat(points(near, True), points(far, False))).otherwise(
        points(near, True)
    )
    met = (
        crowded.select("fp", F.explode(emitted).alias("p"))
        .groupBy("p.point")
        .agg(
            F.min(F.when(F.col("p.near"), F.col("fp"))).alias("a"),
            F.collect_list("fp").alias("members"),
        )
        .where("a IS NOT NULL AND size(members) > 1")
    )
    return met.select("a", F.explode("members").alias("b")).where("a != b").distinct()


def near_links(prints: DataFrame) -> DataFrame:
    """Links (a, b) between distinct fingerprints `fp` that connect all within 3 bits.

    Two such share at least three of six blocks, so each goes to 20 buckets of 31 to
    33 bits: enough for buckets to stay small at 10^10 fingerprints. Buckets of up
    to CROWD members are verified pair by pair; the members of larger ones, where
    pairs would grow with the square, are linked by shared midpoints.
    """
    keyed = prints.select("fp", _block_keys().alias("k")).select("fp", "k.*")
    sizes = keyed.groupBy("choice", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = keyed.join(sizes, ["choice", "key"])
    small = shared.where(F.col("n") <= CROWD).groupBy("choice", "key")
    buckets = small.agg(F.sort_array(F.collect_list("fp")).alias("members"))
    pairs = _links_in_buckets(buckets)
    crowded = shared.where(F.col("n") > CROWD).select("fp").distinct()
    return pairs.union(_links_by_midpoint(stored(crowded, "crowded"))).distinct()


def _placed(rows: DataFrame) -> DataFrame:
    """(fp, first_id, component) of the distinct fingerprints of `rows` (id, fp)."""
    prints = stored(rows.groupBy("fp").agg(F.min("id").alias("first_id")), "prints")
    labels = connected_components(near_links(prints), "a", "b")
    placed = prints.join(labels, prints.fp == labels.node, "left").select(
        "fp", "first_id", F.coalesce("component", "fp").alias("component")
    )
    return stored(placed, "placed")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, fingerprint, component_id) for every row of `docs`.

    Documents link when their fingerprints differ in at most three bits;
    component_id is the smallest id reachable. Null and empty texts have fingerprint
    zero and link like any other; whole texts count, however long. Copies share a
    fingerprint and are compared once. Repeated rows come out as often as they came
    in; a null id is never the smallest unless its component has no other. Other
    columns are ignored; an empty table gives an empty one.
    """
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    rows = stored(fingerprints(own, "id", "text"), "fingerprints")
    placed = _placed(rows)
    smallest = placed.groupBy("component").agg(F.min("first_id").alias("component_id"))
    by_print = placed.join(smallest, "component").select("fp", "component_id")
    return rows.join(by_print, "fp").select(
        F.col("id").alias(id_col),
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        "component_id",
    )


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` with its own columns and one document of each group: that with the smallest id.

    A document is an id with a text, so an id that repeats with other texts is judged
    text by text; between texts of the smallest id in a group their hash decides. Rows
    with a null id stay, and rows that repeat a staying document stay together. Null and
    empty texts are one group; whole texts count. Columns may have any names; an empty
    table gives an empty one. A group or a fingerprint that a large part of all rows
    share is not dealt to one task.
    """
    text = F.col(text_col)
    hashes = [F.xxhash64(text), F.xxhash64(text, F.lit(1))]
    rows = docs.select(
        F.col(id_col).alias("id"), hashes[0].alias("h1"), hashes[1].alias("h2"),
        _fingerprints(text).alias("fp"),
    )
    rows = stored(rows, "fingerprints")
    placed = _placed(rows).select("fp", "component")
    known = rows.where("id IS NOT NULL")
    document = F.struct("id", "h1", "h2")
    prints = known.groupBy("fp").agg(F.min(document).alias("own"), F.count(F.lit(1)).alias("n"))
    prints = stored(prints.join(placed, "fp"), "placed-prints")
    firsts = prints.groupBy("component").agg(
        F.min("own").alias("first"), F.count(F.lit(1)).alias("n_prints")
    )
    firsts = stored(firsts, "first-documents")
    by_print = joined_by_weight(prints.select("fp", "n", "component"), firsts, "component", "n_prints")
    by_print = stored(by_print.select("fp", "n", "first"), "first-by-print")
    gone = joined_by_weight(known, by_print, "fp", "n").where(document != F.col("first"))
    names = free_names(docs, "gone_id", "gone_h1", "gone_h2")
    gone = gone.select("id", "h1", "h2").distinct().toDF(*names)
    same = [F.col(name) == own for name, own in zip(names, (F.col(id_col), *hashes))]
    return docs.join(gone, same, "left_anti")
