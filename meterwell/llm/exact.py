"""Exact duplicates by a content sort over sampled ranges."""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from meterwell.llm.tables import stored
from meterwell.llm.words import mixed

# Bytes of text in a range, which one task sorts (externally where memory ends).
RANGE_BYTES = 16 << 20
# Keys sampled for the splitters, and the fewest a range rests on.
SAMPLE = 100_000
KEYS_PER_RANGE = 10
# Leading bytes of a key.
LEAD = 32
# Ids in one row of the table of runs.
SEGMENT = 4_096
SEED = 12

# Leading bytes, hash of the whole text, salt of the row.
Key = tuple[bytes, int, int]


def normalised(text: bytes | None) -> bytes:
    """Every run of 0x20 and 0x09-0x0D, which is what `bytes.split` splits at, as one space."""
    if not text:
        return b""
    ends = [b"" if end.strip() else b" " for end in (text[:1], text[-1:])]
    inner = b" ".join(text.split())
    return ends[0] + inner + ends[1] if inner else b" "


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list[bytes], list[Key]]]:
    """(ids, normalised texts, keys) of each batch of (id, text as bytes).

    The salt differs from row to row, so that copies of one text can be cut into ranges.
    """
    at = TaskContext.get().partitionId() << 40
    for batch in batches:
        texts = [normalised(t) for t in batch.column(1).to_pylist()]
        salts = mixed(np.arange(at, at + len(texts), dtype=np.uint64)).tolist()
        at += len(texts)
        digest = xxhash.xxh64_intdigest
        yield batch.column(0), texts, [(t[:LEAD], digest(t), s) for t, s in zip(texts, salts)]


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, texts, keys in _keys(batches):
        leads, hashes, salts = zip(*keys) if keys else ((), (), ())
        yield pa.record_batch(
            [
                pa.array(leads, pa.binary()),
                pa.array(np.array(hashes, np.uint64).view(np.int64)),
                pa.array(np.array(salts, np.uint64).view(np.int64)),
                pa.array([len(t) for t in texts], pa.int64()),
            ],
            ["lead", "hash", "salt", "size"],
        )


def splitters(rows: DataFrame, range_bytes: int = RANGE_BYTES, most: int = SAMPLE) -> list[Key]:
    """Keys that cut (id, text) into ranges of about `range_bytes` each.

    They rest on a sample of about `most` rows, whatever the table. Sizes are sampled
    with the keys, so ranges are even in bytes and their number follows from the text.
    """
    n = rows.count()
    share = min(1.0, most / max(n, 1))
    drawn = rows if share == 1 else rows.sample(share, SEED)
    schema = "lead binary, hash long, salt long, size long"
    sample = drawn.mapInArrow(_sampled, schema).collect()
    unsigned = (1 << 64) - 1
    sizes = sorted(
        ((bytes(r.lead), r.hash & unsigned, r.salt & unsigned), r["size"]) for r in sample
    )
    total = sum(size for _, size in sizes)
    ranges = min(-(-int(total / share) // range_bytes), len(sizes) // KEYS_PER_RANGE)
    cuts, upto = [], 0
    for key, size in sizes:
        if len(cuts) + 1 < ranges and upto * ranges >= (len(cuts) + 1) * total:
            cuts.append(key)
        upto += size
    return cuts


def _ranged(cuts: list[Key]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, texts, keys in _keys(batches):
            ranges = pa.array([bisect_right(cuts, key) for key in keys], pa.int32())
            yield pa.record_batch([ids, pa.array(texts, pa.binary()), ranges], ["id", "text", "range"])

    return run


def _runs(
    cuts: list[Key], id_type: pa.DataType
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Compares neighbours of a sorted range and gives out runs of equal texts.

    A run is `open` if other tasks may hold more of it, which only the texts beside a
    splitter can, or if it has more than SEGMENT ids and comes in several rows.
    """
    edges = {key[:2] for key in cuts}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        rows: list[tuple] = []
        sha, ids, is_open = None, [], False
        before = None

        def close() -> None:
            nonlocal ids, seq
            if ids:
                rows.append((sha, ids, is_open, part, seq))
                seq += 1
                ids = []

        def flush() -> pa.RecordBatch:
            columns = list(zip(*rows)) or [()] * 5
            rows.clear()
            types = [pa.binary(), pa.list_(id_type), pa.bool_(), pa.int32(), pa.int64()]
            arrays = [pa.array(c, t) for c, t in zip(columns, types)]
            return pa.record_batch(arrays, ["sha", "ids", "open", "part", "seq"])

        for batch in batches:
            if not batch.num_rows:
                continue
            texts, own = batch.column(1), batch.column(0).to_pylist()
            fresh = pc.not_equal(texts[1:], texts[:-1]).to_numpy(zero_copy_only=False)
            starts = [0, *(np.flatnonzero(fresh) + 1).tolist()]
            for begin, end in zip(starts, [*starts[1:], len(own)]):
                if begin or texts[0].as_py() != before:
                    close()
                    text = texts[begin].as_py()
                    sha = hashlib.sha256(text).digest()
                    is_open = (text[:LEAD], xxhash.xxh64_intdigest(text)) in edges
                for at in range(begin, end, SEGMENT):
                    if len(ids) + min(end - at, SEGMENT) > SEGMENT:
                        is_open = True
                        close()
                    ids = ids + own[at : min(end, at + SEGMENT)]
            before = texts[-1].as_py()
            if len(rows) >= SEGMENT:
                yield flush()
        close()
        yield flush()

    return run


def runs_of_equal_texts(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    range_bytes: int = RANGE_BYTES,
) -> DataFrame:
    """(sha, ids, open, part, seq): the content-sorted table as runs of equal normalised texts.

    Rows go to ranges of (leading bytes, hash, salt): order by content first, while a
    splitter stays small however long the texts and a text that fills many ranges is
    cut like any other. Each range is sorted by its whole bytes and id, externally
    where it must. `ids` are sorted, nulls last.
    """
    id_type = docs.schema[id_col].dataType
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"))
    cuts = splitters(rows, range_bytes)
    id_ddl = id_type.simpleString()
    ranged = rows.mapInArrow(_ranged(cuts), f"id {id_ddl}, text binary, range int")
    dealt = ranged.repartitionById(len(cuts) + 1, F.col("range")).select("id", "text")
    ordered = dealt.sortWithinPartitions(F.col("text"), F.col("id").asc_nulls_last())
    schema = f"sha binary, ids array<{id_ddl}>, open boolean, part int, seq long"
    return ordered.mapInArrow(_runs(cuts, to_arrow_type(id_type)), schema)


def exact_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    range_bytes: int = RANGE_BYTES,
) -> DataFrame:
    """(id, keep_id, group_size, kept, text_sha256) for every row of `docs`, dropped ones too.

    Texts are equal when the whole texts are, after each run of 0x20 and 0x09-0x0D
    became one space; null counts as empty. Of equal texts the row with the smallest
    id stays, and keep_id is that id. A null id is larger than any other, so it is kept
    only in a group without another. Of rows that repeat id and text exactly one is
    kept, and each counts in group_size. text_sha256 is the lowercase hex digest of the
    normalised text in UTF-8. Other columns are ignored, whatever their names; an
    empty table gives an empty one. Rows must come in the same order when a task is
    run again, as those of a table do.

    Runs that lie in one range are final as they are. Only those cut by a range's end
    and those longer than SEGMENT are put together, by digest, from their few rows.
    """
    runs = stored(runs_of_equal_texts(docs, id_col, text_col, range_bytes), "runs")
    whole = runs.where("NOT open").select(
        "sha",
        F.posexplode("ids").alias("pos", "id"),
        F.col("ids")[0].alias("keep_id"),
        F.size("ids").cast("long").alias("group_size"),
    )
    whole = whole.withColumn("kept", F.col("pos") == 0)
    cut = runs.where("open").withColumn(
        "first",
        F.struct(F.col("ids")[0].isNull().alias("none"), F.col("ids")[0].alias("id"), "part", "seq"),
    )
    groups = cut.groupBy("sha").agg(
        F.min("first").alias("least"), F.sum(F.size("ids")).alias("group_size")
    )
    cut = cut.join(groups, "sha").select(
        "sha",
        F.posexplode("ids").alias("pos", "id"),
        F.col("least.id").alias("keep_id"),
        "group_size",
        (F.col("first") == F.col("least")).alias("leads"),
    )
    cut = cut.withColumn("kept", F.col("leads") & (F.col("pos") == 0)).drop("leads")
    return whole.unionByName(cut).select(
        F.col("id").alias(id_col),
        "keep_id",
        "group_size",
        "kept",
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


#: The same rows in DuckDB SQL.
SQL = r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t
           FROM documents)
SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id,
       count(*) OVER (PARTITION BY t) AS group_size,
       row_number() OVER (PARTITION BY t ORDER BY doc_id NULLS LAST) = 1 AS kept,
       sha256(t) AS text_sha256
FROM d
"""
