"""Document fingerprints: bottom-k sketches of shingle hashes."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterwell.llm.words import hashed_texts, string_hashes

SHINGLE = 5
# Hashes kept, and their bits: six bytes are eight characters of base 64.
K = 256
BITS = 48
_CHUNK = 1 << 20


def text_sketches(texts: list[str], shingle: int = SHINGLE, k: int = K) -> list[np.ndarray]:
    """The `k` smallest distinct shingle hashes of each whole text, in order.

    A text with fewer words is one shingle, one without words has none.
    """
    words, ends = hashed_texts([t.encode("utf-8", "surrogatepass") for t in texts])
    shift = np.uint64(64 - BITS)
    strings = string_hashes(words, shingle) >> shift
    found = []
    for begin, end in zip(ends[:-1].tolist(), ends[1:].tolist()):
        if end - begin >= shingle:
            own = strings[begin : end - shingle + 1]
        else:
            own = string_hashes(words[begin:end], end - begin) >> shift if end > begin else words[:0]
        if len(own) > 4 * k:  # few of a long text's hashes can be among the smallest
            few = np.unique(np.partition(own, 2 * k)[: 2 * k])
            own = few if len(few) >= k else own
        found.append(np.unique(own)[:k])
    return found


def encoded(sketch: np.ndarray) -> str:
    """A sketch as text: base 64 of its hashes in order, six big-endian bytes each."""
    raw = sketch.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - BITS // 8 :]
    return base64.b64encode(raw.tobytes()).decode()


def decoded(text: str) -> np.ndarray:
    raw = np.frombuffer(base64.b64decode(text), np.uint8).reshape(-1, BITS // 8)
    full = np.zeros((len(raw), 8), np.uint8)
    full[:, 8 - BITS // 8 :] = raw
    return full.view(">u8").ravel().astype(np.uint64)


def merged(a: np.ndarray, b: np.ndarray, k: int = K) -> np.ndarray:
    """The sketch of the union of what two sketches stand for."""
    return np.union1d(a, b)[:k]


def distinct_shingles(a: np.ndarray, k: int = K) -> float:
    """Estimated number of distinct shingles; exact below k."""
    return float(len(a)) if len(a) < k else (k - 1) / (float(a[k - 1] + 1) / 2.0**BITS)


def resemblance(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated share of the union of two shingle sets that both hold; 1 for two empty ones."""
    union = merged(a, b, k)
    if not len(union):
        return 1.0
    both = np.isin(union, a, assume_unique=True) & np.isin(union, b, assume_unique=True)
    return float(both.mean())


def containment(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated share of a's shingles that b holds; 1 for an empty a."""
    own = distinct_shingles(a, k)
    if not own:
        return 1.0
    return min(1.0, resemblance(a, b, k) * distinct_shingles(merged(a, b, k), k) / own)


def merge_sketches(sketches: DataFrame, by: list[str], column: str = "fingerprint") -> DataFrame:
    """One fingerprint for each group of `by`: that of all its texts together.

    Equal hashes are merged before the shuffle and the k smallest are kept, so a
    group with any number of rows is merged in bounded memory.
    """

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [
                (*(key if isinstance(key, tuple) else (key,)), h)
                for key, own in batch.groupby(by, dropna=False, sort=False)
                for h in np.unique(np.concatenate([decoded(x) for x in own[column]]))[:K].tolist()
            ]
            yield pd.DataFrame(rows, columns=[*by, "hash"])

    types = dict(sketches.dtypes)
    schema = ", ".join(f"`{c}` {types[c]}" for c in by) + ", hash long"
    hashes = sketches.select(*by, column).mapInPandas(fold, schema).distinct()
    rank = F.row_number().over(Window.partitionBy(*by).orderBy("hash"))
    kept = hashes.withColumn("_rank", rank).where(F.col("_rank") <= K)
    joined = F.array_join(
        F.transform(
            F.sort_array(F.collect_list("hash")),
            lambda h: F.lpad(F.hex(h), BITS // 4, "0"),
        ),
        "",
    )
    return kept.groupBy(*by).agg(F.base64(F.unhex(joined)).alias(column))


def _ranges(docs: DataFrame, parts: int) -> tuple[list[int], dict[int, int], int | None]:
    """Bounds that cut the ids into `parts` ranges, the first id of each range and of all."""
    shares = [i / parts for i in range(1, parts)] or [0.5]
    bounds = docs.agg(F.percentile_approx("id", shares, 10_000).alias("b")).first()["b"] or []
    bounds = sorted(set(bounds))
    firsts = docs.where("id IS NOT NULL").groupBy(_range_of(bounds).alias("r")).agg(F.min("id"))
    found = {r: first for r, first in firsts.collect()}  # one row per range
    return bounds, found, min(found.values(), default=None)


def _range_of(bounds: list[int]) -> Column:
    known = F.array(*map(F.lit, bounds)) if bounds else F.array().cast("array<bigint>")
    return F.coalesce(F.size(F.filter(known, lambda b: b <= F.col("id"))), F.lit(0))


def with_next(docs: DataFrame) -> DataFrame:
    """(id, text, range, ahead): rows dealt by ranges of ids and sorted in each.

    The first document of a range also goes to the range before, marked `ahead`, and
    the very first one to the last range, so that every task sees the document after
    its last one. Ranges are cut from the ids alone; texts are shuffled once.
    """
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bounds, firsts, very_first = _ranges(docs, parts)
    order = sorted(firsts)
    before = {firsts[r]: order[i - 1] for i, r in enumerate(order)}  # the first one: the last range
    own = F.struct(_range_of(bounds).alias("range"), F.lit(False).alias("ahead"))
    if before:
        targets = F.create_map(*(F.lit(x) for pair in before.items() for x in pair))
        ahead = F.struct(targets[F.col("id")].alias("range"), F.lit(True).alias("ahead"))
        places = F.when(F.col("id").isin(list(before)), F.array(own, ahead)).otherwise(F.array(own))
    else:
        places = F.array(own)
    dealt = docs.select("id", "text", F.explode(places).alias("p")).select("id", "text", "p.*")
    dealt = dealt.repartition(parts, "range").sortWithinPartitions("range", "ahead", "id", "text")
    return dealt.select(F.col("id").cast("string").alias("id"), "text", "range", "ahead")


_OUTPUT = (
    "n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double, n_shingles double"
)


def _described(rows: list[tuple], following: list[str]) -> pd.DataFrame:
    """Results for consecutive documents (id, text), each with the text after it."""
    texts = [text for _, text in rows]
    edited = [t[: len(t) - len(t) // 2] + f[: len(t) // 2] for t, f in zip(texts, following)]
    # The text after one is the next one's own text, but for the last.
    sketches = text_sketches([*texts, following[-1]])
    edits = text_sketches(edited)
    out = []
    for i, (id_, text) in enumerate(rows):
        out.append(
            (
                id_, len(text), hashlib.sha256(edited[i].encode("utf-8")).hexdigest(),
                encoded(sketches[i]), encoded(edits[i]), resemblance(sketches[i], edits[i]),
                resemblance(sketches[i], sketches[i + 1]), distinct_shingles(sketches[i]),
            )
        )
    return pd.DataFrame(
        out, columns=["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                      "near_edited", "near_next", "n_shingles"],
    )


def _describe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """One pass over sorted ranges; a document waits until the one after it is known."""
    waiting: list[tuple] = []  # (id, text) of one range, its last one without a successor yet
    size, here = 0, None

    def flush(successor: str, keep_last: bool) -> pd.DataFrame | None:
        nonlocal waiting, size
        rows = waiting[:-1] if keep_last else waiting
        if not rows:
            return None
        following = [t for _, t in waiting[1:]] + ([] if keep_last else [successor])
        waiting, size = (waiting[-1:], len(waiting[-1][1])) if keep_last else ([], 0)
        return _described(rows, following)

    for batch in batches:
        for id_, text, range_, ahead in zip(
            batch["id"], batch["text"], batch["range"], batch["ahead"]
        ):
            text = text or ""
            if here is not None and range_ != here and waiting:
                yield flush(waiting[0][1], False)  # nothing has an id after it
            here = range_
            if ahead:
                if waiting:
                    yield flush(text, False)
                continue
            waiting.append((id_, text))
            size += len(text)
            if size >= _CHUNK and len(waiting) > 1:
                yield flush("", True)
    if waiting:
        yield flush(waiting[0][1], False)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next,
    n_shingles) for every row of `docs`.

    A fingerprint is the bottom-k sketch of the whole text's shingles of five words; the
    edited text is the text with its last half replaced by as much of the start of the
    next document's, by id, the first one following the last. Null texts count as empty;
    two empty sketches are alike by 1. Rows that repeat an id follow each other in order
    of their texts, null ids come first; a lone document follows itself. Other columns
    are ignored; an empty table gives an empty one.
    """
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    found = with_next(own).mapInPandas(_describe, f"id string, {_OUTPUT}")
    return found.select(
        F.col("id").cast(own.schema["id"].dataType).alias(id_col), *found.columns[1:]
    )
