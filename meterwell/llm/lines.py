"""Line dedup with levelled sorted runs of line hashes, which each batch merge-anti-joins."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterwell.llm.tables import free_names, stored, stored_in_buckets

# White space at line ends: space and U+0009 to U+000D.
BLANKS = " \t\n\x0b\f\r"
MIN_CHARS = 20
MIN_DOCS = 3
# Parts in which a table is loaded, and runs of one level that are merged into one.
BATCHES = 4
FANOUT = 2


def line_key(line: Column) -> Column:
    """The line without blanks at its ends, A-Z in lower case."""
    return F.btrim(
        F.translate(line, string.ascii_uppercase, string.ascii_lowercase), F.lit(BLANKS)
    )


def hashed_lines(docs: DataFrame) -> DataFrame:
    """(id, text_hash, pos, h1, h2) of every line of (id, text) whose key is long enough.

    A key stands as 128 hash bits; id and text hash tell documents apart.
    """
    text = F.coalesce("text", F.lit(""))
    lines = docs.select("id", F.xxhash64(text).alias("text_hash"), F.posexplode(F.split(text, "\n")))
    keyed = lines.select("id", "text_hash", "pos", line_key(F.col("col")).alias("key"))
    return keyed.where(F.length("key") >= MIN_CHARS).select(
        "id", "text_hash", "pos", F.xxhash64("key").alias("h1"),
        F.xxhash64("key", F.lit(1)).alias("h2"),
    )


class LineRuns:
    """Sorted runs of (h1, h2, n_docs, last_id), in levels.

    `add` merge-anti-joins a batch with all live runs and writes what is left as the
    batch's own run on level 0. A key that a run settles, held by `min_docs` documents
    and by an id as large as any of the batch's, would change nothing and is not written
    again; so `n_docs` is exact below `min_docs` only. When a level holds `fanout` runs
    they are merged into one run of the next level, so a key is rewritten only once a
    level and there are at most `fanout` - 1 runs a level. Runs lie in the shared folder,
    in buckets of hashes and sorted in each: neither the anti-joins nor the merges shuffle
    them. A batch must not hold a document of an earlier one; batches may come in any
    order.
    """

    def __init__(self, min_docs: int = MIN_DOCS, fanout: int = FANOUT):
        self.min_docs = min_docs
        self.fanout = fanout
        self.levels: list[list[DataFrame]] = []

    def add(self, lines: DataFrame) -> None:
        self._put(self.unsettled(lines), 0)

    def unsettled(self, lines: DataFrame) -> DataFrame:
        """The keys of a batch of lines that no live run settles."""
        per_doc = lines.select("h1", "h2", "id", "text_hash").distinct()
        batch = per_doc.groupBy("h1", "h2").agg(
            F.count(F.lit(1)).alias("n_docs"), F.max("id").alias("last_id")
        )
        for run in self._live():
            settled = run.where(F.col("n_docs") >= self.min_docs).select(
                F.col("h1").alias("k1"), F.col("h2").alias("k2"), F.col("last_id").alias("k_last")
            )
            same = (F.col("h1") == F.col("k1")) & (F.col("h2") == F.col("k2"))
            nothing_new = F.col("last_id").isNull() | (F.col("last_id") <= F.col("k_last"))
            batch = batch.join(settled.hint("merge"), same & nothing_new, "left_anti")
        return batch

    def _live(self) -> list[DataFrame]:
        return [run for level in self.levels for run in level]

    def _put(self, run: DataFrame, level: int) -> None:
        if level == len(self.levels):
            self.levels.append([])
        here = self.levels[level]
        here.append(stored_in_buckets(run, ["h1", "h2"], f"run-{level}"))
        if len(here) >= self.fanout:
            merged = self._merged(here)
            self.levels[level] = []
            self._put(merged, level + 1)

    @staticmethod
    def _merged(runs: list[DataFrame]) -> DataFrame:
        """One row per key: runs are merged in the order of their sort, two at a time."""
        merged = runs[0]
        for run in runs[1:]:
            other = run.toDF("k1", "k2", "k_docs", "k_last").hint("merge")
            same = (F.col("h1") == F.col("k1")) & (F.col("h2") == F.col("k2"))
            merged = merged.join(other, same, "full").select(
                F.coalesce("h1", "k1").alias("h1"),
                F.coalesce("h2", "k2").alias("h2"),
                (F.coalesce("n_docs", F.lit(0)) + F.coalesce("k_docs", F.lit(0))).alias("n_docs"),
                F.greatest("last_id", "k_last").alias("last_id"),
            )
        return merged

    def keys(self) -> DataFrame:
        """All runs merged, one row per key."""
        return self._merged(self._live())

    def surplus(self, lines: DataFrame) -> DataFrame:
        """The rows of `lines` that repeat, by one semi-join with all runs merged.

        A row goes if at least `min_docs` documents hold its key and one of them has
        a larger id; that is known only after all batches, so it is asked once. The
        keys that go are stored without buckets first: both sides are then shuffled,
        and adaptive execution can split a line that a large part of the documents holds.
        """
        settled = (F.col("n_docs") >= self.min_docs) & F.col("last_id").isNotNull()
        doomed = self.keys().where(settled)
        keys = doomed.select(F.col("h1").alias("k1"), F.col("h2").alias("k2"), "last_id")
        doomed = stored(keys, "doomed-lines")
        later = F.col("id").isNull() | (F.col("id") < F.col("last_id"))
        same = (F.col("h1") == F.col("k1")) & (F.col("h2") == F.col("k2"))
        return lines.join(doomed, same & later, "left_semi")


def dropped_lines(docs: DataFrame) -> DataFrame:
    """(id, text_hash, gone): the positions of the lines each document of (id, text) loses."""
    batch = F.pmod(F.xxhash64("id", "text_hash"), F.lit(BATCHES)).cast("int")
    lines = stored(hashed_lines(docs), "lines")
    runs = LineRuns()
    for part in range(BATCHES):
        runs.add(lines.where(batch == part))
    surplus = runs.surplus(lines)
    return surplus.groupBy("id", "text_hash").agg(F.collect_set("pos").alias("gone"))


def _with_gone(
    docs: DataFrame, id_col: str, text_col: str, text: str, gone: str
) -> DataFrame:
    """`docs` with `text` (null: empty) and `gone`, the positions of its dropped lines or null."""
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    id_, hash_ = free_names(docs, "gone_id", "gone_hash")
    dropped = dropped_lines(own).select("id", "text_hash", "gone").toDF(id_, hash_, gone)
    docs = docs.withColumn(text, F.coalesce(F.col(text_col), F.lit("")))
    same = F.col(id_col).eqNullSafe(F.col(id_)) & (F.xxhash64(text) == F.col(hash_))
    return docs.join(dropped, same, "left").drop(id_, hash_)


def _kept_text(text: str, gone: str) -> Column:
    """The runs of lines between the dropped ones, so that each line is touched once."""
    lines, at = F.split(text, "\n"), F.array_sort(gone)

    def between(parts: Column) -> Column:
        lines, at = parts["lines"], parts["at"]

        def run(k: Column) -> Column:
            begin = F.when(k == 0, 0).otherwise(F.get(at, k - 1) + 1)
            end = F.when(k == F.size(at), F.size(lines)).otherwise(F.get(at, k))
            return F.slice(lines, begin + 1, end - begin)

        return F.flatten(F.transform(F.sequence(F.lit(0), F.size(at)), run))

    # One struct in an array binds lines and positions, which are then computed once.
    bound = F.array(F.struct(lines.alias("lines"), at.alias("at")))
    kept = F.array_join(F.transform(bound, between)[0], "\n")
    return F.when(F.col(gone).isNull(), F.col(text)).otherwise(kept)


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_lines, n_dropped, kept_text) for every row of `docs`.

    Whole texts are split at line feeds; a null or empty text is one empty line. Keys
    of at least MIN_CHARS code points found in at least MIN_DOCS documents lose all
    their lines except in the largest id that holds them; a document keeps all its
    lines of a key or none. Rows that repeat id and text are one document to the
    count and all come out alike. A row with a null id counts as a document and is
    smaller than any other. Other columns are ignored; an empty table gives an empty
    one.
    """
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return _with_gone(own, "id", "text", "whole", "gone").select(
        F.col("id").alias(id_col),
        (F.length("whole") - F.length(F.replace("whole", F.lit("\n"), F.lit(""))) + 1)
        .cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"),
        _kept_text("whole", "gone").alias("kept_text"),
    )


def without_repeated_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """`docs` with its own columns and each text without the lines it loses.

    The rule is that of `dedup_lines`, for whole texts of any length. A text that loses
    nothing stays as it was, null included; a line that several ids hold stays in the
    largest, and rows that repeat id and text come out alike. Columns may have any
    names; an empty table gives an empty one.
    """
    text, gone = free_names(docs, "whole_text", "gone_lines")
    marked = _with_gone(docs, id_col, text_col, text, gone)
    changed = F.when(F.col(gone).isNull(), F.col(text_col)).otherwise(_kept_text(text, gone))
    return marked.withColumn(text_col, changed).select(*(F.col(f"`{c}`") for c in docs.columns))


#: The same rows in DuckDB SQL.
SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
l AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS line,
             unnest(range(len(string_split(t, chr(10))))) AS pos FROM d),
k AS (SELECT *, trim(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                     ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS key FROM l),
r AS (SELECT key, max(doc_id) AS last_id FROM k WHERE length(key) >= 20
      GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
m AS (SELECT k.*, r.last_id IS NOT NULL AND doc_id < r.last_id AS gone
      FROM k LEFT JOIN r ON k.key = r.key)
SELECT doc_id, count(*) AS n_lines, CAST(sum(CAST(gone AS INT)) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), ''))
         AS kept_sha256
FROM m GROUP BY doc_id
"""
