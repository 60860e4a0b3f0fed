"""Substring dedup: recurring passages found by sharded Aho-Corasick automata."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from itertools import chain, repeat

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterwell.llm.tables import stored
from meterwell.llm.words import groups_of, hashed_texts, mixed, string_hashes

# Words in a window, and in a phrase that stands for the windows around it.
WINDOW = 50
PHRASE = 16
# Text dealt to one task, phrases in one automaton.
BLOCK_CHARS = 8 << 20
SHARD = 40_000
_CHUNK = 1 << 20


def _sliding(values: np.ndarray, n: int, pick) -> np.ndarray:
    """`pick` (np.minimum or np.maximum) over every `n` consecutive values."""
    width, out = 1, values
    while width * 2 <= n:
        out = pick(out[: len(out) - width], out[width:])
        width *= 2
    rest = n - width
    return pick(out[: len(out) - rest], out[rest:]) if rest else out


def anchors(hashes: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document, position) of the phrases that stand for each window: winnowing.

    In every window of WINDOW words the phrase with the smallest hash is chosen, from the
    window's words alone: equal windows choose equal phrases, wherever they stand.
    `hashes` are the words of all documents in a row, `ends` where each begins and ends.
    """
    empty = np.zeros(0, np.int64)
    if len(hashes) < WINDOW:
        return empty, empty
    phrases = string_hashes(hashes, PHRASE)
    span = WINDOW - PHRASE + 1
    least = _sliding(phrases, span, np.minimum)
    owner = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
    inside = owner[: len(hashes) - WINDOW + 1] == owner[WINDOW - 1 :]
    least = np.where(inside, least, 0)
    padded = np.concatenate([np.zeros(span - 1, np.uint64), least, np.zeros(span - 1, np.uint64)])
    chosen = phrases == _sliding(padded, span, np.maximum)
    at = np.flatnonzero(chosen & (phrases > 0))
    return owner[at], at


def _anchor_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(phrase, id, row, pos) once for each document and phrase."""
    for batch in batches:
        for some in groups_of(list(batch["text"]), _CHUNK):
            part = batch.iloc[some]
            hashes, ends = hashed_texts([(t or "").encode("utf-8") for t in part["text"]])
            owner, at = anchors(hashes, ends)
            if not len(at):
                continue
            phrase = string_hashes(hashes, PHRASE)[at].astype(np.int64)
            order = np.lexsort((at, phrase, owner))
            owner, at, phrase = owner[order], at[order], phrase[order]
            new = np.r_[True, (owner[1:] != owner[:-1]) | (phrase[1:] != phrase[:-1])]
            owner, at, phrase = owner[new], at[new], phrase[new]
            yield pd.DataFrame(
                {"phrase": phrase, "id": part["id"].to_numpy()[owner],
                 "row": part["row"].to_numpy()[owner], "pos": at - ends[owner]}
            )


class Automata:
    """Aho-Corasick automata over phrases of whole words, SHARD phrases each.

    Within a shard each word of a phrase is two characters, its upper and its lower
    digit, from alphabets of their own, and any other word is another two. So an
    automaton has at most two nodes a word and finds words, not parts. A node looks its
    edges through one by one: digits leave it few, where a character a word would
    give the root an edge for each first word of a phrase.
    """

    def __init__(self, phrases: list[tuple[bytes, ...]]):
        self.shards = []
        for at in range(0, len(phrases), SHARD):
            some = phrases[at : at + SHARD]
            words = dict.fromkeys(chain.from_iterable(some))
            base = math.isqrt(len(words)) + 1
            upper, lower = ([chr(first + i) for i in range(base)] for first in (1, 1 + base))
            letters = {w: upper[n // base] + lower[n % base] for n, w in enumerate(words)}
            automaton = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
            for phrase in some:
                automaton.add_word("".join(map(letters.__getitem__, phrase)))
            automaton.make_automaton()
            # No phrase reaches over a word that none of them has.
            runs = re.compile("[^\0]{%d,}" % (2 * min(map(len, some))))
            self.shards.append((letters, runs, automaton))

    def occurrences(self, words: list[bytes]) -> Iterator[tuple[int, int]]:
        """(first word, number of words) of every occurrence of every phrase."""
        for letters, runs, automaton in self.shards:
            text = "".join(map(letters.get, words, repeat("\0\0")))
            for run in runs.finditer(text):
                after = run.start() + 1
                for last, length in automaton.iter(run.group()):
                    yield (last + after - length) // 2, length // 2


def _candidates(docs: pd.DataFrame, phrases: pd.DataFrame) -> pd.DataFrame:
    """Windows of one block that hold a recurring phrase, with what the block can decide.

    Rows (h1, h2, id, row, span): a window by its hash, with its start in the upper half
    of `span`. Where the lower half isn't 0 it is the length of a run of windows that a
    smaller id of this very block holds too.
    """
    columns = ["h1", "h2", "id", "row", "span"]
    docs = docs.drop_duplicates("row")
    texts = dict(zip(docs["row"], (t.encode("utf-8") for t in docs["text"])))
    words = {row: texts[row].split() for row in set(phrases["row"])}
    found = list(
        {tuple(words[row][pos : pos + PHRASE]) for row, pos in zip(phrases["row"], phrases["pos"])}
    )
    del words
    if not found or not len(docs):
        return pd.DataFrame([], columns=columns)
    automata = Automata(found)
    parts = []
    for some in groups_of(list(docs["text"]), _CHUNK):
        part = docs.iloc[some]
        raws = [texts[row] for row in part["row"]]
        hashes, ends = hashed_texts(raws)
        if len(hashes) < WINDOW:
            continue
        edges = np.zeros(len(hashes) + 1, np.int32)
        for begin, end, raw in zip(ends[:-1].tolist(), ends[1:].tolist(), raws):
            if end - begin < WINDOW:
                continue
            for first, length in automata.occurrences(raw.split()):
                edges[max(begin, begin + first + length - WINDOW)] += 1
                edges[min(begin + first, end - WINDOW) + 1] -= 1
        at = np.flatnonzero(np.cumsum(edges[:-1]) > 0)
        owner = np.searchsorted(ends, at, "right") - 1
        h1 = string_hashes(hashes, WINDOW)[at]
        h2 = string_hashes(mixed(hashes), WINDOW)[at]
        parts.append(
            pd.DataFrame(
                {"h1": h1.view(np.int64), "h2": (h2 >> np.uint64(33)).astype(np.int32),
                 "id": part["id"].to_numpy()[owner], "row": part["row"].to_numpy()[owner],
                 "start": at - ends[owner]}
            )
        )
    if not parts:
        return pd.DataFrame([], columns=columns)
    windows = pd.concat(parts, ignore_index=True)
    least = windows.groupby(["h1", "h2"], sort=False)["id"].transform("min")
    local = windows[windows["id"] > least].sort_values(["row", "start"])
    open_ = windows[windows["id"] <= least]
    open_ = open_.assign(span=open_["start"].to_numpy() << 32)
    new = np.r_[True, (np.diff(local["row"]) != 0) | (np.diff(local["start"]) != 1)][: len(local)]
    runs = local[new]
    lengths = np.diff(np.append(np.flatnonzero(new), len(local)))
    runs = runs.assign(span=(runs["start"].to_numpy() << 32) + lengths)
    # A run needs no partner: its own place keeps it apart from every window.
    place = runs["row"].to_numpy(np.int64) ^ runs["span"].to_numpy(np.int64)
    runs["h1"] = mixed(place.view(np.uint64)).view(np.int64)
    runs["h2"] = np.int32(-1)
    return pd.concat([open_, runs], ignore_index=True)[columns]


def _kept(docs: pd.DataFrame, gone: pd.DataFrame) -> pd.DataFrame:
    """Every document of one block without the words of its `gone` windows."""
    by_row = {row: own for row, own in gone.groupby("row")}
    out = []
    for id_, row, text in zip(docs["id"], docs["row"], docs["text"]):
        words = (text or "").encode("utf-8").split()
        own = by_row.get(row)
        n = len(words)
        if own is not None:
            edges = np.zeros(n + 1, np.int64)
            first, run = own["span"].to_numpy() >> 32, own["span"].to_numpy() & 0xFFFFFFFF
            np.add.at(edges, first, 1)
            np.add.at(edges, first + np.maximum(run, 1) - 1 + WINDOW, -1)
            keep = np.cumsum(edges[:-1]) == 0
            words = [words[i] for i in np.flatnonzero(keep).tolist()]
        out.append((id_, n, n - len(words), b" ".join(words).decode("utf-8")))
    return pd.DataFrame(out, columns=["id", "n_words", "n_removed", "kept_text"])


def remove_repeated_passages(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, n_words, n_removed, kept_text) for every row of `docs`; ids are whole numbers.

    A word goes if it lies in WINDOW consecutive words that also start in a document
    with a smaller id; kept words are joined by one space. Whole texts count, and
    windows are judged on the input. Rows that repeat an id never take words from each
    other. A null text has no words; a row with a null id keeps all its words and takes
    none. Other columns are ignored; an empty table gives an empty one.

    Documents are dealt into blocks of text. Phrases chosen from every window are
    counted over all documents; those that recur are confirmed and compiled, for each
    block that holds some, into automata, and every document of the block is streamed
    through them. Only windows around what they find are compared over all blocks, one
    row for each block that holds a window, so a passage in a third of all documents
    meets as often as there are blocks, and the comparison streams over sorted rows.
    """
    whole = F.coalesce(F.col(text_col), F.lit(""))
    own = docs.select(F.col(id_col).cast("string").alias("id"), whole.alias("text"))
    chars = own.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = int(chars // BLOCK_CHARS) + 1
    row = F.xxhash64("id", "text")
    own = own.select("id", "text", row.alias("row"), F.pmod(row, F.lit(blocks)).cast("int").alias("block"))
    numbered = own.where("id IS NOT NULL").select(F.col("id").cast("long").alias("id"), "text", "row")
    phrases = stored(
        numbered.mapInPandas(_anchor_rows, "phrase long, id long, row long, pos int"), "phrases"
    )
    recurring = phrases.groupBy("phrase").agg(F.min("id").alias("a"), F.max("id").alias("b"))
    recurring = recurring.where("a < b").select("phrase")
    block = F.pmod("row", F.lit(blocks)).cast("int").alias("block")
    compiled = (
        phrases.join(recurring, "phrase")
        .groupBy(block, "phrase")
        .agg(F.min(F.struct("row", "pos")).alias("at"))
        .select("block", "at.row", "at.pos")
    )
    texts = own.groupBy("block")

    def locate(part: pd.DataFrame, own_phrases: pd.DataFrame) -> pd.DataFrame:
        part = part[part["id"].notna()]
        return _candidates(part.assign(id=part["id"].astype("int64")), own_phrases)

    windows = texts.cogroup(compiled.groupBy("block")).applyInPandas(
        locate, "h1 long, h2 int, id long, row long, span long"
    )
    smallest = F.min("id").over(Window.partitionBy("h1", "h2"))
    gone = windows.withColumn("least", smallest).where("h2 = -1 OR id > least")
    gone = gone.select(block, "row", "span")
    kept = texts.cogroup(gone.groupBy("block")).applyInPandas(
        _kept, "id string, n_words long, n_removed long, kept_text string"
    )
    return kept.select(
        F.col("id").cast(docs.schema[id_col].dataType).alias(id_col), *kept.columns[1:]
    )


#: The digests of the same rows in DuckDB SQL.
SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
           FROM documents),
s AS (SELECT doc_id, start, md5(array_to_string(w[start:start + 49], ' ')) AS h
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS start FROM d WHERE len(w) >= 50)),
m AS (SELECT *, min(doc_id) OVER (PARTITION BY h) AS least FROM s),
g AS (SELECT DISTINCT doc_id, start + k AS pos
      FROM (SELECT doc_id, start FROM m WHERE doc_id > least), (SELECT unnest(range(50)) AS k)),
l AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS pos FROM d),
k AS (SELECT l.doc_id, string_agg(word, ' ' ORDER BY l.pos) AS kept, count(*) AS n
      FROM l ANTI JOIN g ON l.doc_id = g.doc_id AND l.pos = g.pos GROUP BY l.doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT)
         AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k ON d.doc_id = k.doc_id
"""
