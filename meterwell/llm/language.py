"""Language identification by prediction by partial matching over bytes."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterwell.llm.tables import free_names, stored

# Longest context, in bytes.
ORDER = 3
# Documents per language that the statistics are taken from, about: a bound on the sample.
SAMPLE = 2_000
# Cells of the tables of all languages at most: what the driver builds and broadcasts.
MOST_CELLS = 1 << 27
UNKNOWN = "und"
# A document that every language codes in more bits a byte than this is in none of them,
# if that holds by so many bits in all that chance can't explain it.
MAX_BITS = 6.0
MARGIN = 200
# How often a string must occur to count where documents are rejected.
WITNESSES = 2
# Bytes scored at once.
_CHUNK = 1 << 19
_LETTER = regex.compile(r"\p{L}")


def held_out(id_col: Column) -> Column:
    """Whether a document is kept from learning; false for a null id."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 4 == 2, F.lit(False))


@dataclass
class Trees:
    """The context tree of each language, flattened into tables.

    Bytes seen in the sample are numbered; `n_symbols` stands for any other byte and for
    what lies before the text. `pairs` numbers the first two symbols of a context (or
    only the second, if the pair is unknown), `states[lang]` turns that and the third
    symbol into the longest context the language knows, and `bits[lang]` holds the
    exact code length of each symbol there.
    """

    langs: list[str]
    symbol: np.ndarray = field(default_factory=lambda: np.zeros(256, np.int32))
    n_symbols: int = 0
    pairs: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int32))
    states: list[np.ndarray] = field(default_factory=list)
    bits: list[np.ndarray] = field(default_factory=list)

    def code_lengths(self, texts: list[bytes]) -> np.ndarray:
        """Bits of each text under each language, whole texts in bounded steps."""
        total = np.zeros((len(texts), len(self.langs)))
        pieces: list[tuple[int, bytes, int]] = []  # text, bytes, how many are context only
        size = 0
        for i, text in enumerate(texts):
            for at in range(0, len(text), _CHUNK):
                begin = max(0, at - ORDER)
                pieces.append((i, text[begin : at + _CHUNK], at - begin))
                size += len(pieces[-1][1])
                if size >= _CHUNK:
                    self._add(pieces, total)
                    pieces, size = [], 0
        if pieces:
            self._add(pieces, total)
        return total

    def _add(self, pieces: list[tuple[int, bytes, int]], total: np.ndarray) -> None:
        width, gap = self.n_symbols + 1, b"\0" * ORDER
        raw = np.frombuffer(gap + gap.join(piece for _, piece, _ in pieces), np.uint8)
        s = self.symbol[raw]
        lengths = np.array([len(piece) for _, piece, _ in pieces])
        begins = np.cumsum(lengths + ORDER) - lengths
        for back in range(1, ORDER + 1):
            s[begins - back] = self.n_symbols
        pair = self.pairs[s[:-3] * width + s[1:-2]]
        context = pair * width + s[2:-1]
        following = s[3:]
        firsts = begins - ORDER + np.array([context_only for _, _, context_only in pieces])
        edges = np.ravel(np.column_stack([firsts, begins - ORDER + lengths]))
        owners = np.array([i for i, _, _ in pieces])
        for lang, (states, bits) in enumerate(zip(self.states, self.bits)):
            cost = bits[states[context] * width + following]
            upto = np.concatenate([[0.0], np.cumsum(cost, dtype=np.float64)])
            np.add.at(total[:, lang], owners, upto[edges[1::2]] - upto[edges[0::2]])


def _contexts(grams: np.ndarray, counts: np.ndarray, order: int, width: int):
    """Contexts of `order` symbols and their counts by next symbol, from 4-symbol strings."""
    keys = grams % width ** (order + 1)
    contexts, row = np.unique(keys // width, return_inverse=True)
    table = np.zeros((len(contexts), width))
    np.add.at(table, (row, keys % width), counts)
    return contexts, table


def _code_table(levels: list[tuple[np.ndarray, np.ndarray]], width: int) -> np.ndarray:
    """Code length in bits of every symbol in every context, shortest contexts first.

    Escapes follow method C: a context with n occurrences of d symbols gives a symbol
    count / (n + d) and the escape d / (n + d). After an escape the symbols of the
    longer context are excluded. What no context has is uniform over the bytes left.
    """
    rows = []
    for order, (contexts, table) in enumerate(levels):
        p = np.zeros_like(table)
        rest = np.ones(len(contexts))
        excluded = np.zeros_like(table, bool)
        for lower in range(order, -1, -1):
            known, counts = levels[lower]
            at = np.searchsorted(known, contexts % width**lower)
            left = np.where(excluded, 0, counts[at])
            n, d = left.sum(1), (left > 0).sum(1)
            whole = np.maximum(n + d, 1)
            p += left * (rest / whole)[:, None]
            rest = np.where(d > 0, rest * d / whole, rest)
            excluded |= counts[at] > 0
        unseen = np.maximum(256 - excluded.sum(1), 1)
        p = np.where(excluded, p, (rest / unseen)[:, None])
        rows.append(-np.log2(np.maximum(p, 1e-30)))
    return np.concatenate(rows).astype(np.float32).ravel()


def grow(counts: pd.DataFrame, langs: Iterable[str] | None = None) -> Trees:
    """Trees from (lang, gram, n): how often each big-endian four-byte string occurs.

    `langs` names languages that are learned even without such a string; theirs code
    every byte in eight bits. Tables over MOST_CELLS are refused.
    """
    trees = Trees(sorted(counts["lang"].unique() if langs is None else set(langs)))
    grams = counts["gram"].to_numpy(np.int64)
    parts = [(grams >> shift) & 255 for shift in (24, 16, 8, 0)]
    seen = np.unique(np.concatenate(parts)) if len(grams) else np.array([], np.int64)
    trees.n_symbols, width = len(seen), len(seen) + 1
    trees.symbol = np.full(256, trees.n_symbols, np.int64)
    trees.symbol[seen] = np.arange(len(seen))
    a, b, c, d = (trees.symbol[p] for p in parts)
    coded = ((a * width + b) * width + c) * width + d
    known = np.unique(a * width + b)
    trees.pairs = np.tile(len(known) + np.arange(width), width)  # the second symbol alone
    trees.pairs[known] = np.arange(len(known))
    for lang in trees.langs:
        own = (counts["lang"] == lang).to_numpy()
        weights = counts["n"].to_numpy(np.float64)[own]
        levels = [_contexts(coded[own], weights, order, width) for order in range(ORDER + 1)]
        if not len(weights):
            levels[0] = (np.zeros(1, np.int64), np.zeros((1, width)))
        trees.bits.append(_code_table(levels, width))
        firsts = np.cumsum([0] + [len(contexts) for contexts, _ in levels])
        second = np.concatenate([known % width, np.arange(width)])
        states = np.zeros((len(second), width), np.int32)
        third = np.arange(width)[None, :]
        full = np.concatenate([known, np.full(width, -1)])[:, None]
        for order, key in (
            (1, np.broadcast_to(third, states.shape)),
            (2, second[:, None] * width + third),
            (3, np.where(full >= 0, full * width + third, -1)),
        ):
            contexts = levels[order][0]
            if not len(contexts):
                continue
            at = np.minimum(np.searchsorted(contexts, key), len(contexts) - 1)
            states = np.where(contexts[at] == key, firsts[order] + at, states)
        trees.states.append(states.astype(np.int64).ravel())
        cells = sum(len(table) for table in (*trees.bits, *trees.states))
        if cells > MOST_CELLS:
            raise ValueError(f"{cells} cells for {len(trees.bits)} of {len(trees.langs)} languages")
    return trees


def learn(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    sample: int = SAMPLE, least: int = 1,
) -> Trees:
    """Context trees from whole texts of documents that are not held out and have a language.

    About `sample` documents of each language are read, chosen by a hash of id and text,
    so that rows which repeat an id are drawn by their texts. Strings of the sample count
    that occur `least` times in a language, all of them by default. Strings are counted in the tasks and summed by Spark; the driver gets a row for
    each language and the sums, which grow with the sample and not with the table.
    """
    labelled = docs.where(F.col(id_col).isNotNull() & ~held_out(F.col(id_col))).select(
        F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text")
    )
    labelled = labelled.where("lang IS NOT NULL AND text IS NOT NULL")
    sizes = labelled.groupBy("lang").count().collect()  # one row per language
    place = F.pmod(F.xxhash64("id", "text"), F.lit(1 << 30)) / (1 << 30)
    shares = F.create_map(*(F.lit(x) for lang, n in sizes for x in (lang, min(1.0, sample / n))))
    chosen = labelled.where(place < shares[F.col("lang")]) if sizes else labelled

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 500):
                for lang, own in batch.iloc[at : at + 500].groupby("lang"):
                    found = []
                    for text in own["text"]:
                        raw = np.frombuffer(text.encode("utf-8"), np.uint8).astype(np.int64)
                        found.append(
                            raw[:-3] << 24 | raw[1:-2] << 16 | raw[2:-1] << 8 | raw[3:]
                            if len(raw) > ORDER
                            else np.array([], np.int64)
                        )
                    grams, n = np.unique(np.concatenate(found), return_counts=True)
                    yield pd.DataFrame({"lang": lang, "gram": grams, "n": n})

    counted = chosen.select("lang", "text").mapInPandas(count, "lang string, gram long, n long")
    summed = counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    return grow(summed.where(F.col("n") >= least).toPandas(), [lang for lang, _ in sizes])


def predict(
    docs: DataFrame, trees: Trees, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, lang_pred, score, bits, n_bytes) for every row: the language that codes the text shortest.

    `score` is the probability of that language, all being equally likely before;
    `bits` is its code length a byte and `n_bytes` what it counts. A text that is null or
    has no letter is `und` with score 0 and null bits, and so is every text if nothing
    was learned.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vars(trees))
    own = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"))

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = Trees(**shared.value)
        for batch in batches:
            for at in range(0, len(batch), 1000):
                yield _scored(batch.iloc[at : at + 1000], model)

    found = own.mapInPandas(
        score, "id string, lang_pred string, score double, bits double, n_bytes long"
    )
    return found.select(
        F.col("id").cast(docs.schema[id_col].dataType).alias(id_col), *found.columns[1:]
    )


def _scored(batch: pd.DataFrame, trees: Trees) -> pd.DataFrame:
    texts = [
        t.encode("utf-8") if t is not None and trees.langs and _LETTER.search(t) else b""
        for t in batch["text"]
    ]
    sizes = np.array([len(t) for t in texts])
    out = pd.DataFrame({"id": batch["id"], "lang_pred": UNKNOWN, "score": 0.0, "bits": np.nan})
    out["n_bytes"] = sizes.astype(np.int64)
    if sizes.any():
        bits = trees.code_lengths(texts)
        best = bits.argmin(1)
        shortest = bits[np.arange(len(texts)), best]
        some = sizes > 0
        chance = 1 / np.exp2(np.maximum(shortest[:, None] - bits, -1000)).sum(1)
        out["lang_pred"] = np.where(some, np.array(trees.langs, object)[best], UNKNOWN)
        out["score"] = np.where(some, chance, 0.0)
        out["bits"] = np.where(some, shortest / np.maximum(sizes, 1), np.nan)
    out["bits"] = out["bits"].astype(object).where(out["bits"].notna(), None)
    return out[["id", "lang_pred", "score", "bits", "n_bytes"]]


def identify(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"
) -> DataFrame:
    """(id, held_out, lang_pred, score, bits) for every row of `docs`.

    Statistics are learned from `lang` of the documents that are not held out and then
    frozen; no other column enters a prediction. Whole texts are coded, long ones in
    steps; of equal code lengths the first language by name wins. Rows that repeat come
    out alike; a null id is not held out and not learned from; other columns are ignored;
    an empty table gives an empty one.
    """
    trees = learn(docs, id_col, text_col, lang_col)
    found = predict(docs, trees, id_col, text_col)
    return found.select(
        id_col, held_out(F.col(id_col)).alias("held_out"), "lang_pred", "score", "bits"
    )


def in_some_language(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"
) -> DataFrame:
    """`docs` with its own columns, without what is in none of the languages learned.

    A document goes if it is null, has no letter, or codes in more than MAX_BITS bits a
    byte under every language, by MARGIN bits in all. Only strings seen WITNESSES times
    count here, because a string seen once may be the judged text's own and would speak
    for it. With nothing learned only the first two go. Each row is judged by its own
    whole text, whatever its id, null included, so rows that repeat stay or go together.
    Columns may have any names; an empty table gives an empty one.
    """
    text, id_ = F.col(text_col), F.col(id_col).cast("string")
    # Id and 128 hash bits of the text; a null id is left out of the key.
    key = F.concat_ws("/", id_, F.xxhash64(text), F.xxhash64(text, F.lit(1)))
    own, other = free_names(docs, "text_key", "other_key")
    keyed = docs.withColumn(own, key)
    trees = learn(docs, id_col, text_col, lang_col, least=WITNESSES)
    found = predict(keyed, trees, own, text_col)
    foreign = found.where((F.col("bits") - MAX_BITS) * F.col("n_bytes") > MARGIN)
    gone = stored(foreign.select(F.col(own).alias(other)).distinct(), "other-languages")
    lettered = keyed.where(text.rlike(r"\p{L}"))
    return lettered.join(gone, F.col(own) == F.col(other), "left_anti").drop(own)
