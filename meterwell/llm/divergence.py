"""How far sources differ in their words: divergences over a three-dimensional cube of cells."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterwell.llm.tables import stored

# A term is kept in a language where so many of its documents hold it.
MIN_DOCS = 3
# Probabilities are whole numbers, 1 + floor(UNIT * share).
UNIT = 1_000_000_000
TOP_TERMS = 200
# Sides of a cell: groups on each of two axes, counts of terms (zeros aside) on the third.
GROUPS = 64
ENTRIES = 1 << 18
# Terms in one step of a cell.
_STEP = 1 << 12
# Different terms a task remembers before it gives out what it counted.
REMEMBERED = 400_000
# Bytes of a text that are cut into words at once.
_SLICE = 1 << 20

# Letters and all bytes of other characters than ASCII make terms; A-Z are lower-cased.
_FOLD = bytes(
    b if b >= 0x80 or chr(b).islower() else b + 32 if chr(b).isupper() else 0x20 for b in range(256)
)

_COUNTS = "lang string, source string, term string, n long, docs long"
_CELLS = "lang string, g int, other int, value long"


def words_of(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text in order, in lists of bounded size."""
    folded, at = text.translate(_FOLD), 0
    while at < len(folded):
        end = folded.find(b" ", at + _SLICE)
        end = len(folded) if end < 0 else end
        yield folded[at:end].split()
        at = end


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents of each (lang, source, term), summed within the task.

    A row without a term stands for the group itself, so that none is lost.
    """
    counts: dict[tuple[str, str], tuple[Counter, Counter]] = {}

    def held() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs) in counts.items():
            terms = [None, *n]
            yield pa.record_batch(
                [
                    pa.array([lang] * len(terms), pa.string()),
                    pa.array([source] * len(terms), pa.string()),
                    pa.array(terms, pa.binary()).cast(pa.string()),
                    pa.array([0, *n.values()], pa.int64()),
                    pa.array([0, *(docs[t] for t in n)], pa.int64()),
                ],
                ["lang", "source", "term", "n", "docs"],
            )
        counts.clear()

    new = 0
    for batch in batches:
        for lang, source, text in zip(*(c.to_pylist() for c in batch.columns)):
            n, docs = counts.setdefault((lang, source), (Counter(), Counter()))
            before, seen = len(n), set()
            for words in words_of(text):
                n.update(words)
                seen.update(words)
            docs.update(seen)
            new += len(n) - before
            if new >= REMEMBERED:
                yield from held()
                new = 0
    yield from held()


def term_counts(
    docs: DataFrame, text_col: str, lang_col: str, source_col: str, min_docs: int = MIN_DOCS
) -> DataFrame:
    """(lang, source, term, n, total, first) of kept terms, and each group once without a term.

    `total` counts the term in the language; `first` marks one row of each term.
    """

    def read(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(""))

    own = docs.select(
        read(lang_col).alias("lang"),
        read(source_col).alias("source"),
        read(text_col).cast("binary").alias("text"),
    )
    counted = own.mapInArrow(_count, _COUNTS)
    # Dealt by term once: the sum per group and the sums per language need no other shuffle.
    dealt = counted.repartition("lang", "term")
    groups = dealt.groupBy("lang", "term", "source").agg(
        F.sum("n").alias("n"), F.sum("docs").alias("docs")
    )
    term = Window.partitionBy("lang", "term")
    ordered = term.orderBy("source")
    return (
        groups.withColumn("total", F.sum("n").over(term))
        .withColumn("in_docs", F.sum("docs").over(term))
        .withColumn("first", F.row_number().over(ordered) == 1)
        .where(F.col("term").isNull() | (F.col("in_docs") >= min_docs))
        .select("lang", "source", "term", "n", "total", "first")
    )


def _groups(counts: DataFrame) -> DataFrame:
    """Every group with its number `g` and, of its language, the number of groups, counts and terms."""
    of_lang = Window.partitionBy("lang")
    groups = counts.groupBy("lang", "source").agg(
        F.sum("n").alias("n_group"),
        F.count("term").alias("own_counts"),
        F.count_if(F.col("first") & F.col("term").isNotNull()).alias("own_terms"),
    )
    return groups.select(
        "lang",
        "source",
        "n_group",
        (F.row_number().over(of_lang.orderBy("source")) - 1).cast("int").alias("g"),
        F.count(F.lit(1)).over(of_lang).cast("int").alias("groups"),
        F.sum("n_group").over(of_lang).alias("n_lang"),
        F.sum("own_counts").over(of_lang).alias("counts"),
        F.sum("own_terms").over(of_lang).alias("terms"),
    )


def _share(n: str, of: str) -> Column:
    """1 + floor(UNIT * (n + 1) / (of + terms)), exact for counts of any size."""
    return F.expr(
        f"1 + CAST({UNIT} AS DECIMAL(10, 0)) * CAST({n} + 1 AS DECIMAL(19, 0))"
        f" div CAST({of} + terms AS DECIMAL(19, 0))"
    )


def _shares(counts: np.ndarray, of: np.ndarray) -> np.ndarray:
    """The same for a matrix of counts and a divisor for each row, by long division."""
    rest, found = counts + 1, np.zeros_like(counts)
    of = of[:, None]
    for _ in range(3):
        rest = rest * 1000
        digit = rest // of
        rest -= digit * of
        found = found * 1000 + digit
    return found + 1


def _cell(key: tuple, entries: pd.DataFrame, members: pd.DataFrame) -> pd.DataFrame:
    """The divergences of one cell: two blocks of groups over one block of terms.

    `entries` are counts (g, t, n) of both blocks, `members` all groups of both with
    their divisors. Only _STEP terms are spread out at a time.
    """
    lang, gi, gj, _ = key
    terms = int(members["terms_here"].iloc[0])
    sides = []
    for block in (gi, gj) if gi != gj else (gi,):
        own = members[members["block"] == block].sort_values("g")
        part = entries[entries["block"] == block].sort_values("t")
        numbers = own["g"].to_numpy()
        row = np.searchsorted(numbers, part["g"].to_numpy())
        sides.append((numbers, own["of"].to_numpy(), row, part["t"].to_numpy(), part["n"].to_numpy()))
    a, b = sides[0][0], sides[-1][0]
    there, back = (np.zeros((len(a), len(b)), np.int64) for _ in range(2))
    for begin in range(0, terms, _STEP):
        width = min(_STEP, terms - begin)
        shares = []
        for numbers, of, row, t, n in sides:
            here = slice(*np.searchsorted(t, [begin, begin + width]))
            counts = np.zeros((len(numbers), width), np.int64)
            counts[row[here], t[here] - begin] = n[here]
            shares.append(_shares(counts, of))
        p, q = shares[0], shares[-1]
        for i in range(len(a)):
            away = (p[i] - q) ** 2
            there[i] += (away // q).sum(1)
            if gi != gj:
                back[i] += (away // p[i]).sum(1)
    g, other = np.repeat(a, len(b)), np.tile(b, len(a))
    found = pd.DataFrame({"lang": lang, "g": g, "other": other, "value": there.ravel()})
    if gi != gj:
        found = pd.concat(
            [found, pd.DataFrame({"lang": lang, "g": other, "other": g, "value": back.ravel()})]
        )
    return found[found["g"] != found["other"]]


def _replicated(slices: DataFrame) -> DataFrame:
    """Each row of a block of groups in every cell (gi, gj, terms) with gi <= gj that needs it."""
    as_row = slices.withColumn("gi", F.col("block")).withColumn(
        "gj", F.explode(F.sequence("block", F.col("blocks") - 1))
    )
    as_column = slices.where("block > 0").withColumn("gj", F.col("block"))
    as_column = as_column.withColumn("gi", F.explode(F.sequence(F.lit(0), F.col("block") - 1)))
    return as_row.unionByName(as_column)


def pair_divergences(
    counts: DataFrame, groups: DataFrame, side: int = GROUPS, entries: int = ENTRIES
) -> DataFrame:
    """(lang, g, other, value): the divergence of each ordered pair of groups of a language.

    Cells are cut on three axes: `side` groups, `side` groups, and blocks of terms
    that hold about `entries` counts. Every slice of counts goes to the cells that need
    it, a cell adds up its own terms for its pairs, and cells are reduced along the
    term axis. A cell sees all its groups, so a count of zero needs no row.
    """
    placed = groups.withColumn("block", F.floor(F.col("g") / side).cast("int")).withColumn(
        "blocks", F.ceil(F.col("groups") / side).cast("int")
    )
    of_group = placed.select("lang", "source", "g", "block", "blocks", "counts")
    sized = counts.where("term IS NOT NULL").join(of_group, ["lang", "source"])
    tb = F.pmod(F.xxhash64("term"), F.ceil(F.col("counts") / F.lit(entries))).cast("int")
    sized = sized.withColumn("tb", tb)
    in_block = Window.partitionBy("lang", "tb").orderBy("term")
    numbered = sized.withColumn("t", (F.dense_rank().over(in_block) - 1).cast("int"))
    slices = numbered.select("lang", "tb", "block", "blocks", "g", "t", "n")
    slices = stored(slices, "slices")
    here = slices.groupBy("lang", "tb").agg((F.max("t") + 1).alias("terms_here"))
    members = placed.join(here, "lang").select(
        "lang", "tb", "terms_here", "block", "blocks", "g",
        (F.col("n_group") + F.col("terms")).alias("of"),
    )
    cell = ["lang", "gi", "gj", "tb"]
    # Columns of their own, as both sides come from the same tables.
    members = _replicated(members.toDF(*members.columns))
    partial = (
        _replicated(slices).groupBy(*cell).cogroup(members.groupBy(*cell))
    ).applyInPandas(_cell, _CELLS)
    return partial.groupBy("lang", "g", "other").agg(F.sum("value").alias("value"))


def typical_terms(counts: DataFrame, groups: DataFrame, top: int = TOP_TERMS) -> DataFrame:
    """(lang, source, item, value, rank): the terms by which a group exceeds its language most."""
    kept = counts.where("term IS NOT NULL AND n > 0").join(groups, ["lang", "source"])
    shares = kept.select(
        "lang", "source", F.col("term").alias("item"),
        _share("n", "n_group").alias("p"), _share("total", "n_lang").alias("q"),
    ).where("p > q")
    valued = shares.select("lang", "source", "item", F.expr("(p - q) * (p - q) div q").alias("value"))
    return _ranked(valued).where(F.col("rank") <= top)


def _ranked(valued: DataFrame) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return valued.withColumn("rank", F.row_number().over(order))


def audit(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    side: int = GROUPS,
    entries: int = ENTRIES,
) -> DataFrame:
    """(lang, source, part, item, value, rank): how each source differs from others of its language.

    Part `pair` has each other source of the language with the divergence from it,
    part `term` the first TOP_TERMS terms by which the source exceeds its language.
    Shares and divergences are exact integers. Null text, language and source read as
    empty; every row is a document, so repeated rows count as often as they come;
    whole texts count, cut into words slice by slice. A group without terms is
    compared like any other, and a language without kept terms gives zeros. Equal
    values are ranked by item. Other columns are ignored, whatever their names; an
    empty table gives an empty one.

    Counts are summed in each task before they are shuffled, so that a source or word
    with a third of all text costs a row a task.
    """
    counts = stored(term_counts(docs, text_col, lang_col, source_col), "counts")
    groups = stored(_groups(counts), "groups")
    others = groups.select("lang", F.col("source").alias("item"), F.col("g").alias("other"))
    pairs = groups.select("lang", "source", "g").join(others, "lang").where("g != other")
    values = pair_divergences(counts, groups, side, entries)
    pairs = pairs.join(values, ["lang", "g", "other"], "left").select(
        "lang", "source", "item", F.coalesce("value", F.lit(0)).cast("long").alias("value")
    )
    columns = ["lang", "source", "part", "item", "value", "rank"]
    parts = {"pair": _ranked(pairs), "term": typical_terms(counts, groups)}
    each = [rows.withColumn("part", F.lit(part)).select(columns) for part, rows in parts.items()]
    return each[0].unionByName(each[1])


#: The same rows in DuckDB SQL.
SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
             regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                          'abcdefghijklmnopqrstuvwxyz'),
                                '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
w AS MATERIALIZED (SELECT r, lang, source, unnest(terms) AS term FROM d),
k AS MATERIALIZED (SELECT lang, term FROM w GROUP BY lang, term HAVING count(DISTINCT r) >= 3),
c AS MATERIALIZED (SELECT lang, source, term, count(*) AS n FROM w JOIN k USING (lang, term)
                   GROUP BY lang, source, term),
v AS (SELECT lang, count(*) AS v FROM k GROUP BY lang),
g AS MATERIALIZED (
  SELECT lang, source, coalesce(any_value(v.v), 0) AS v, coalesce(sum(c.n), 0) AS n
  FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN v USING (lang) LEFT JOIN c USING (lang, source)
  GROUP BY lang, source),
p AS MATERIALIZED (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
         1 + CAST(1000000000 AS HUGEINT) * (coalesce(c.n, 0) + 1) // (g.n + g.v) AS p
  FROM g JOIN k ON g.lang = k.lang
  LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
l AS (SELECT lang, term, 1 + CAST(1000000000 AS HUGEINT) * (t + 1) // (sum(t) OVER (PARTITION BY lang)
               + count(*) OVER (PARTITION BY lang)) AS q
      FROM (SELECT lang, term, sum(n) AS t FROM c GROUP BY lang, term)),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY a.lang, a.source, b.source),
terms AS (
  SELECT p.lang, p.source, p.term AS item, (p.p - l.q) * (p.p - l.q) // l.q AS value
  FROM p JOIN l USING (lang, term) WHERE p.n > 0 AND p.p > l.q),
every AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(x.value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
  UNION ALL SELECT lang, source, 'term', item, value FROM terms)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INT) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
      FROM every)
WHERE part = 'pair' OR rank <= 200
"""
