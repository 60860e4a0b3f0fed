"""Secret scans with corpus-wide ownership frequency."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterwell.llm.tables import stored

# The patterns, in the order of their kinds, and the least length of the
# group that holds the secret.
ASSIGN = (
    r"(?i:(password|passwd|secret|token|api_?key))"
    r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = "AKIA[A-Z0-9]+"
HEX = "[0-9a-f]{16,}"
# What the method looks at besides: long runs that mix cases and digits.
MIXED = "[A-Za-z0-9+/_-]{24,}"
LEAST = {"assign": 12, "access": 18, "hex": 16}
KINDS = ("assign", "access", "hex", "owned")
# A value that this many owners or repositories hold is a copied example.
COPIED = 2
# Matches of a text that are worked through together. An array grows by copying, so the
# work on a text with many matches grows with their number times this, not its square.
CHUNK = 256


# (pattern, group that holds the secret, what must hold for a match to count)
_PATTERNS = {
    "assign": (ASSIGN, 2, f"length(m.assign_w) >= {LEAST['assign']}"),
    "access": (ACCESS, 0, f"length(m.access_v) >= {LEAST['access']}"),
    "hex": (HEX, 0, "true"),
    "owned": (
        MIXED, 0,
        "m.owned_v RLIKE '[a-z]' AND m.owned_v RLIKE '[A-Z]' AND m.owned_v RLIKE '[0-9]'",
    ),
}
_SPANS = "array<struct<start:bigint,kind:int,end:bigint,secret:string>>"


def _spans(kind: str) -> str:
    """SQL for the array of (start, kind, end, secret) of the matches of a kind that count.

    A text is its matches (`v`, with the secret `w`) and the gaps `g` between them, so
    their lengths say where each match stands, in code points.
    """
    v, w, g = (f"{kind}_{x}" for x in "vwg")
    none, chunks = f"CAST(array() AS {_SPANS})", f"CAST(array() AS array<{_SPANS}>)"
    in_chunk = f"""aggregate(c, named_struct('at', o.at, 'out', {none}),
        (s, m) -> named_struct('at', s.at + m.{g} + nvl(length(m.{v}), 0), 'out',
          CASE WHEN m.{v} IS NOT NULL AND ({_PATTERNS[kind][2]}) THEN
            concat(s.out, array(named_struct('start', CAST(s.at + m.{g} AS bigint), 'kind',
              {KINDS.index(kind)}, 'end', CAST(s.at + m.{g} + length(m.{v}) AS bigint),
              'secret', m.{w}))) ELSE s.out END),
        s -> named_struct('at', s.at, 'out', concat(o.out, array(s.out))))"""
    return f"""nvl(aggregate({_chunks(f"arrays_zip({v}, {w}, {g})")},
        named_struct('at', 0L, 'out', {chunks}), (o, c) -> {in_chunk}, o -> flatten(o.out)), {none})"""


def _chunks(array: str) -> str:
    """SQL for an array cut into arrays of at most CHUNK; null stays null."""
    last = f"greatest(size({array}) - 1, 0) div {CHUNK}"
    cut = f"transform(sequence(0L, {last}), i -> slice({array}, CAST(i * {CHUNK} + 1 AS int), {CHUNK}))"
    return f"CASE WHEN {array} IS NOT NULL THEN {cut} END"


def _apart(spans: str, base: str) -> str:
    """SQL for those of `spans`, in order, that no span of `base` overlaps.

    A chunk meets only the base spans between its start and its end.
    """
    near = f"filter({base}, b -> b.start < element_at(c, -1).end AND c[0].start < b.end)"
    meets = "exists(n, b -> b.start < m.end AND m.start < b.end)"
    kept = f"transform(array({near}), n -> filter(c, m -> NOT {meets}))[0]"
    return f"""CASE WHEN size({spans}) > 0 AND size({base}) > 0 THEN
        flatten(transform({_chunks(spans)}, c -> {kept})) ELSE {spans} END"""


def with_spans(docs: DataFrame) -> DataFrame:
    """`docs` with a column of spans for each kind in place of `text`.

    Matches are only taken apart where there are any.
    """
    others = [c for c in docs.columns if c != "text"]
    text = F.col("text")
    hits = docs.select("*", *(text.rlike(p).alias(f"{k}_hit") for k, (p, _, _) in _PATTERNS.items()))
    parts = []
    for kind, (pattern, group, _) in _PATTERNS.items():
        hit, regexp = F.col(f"{kind}_hit"), F.lit(pattern)
        parts += [
            F.when(hit, F.regexp_extract_all(text, regexp, F.lit(0))).alias(f"{kind}_v"),
            F.when(hit, F.regexp_extract_all(text, regexp, F.lit(group))).alias(f"{kind}_w"),
            F.when(hit, F.transform(F.split(text, pattern), F.length)).alias(f"{kind}_g"),
        ]
    return hits.select(*others, *parts).select(
        *others, *(F.expr(_spans(kind)).alias(kind) for kind in _PATTERNS)
    )


def _named(spans: Column) -> Column:
    """Spans (start, kind, end) in order, as kind:start:end joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(
        F.transform(
            F.array_sort(spans),
            lambda s: F.concat_ws(
                ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")
            ),
        ),
        ",",
    )


def _without_secret(spans: Column) -> Column:
    fields = ("start", "kind", "end")
    return F.transform(spans, lambda s: F.struct(*(s[f].alias(f) for f in fields)))


def ownership(candidates: DataFrame) -> DataFrame:
    """(value, n_repos, n_owners): how many distinct repositories and owners hold a value.

    Repeats are merged before the shuffle, so a value in every document costs a row per
    task, repository and owner. Nulls are one repository and one owner of their own.
    """
    pairs = candidates.select("value", "repo", "owner").distinct()
    return pairs.groupBy("value").agg(
        F.count_distinct(F.coalesce("repo", F.lit("")), F.col("repo").isNull()).alias("n_repos"),
        F.count_distinct(F.coalesce("owner", F.lit("")), F.col("owner").isNull()).alias("n_owners"),
    )


def scan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    owner_col: str = "source",
    repo_cols: tuple[str, ...] = ("source", "lang"),
) -> DataFrame:
    """(id, n_assign, n_access, n_hex, base_spans, spans, n_live, n_copied) for every row.

    Base spans are the pattern matches of whole texts. The method hashes the value of
    each, and of long mixed runs that no base span overlaps, and counts over the corpus
    how many distinct repositories (here the combinations of `repo_cols`) and owners
    hold it. A value of one owner and one repository is live-looking, one held by
    COPIED or more of either is a copied example. Live mixed runs are added to `spans`
    as kind `owned`; base spans stay in any case, and `n_live` and `n_copied` tell how
    many of all candidates are which. A null text is empty; null owners count as one
    owner; repeated rows come out alike and add no owner; null ids are kept. Other
    columns are ignored; an empty table gives an empty one.
    """
    whole = docs.select(
        F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        F.col(owner_col).cast("string").alias("owner"),
        F.concat_ws("/", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in repo_cols))
        .alias("repo"),
    )
    base = F.concat("assign", "access", "hex")
    apart = F.expr(_apart("owned", "base"))
    hashed = F.transform(
        F.concat("base", apart),
        lambda s: F.struct(
            s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"),
            F.sha2(s["secret"], 256).alias("value"),
        ),
    )
    rows = with_spans(whole).withColumn("base", base).select(
        "id", "owner", "repo",
        F.size("assign").cast("long").alias("n_assign"),
        F.size("access").cast("long").alias("n_access"),
        F.size("hex").cast("long").alias("n_hex"),
        _without_secret(F.col("base")).alias("base"), hashed.alias("candidates"),
        F.monotonically_increasing_id().alias("row"),
    )
    rows = stored(rows, "spans")  # without texts; its row numbers hold from here on
    candidates = rows.select("row", "owner", "repo", F.explode("candidates").alias("c")).select(
        "row", "owner", "repo", "c.*"
    )
    owned = ownership(candidates)
    live = (F.col("n_owners") < COPIED) & (F.col("n_repos") < COPIED)
    judged = candidates.join(owned, "value").groupBy("row").agg(
        F.count_if(live).alias("live"), F.count_if(~live).alias("copied"),
        F.collect_list(
            F.when(live & (F.col("kind") == KINDS.index("owned")), F.struct("start", "kind", "end"))
        ).alias("added"),
    )
    none = F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")
    return rows.join(judged, "row", "left").select(
        F.col("id").alias(id_col), "n_assign", "n_access", "n_hex",
        _named(F.col("base")).alias("base_spans"),
        _named(F.concat("base", F.coalesce("added", none))).alias("spans"),
        F.coalesce("live", F.lit(0)).cast("long").alias("n_live"),
        F.coalesce("copied", F.lit(0)).cast("long").alias("n_copied"),
    )


def _sql_spans(kind: str, pattern: str, group: int, keep: str) -> str:
    """DuckDB SQL for the same spans of one kind, as rows (doc_id, start, kind, end, secret)."""
    quoted = pattern.replace("'", "''")
    gap_ends = "list_sum(list_transform(g[1:i], lambda x: length(x)))"
    before = "coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0)"
    return f"""
SELECT doc_id, owner, repo, {gap_ends} + {before} AS s, {KINDS.index(kind)} AS kind,
       {gap_ends} + {before} + length(m[i]) AS e, w[i] AS secret
FROM (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM (
  SELECT doc_id, owner, repo, regexp_extract_all(t, '{quoted}') AS m,
         regexp_extract_all(t, '{quoted}', {group}) AS w,
         string_split_regex(t, '{quoted}') AS g FROM d)) WHERE {keep}"""


_NAMED = "CASE kind WHEN 0 THEN 'assign' WHEN 1 THEN 'access' WHEN 2 THEN 'hex' ELSE 'owned' END"
_LISTED = f"string_agg({_NAMED} || ':' || CAST(s AS BIGINT) || ':' || CAST(e AS BIGINT), ',' ORDER BY s, kind, e)"
#: The digests of the same rows in DuckDB SQL.
SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, source AS owner,
                  coalesce(source, '') || '/' || coalesce(lang, '') AS repo FROM documents),
b AS MATERIALIZED ({_sql_spans("assign", ASSIGN, 2, "length(w[i]) >= 12")}
UNION ALL {_sql_spans("access", ACCESS, 0, "length(m[i]) >= 18")}
UNION ALL {_sql_spans("hex", HEX, 0, "true")}),
x AS MATERIALIZED ({_sql_spans("owned", MIXED, 0, "regexp_matches(m[i], '[a-z]') AND regexp_matches(m[i], '[A-Z]') AND regexp_matches(m[i], '[0-9]')")}),
c AS (SELECT * FROM b UNION ALL SELECT * FROM x WHERE NOT EXISTS (
  SELECT 1 FROM b WHERE b.doc_id = x.doc_id AND b.s < x.e AND x.s < b.e)),
o AS (SELECT secret, count(DISTINCT owner) + max(CAST(owner IS NULL AS INT)) < 2
        AND count(DISTINCT repo) < 2 AS live FROM c GROUP BY secret),
j AS (SELECT c.*, live FROM c JOIN o ON c.secret = o.secret),
r AS (SELECT doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access,
             count(*) FILTER (kind = 2) AS n_hex, {_LISTED} FILTER (kind < 3) AS base,
             {_LISTED} FILTER (kind < 3 OR live) AS spans,
             count(*) FILTER (live) AS n_live, count(*) FILTER (NOT live) AS n_copied
      FROM j GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
       coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
       coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live,
       coalesce(n_copied, 0) AS n_copied
FROM d LEFT JOIN r ON d.doc_id = r.doc_id
"""
