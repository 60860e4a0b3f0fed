"""Divergence audit, exact dedup and centroid clustering against plain versions."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from meterwell.llm import clustering, divergence, exact

BLANK = re.compile(r"[\x20\x09-\x0D]+")
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = {c: c + 32 for c in range(65, 91)}


# --- exact dedup


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("ab \t\n\x0b\x0c\r\x1c\x85é "), max_size=12))
def test_normalised_equals_the_pattern(text):
    assert exact.normalised(text.encode()) == BLANK.sub(" ", text).encode()


def plain_duplicates(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[BLANK.sub(" ", text or "")].append(doc_id)
    found = []
    for text, ids in groups.items():
        ids.sort(key=lambda i: (i is None, i))
        sha = hashlib.sha256(text.encode()).hexdigest()
        found += [(i, ids[0], len(ids), n == 0, sha) for n, i in enumerate(ids)]
    return sorted(found, key=repr)


def check_duplicates(df, **how):
    found = exact.exact_duplicates(df, **how)
    assert found.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    rows = [tuple(r) for r in df.select("doc_id", "text").collect()]
    assert sorted((tuple(r) for r in found.collect()), key=repr) == plain_duplicates(rows)


def test_exact_duplicates(documents, odd_documents, no_documents):
    check_duplicates(documents)
    check_duplicates(odd_documents)
    check_duplicates(odd_documents, range_bytes=1_000)
    assert exact.exact_duplicates(no_documents).count() == 0


def test_text_over_many_ranges(spark, documents, monkeypatch):
    """A third of the rows alike, one id on many of them, cut by splitters and by segments."""
    monkeypatch.setattr(exact, "SEGMENT", 7)
    alike = spark.range(0, 60).select(
        F.when(F.col("id") < 20, 900).otherwise(F.col("id") + 1_000).alias("doc_id"),
        F.lit("the  same text").alias("text"),
    )
    rows = documents.select("doc_id", "text").union(alike)
    cuts = exact.splitters(rows.select("doc_id", F.col("text").cast("binary")), 20_000)
    assert len(cuts) >= 5 and cuts == sorted(cuts)
    check_duplicates(rows, range_bytes=20_000)
    only = alike.withColumn("text", F.repeat(F.lit("a b  c "), 200))
    assert len({key[:2] for key in exact.splitters(only.select("doc_id", F.col("text").cast("binary")), 9_000)}) == 1
    check_duplicates(only, range_bytes=9_000)


def test_ids_of_other_types(documents):
    named = documents.withColumn("doc_id", F.concat(F.lit("d"), "doc_id"))
    check_duplicates(named)


# --- divergence audit


def plain_audit(rows, top=200):
    docs = [
        (lang or "", source or "", TERM.findall((text or "").translate(UPPER)))
        for text, lang, source in rows
    ]
    found = []
    for lang in {d[0] for d in docs}:
        own = [(s, t) for lg, s, t in docs if lg == lang]
        in_docs = Counter(t for _, terms in own for t in set(terms))
        kept = sorted(t for t, n in in_docs.items() if n >= 3)
        v = len(kept)
        keep = set(kept)
        counts = {s: Counter() for s, _ in own}
        for s, terms in own:
            counts[s].update(t for t in terms if t in keep)
        total = sum(counts.values(), Counter())

        def shares(n):
            return {t: 1 + 1_000_000_000 * (n[t] + 1) // (sum(n.values()) + v) for t in kept}

        p = {s: shares(n) for s, n in counts.items()}
        q = shares(total)
        for s in counts:
            pairs = [
                (sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o) for o in counts if o != s
            ]
            terms = [((p[s][t] - q[t]) ** 2 // q[t], t) for t in counts[s] if p[s][t] > q[t]]
            for part, values in (("pair", pairs), ("term", terms)):
                values.sort(key=lambda x: (-x[0], x[1].encode()))
                values = values if part == "pair" else values[:top]
                found += [(lang, s, part, i, x, n + 1) for n, (x, i) in enumerate(values)]
    return sorted(found)


def check_audit(df, **how):
    found = divergence.audit(df, **how)
    assert found.columns == ["lang", "source", "part", "item", "value", "rank"]
    rows = [tuple(r) for r in df.select("text", "lang", "source").collect()]
    assert sorted(tuple(r) for r in found.collect()) == plain_audit(rows)


def test_audit(documents, odd_documents, no_documents):
    check_audit(documents)
    check_audit(odd_documents)
    assert divergence.audit(no_documents).count() == 0


def test_audit_in_many_cells(documents):
    """Groups on several blocks, terms on several blocks, and a source with most rows."""
    crowded = documents.withColumn(
        "source", F.when(F.col("doc_id") % 3 == 0, "src0").otherwise(F.col("source"))
    )
    check_audit(crowded, side=3, entries=400)


def test_words_of_long_texts(monkeypatch):
    monkeypatch.setattr(divergence, "_SLICE", 10)
    text = "Ünï code,42words–and A-Z\x7f[more]" * 50
    words = [w.decode() for part in divergence.words_of(text.encode()) for w in part]
    assert words == TERM.findall(text.translate(UPPER))


def test_tasks_give_out_what_they_hold(documents, monkeypatch):
    monkeypatch.setattr(divergence, "REMEMBERED", 100)
    check_audit(documents)


def test_shares_of_large_counts():
    counts = np.array([[0, 1, 7 * 10**14, 8 * 10**15]])
    of = np.array([9 * 10**15])
    plain = [1 + 10**9 * (int(n) + 1) // int(of[0]) for n in counts[0]]
    assert divergence._shares(counts, of)[0].tolist() == plain


# --- centroid clustering

small = st.integers(-3, 3)
vector = st.lists(small, min_size=2, max_size=2)


def brute(centroids, v):
    d = ((v[:, None, :] - centroids[None]) ** 2).sum(2)
    return d.argmin(1), d.min(1)


@settings(max_examples=300, deadline=None)
@given(st.lists(vector, min_size=1, max_size=40), st.lists(vector, min_size=1, max_size=20))
def test_tree_equals_brute_force_with_ties(centroids, v):
    centroids, v = np.array(centroids), np.array(v)
    who, best = clustering.VantageTree(centroids).nearest(v)
    plain_who, plain_best = brute(centroids, v)
    assert who.tolist() == plain_who.tolist() and best.tolist() == plain_best.tolist()


def test_tree_with_large_components():
    rng = np.random.default_rng(5)
    limit = clustering.LIMIT
    centroids = rng.integers(-limit, limit, (200, 64))
    v = np.concatenate([centroids[:50], centroids[50:100] + 1, rng.integers(-limit, limit, (100, 64))])
    who, best = clustering.VantageTree(centroids).nearest(v)
    plain_who, plain_best = brute(centroids, v)
    assert (who == plain_who).all() and (best == plain_best).all()


def test_tree_visits_few_of_many_centroids(monkeypatch):
    """Clustered centroids: most of the tree is cut off."""
    rng = np.random.default_rng(6)
    centroids = (rng.integers(0, 10**6, (32, 1, 8)) + rng.integers(0, 1000, (32, 16, 8))).reshape(-1, 8)
    met = []
    plain = clustering.squared
    monkeypatch.setattr(clustering, "squared", lambda v, c: met.append(len(v)) or plain(v, c))
    tree = clustering.VantageTree(centroids)
    met.clear()
    tree.nearest(centroids + 3)
    assert sum(met) < len(centroids) ** 2 / 4


def plain_clusters(rows, k=8, rounds=10, seed=3, dims=64):
    kept = [
        (i, [int(np.floor(1024 * float(x))) for x in v]) for i, v in rows
        if v is not None and len(v) == dims and all(x is not None and np.isfinite(x) for x in v)
    ]
    ticket = lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest(), r[1])
    centroids = np.array([v for _, v in sorted(kept, key=ticket)[:k]], np.int64)
    v = np.array([v for _, v in kept], np.int64)
    for _ in range(rounds):
        who, _ = brute(centroids, v)
        for c in range(len(centroids)):
            if (who == c).any():
                centroids[c] = v[who == c].sum(0) // (who == c).sum()
    who, best = brute(centroids, v)
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    return sorted(
        (
            (i, int(c), int(d), int(best[who == c].sum()), int(best.sum()), digests[c])
            for (i, _), c, d in zip(kept, who, best)
        ),
        key=repr,
    )


def check_clusters(df, **how):
    found = clustering.cluster(df, **how)
    assert found.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    rows = [tuple(r) for r in df.select("vec_id", "embedding").collect()]
    assert sorted((tuple(r) for r in found.collect()), key=repr) == plain_clusters(rows, **how)


@pytest.fixture(scope="module")
def embeddings(spark):
    return spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").select("vec_id", "embedding")


def test_clusters(embeddings):
    check_clusters(embeddings)
    check_clusters(embeddings, k=30, rounds=3)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [0.0, 0.0]), (2, [0.0, 0.0]), (2, [0.0, 0.0]), (3, [-0.0004, 1.5]), (4, None), (5, []),
        (6, [nan, 1.0]), (7, [1.0, -inf]), (8, [None, 1.0]), (9, [1.0, 2.0, 3.0]),
        (None, [5.0, 5.0]), (None, None), (10, [1000.0, -1000.0]), (2, [9.0, 9.0]),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    df = df.selectExpr("*", *(f"'x' AS `{c}`" for c in ("id", "v", "n", "cluster", "distance", "ticket")))
    for k in (1, 3, 8, 50):
        check_clusters(df, k=k, dims=2)
    assert clustering.cluster(df.where("vec_id = 4")).count() == 0
    assert clustering.cluster(df.where("false")).columns[0] == "vec_id"


def test_refuses_what_a_long_cannot_hold(spark):
    df = spark.createDataFrame([(1, [1e30, 0.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="over 65536 in size"):
        clustering.cluster(df, dims=2).collect()
