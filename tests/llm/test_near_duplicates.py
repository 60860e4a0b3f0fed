"""SimHash, embeddings and components against brute force."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
import xxhash
from pyspark.sql import functions as F

from meterwell.llm import neighbours, simhash
from meterwell.llm.components import connected_components
from meterwell.llm.tables import joined_by_weight, stored


def components(n, pairs):
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def plain_fingerprint(text):
    words = "".join(c.lower() if c.isascii() else c for c in text or "")
    for blank in "\t\n\x0b\f\r":
        words = words.replace(blank, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints_of_plain_definition(documents):
    for text in [None, "", "A", "a B", *(r[0] for r in documents.select("text").limit(60).collect())]:
        assert simhash.fingerprint(text) % (1 << 64) == plain_fingerprint(text)


@pytest.mark.parametrize("crowd", [256, 1])
def test_links_connect_all_within_three_bits(spark, monkeypatch, crowd):
    """Planted balls, chains and loners; with and without the form for crowded buckets."""
    monkeypatch.setattr(simhash, "CROWD", crowd)
    rng = np.random.default_rng(3)
    prints = set(rng.integers(0, 1 << 63, 60).tolist())
    for centre in rng.integers(0, 1 << 63, 4).tolist():
        at = centre
        for _ in range(15):
            for bit in rng.choice(63, int(rng.integers(1, 5)), replace=False):
                at ^= 1 << int(bit)
            prints.add(at)
            at = centre if rng.random() < 0.5 else at
    prints = sorted(prints)
    pairs = [
        (i, j) for i in range(len(prints)) for j in range(i)
        if (prints[i] ^ prints[j]).bit_count() <= 3
    ]
    assert len(pairs) > 20
    df = spark.createDataFrame([(p,) for p in prints], "fp long")
    links = [(r.a, r.b) for r in simhash.near_links(df).collect()]
    assert all((a ^ b).bit_count() <= 3 for a, b in links)
    number = {p: i for i, p in enumerate(prints)}
    got = components(len(prints), [(number[a], number[b]) for a, b in links])
    assert got == components(len(prints), pairs)


def test_groups_of_odd_documents(odd_documents, no_documents):
    rows = simhash.near_duplicates(odd_documents).collect()
    assert len(rows) == odd_documents.count()
    of = {}
    for r in rows:
        of.setdefault(r.doc_id, set()).add((r.fingerprint, r.component_id))
    zero = "0" * 16
    assert of[1] == of[2] == of[3] == {(zero, 1)} and (zero, 1) in of[None]
    assert of[5] == of[6] and {c for _, c in of[5]} == {5} and len(of[None]) == 2
    assert simhash.near_duplicates(no_documents).count() == 0
    kept = simhash.one_of_each(odd_documents)
    assert kept.columns == odd_documents.columns
    ids = [r[0] for r in kept.select("doc_id").collect()]
    assert ids.count(5) == 2 and 6 not in ids and ids.count(None) == 2


def test_one_of_each_judges_repeated_ids_by_text(spark):
    a, b = (" ".join(f"{w}{i}" for i in range(400)) for w in "ab")
    rows = [(3, a), (5, a), (5, b), (9, b), (5, b), (None, a), (7, "all alone"), (7, b)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = sorted(map(tuple, simhash.one_of_each(docs).collect()), key=str)
    assert kept == sorted([(3, a), (5, b), (5, b), (None, a), (7, "all alone")], key=str)


def test_heavy_keys_are_joined_where_they_are(spark):
    """A third of the rows have one key; they meet its label without a shuffle."""
    rows = stored(spark.range(30_000).selectExpr("id", "IF(id < 10000, -1, id) AS k"), "rows")
    counted = rows.groupBy("k").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("label"))
    joined = joined_by_weight(rows, stored(counted, "labels"), "k", "n")
    assert joined.columns == ["k", "id", "label"]
    wrong = joined.where("label != IF(id < 10000, 0, id)")
    assert joined.count() == 30_000 and wrong.count() == 0
    labels = stored(counted.where("k = -1"), "labels")
    assert joined_by_weight(rows, labels, "k", "n").count() == 10_000
    assert joined_by_weight(rows.where("false"), labels, "k", "n").count() == 0


def test_one_of_each_of_a_large_group(spark):
    """Copies and near copies that fill most of the table leave their smallest document."""
    words = [f"word{i}" for i in range(400)]
    near = [" ".join([*words, f"tail{i % 7}"]) for i in range(2_500)]
    other = [" ".join(f"{i}x{j}" for j in range(30)) for i in range(40)]
    rows = [*((i + 100, t) for i, t in enumerate(near)), *((i, t) for i, t in enumerate(other))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    groups = simhash.near_duplicates(docs).groupBy("component_id").count().collect()
    kept = sorted(r.doc_id for r in simhash.one_of_each(docs).collect())
    assert kept == sorted(r.component_id for r in groups) and max(r["count"] for r in groups) > 300


def test_components_of_chains_stars_and_loops(spark):
    pairs = [(i, i + 1) for i in range(100, 140)] + [(7, i) for i in range(20, 60)] + [(3, 3), (5, None)]
    df = spark.createDataFrame(pairs, "a long, b long")
    got = {r.node: r.component for r in connected_components(df, "a", "b").collect()}
    assert {got[i] for i in range(100, 141)} == {100} and {got[i] for i in range(20, 60)} == {7}
    assert 3 not in got and 5 not in got
    assert connected_components(df.where("false"), "a", "b").count() == 0


def brute_force(vectors):
    x = np.array(vectors, float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= 0.95
    np.fill_diagonal(near, False)
    return near


def test_embeddings_in_many_shards(spark, monkeypatch):
    """Tight groups among random vectors, dealt over several levels of shards."""
    monkeypatch.setattr(neighbours, "SHARD", 60)
    monkeypatch.setattr(neighbours, "SHARD_MOST", 150)
    rng = np.random.default_rng(5)
    x = rng.normal(size=(700, 16))
    for i, size in enumerate((2, 3, 40, 150)):
        centre = rng.normal(size=16)
        x[i * 160 : i * 160 + size] = centre + rng.normal(size=(size, 16)) * 0.08
    x[690:695] = x[690]  # copies
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    rows = sorted(neighbours.near_duplicates(df).collect())
    near = brute_force([r.embedding for r in df.orderBy("vec_id").collect()])
    links = np.array([r.n_links for r in rows])
    assert (links <= near.sum(1)).all() and links.sum() >= 0.95 * near.sum() > 100
    pairs = [(int(a), int(b)) for a, b in zip(*np.nonzero(near))]
    expected = components(len(x), pairs)
    same = sum(r.component_id == e for r, e in zip(rows, expected))
    assert same >= 0.97 * len(x)
    assert all(r.kept == (r.vec_id == r.component_id) for r in rows)


def test_a_link_counts_once_and_at_both_ends():
    """Shards that share pairs count each pair once, whichever search had tied it."""
    rng = np.random.default_rng(8)
    x = rng.normal(size=12) + rng.normal(size=(90, 12)) * 0.2
    x[60:] = rng.normal(size=12) + rng.normal(size=(30, 12)) * 0.2
    copies = rng.integers(1, 4, 90)
    held = [sorted(rng.choice(list("abc"), rng.integers(1, 4), replace=False)) for _ in x]
    rows = pd.DataFrame(
        {"node": range(90), "n": copies, "v": list(x), "shards": held, "component": [0] * 60 + [60] * 30}
    )
    links = np.zeros(90, int)
    for shard in "abc":
        own = rows[[shard in s for s in held]].assign(shard=shard).sample(frac=1, random_state=1)
        for r in neighbours._counted(own).itertuples():
            links[r.node] += r.links
    meet = np.array([[bool({*p} & {*q}) for q in held] for p in held])
    meet[:60, 60:] = meet[60:, :60] = False
    assert links.tolist() == ((brute_force(x) & meet) * copies).sum(1).tolist()
    assert 0 < brute_force(x)[:60, :60].mean() < 1


def test_audit_draws_on_until_links_are_seen(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "AUDIT", 8)
    monkeypatch.setattr(neighbours, "LINKED", 10)
    x = np.random.default_rng(9).normal(size=(400, 16))
    x[390:] = x[380:390] * 2 + 0.01
    rows = [(i, 1, v.tolist()) for i, v in enumerate(x)]
    nodes = spark.createDataFrame(rows, "node long, n long, v array<double>")
    audit = neighbours.audited(nodes)
    near = brute_force(x).sum(1)
    assert near.sum() >= 20
    got = {r.node: r.true_links for r in audit.collect()}
    assert len(got) > 100 and all(near[i] == n for i, n in got.items())
    assert sum(n > 0 for n in got.values()) >= 10
    # Without a link all nodes are counted.
    assert neighbours.audited(nodes.where("node < 380")).count() == 380


def test_recall_is_that_of_links_and_of_vectors(spark):
    audit = spark.createDataFrame([(1, 98), (2, 1), (3, 1), (4, 0)], "node long, true_links long")
    links = spark.createDataFrame([(1, 98), (4, 0)], "node long, links long")
    assert neighbours.recall(links, audit) == pytest.approx(1 / 3)
    links = spark.createDataFrame([(2, 1), (3, 1)], "node long, links long")
    assert neighbours.recall(links, audit) == pytest.approx(0.02)
    assert neighbours.recall(links, audit.where("true_links = 0")) == 1.0


def test_crowds_larger_than_a_shard_keep_all_links(spark, monkeypatch):
    """A tight and a wide crowd, both larger than any shard searched by graph, and pairs."""
    monkeypatch.setattr(neighbours, "SHARD", 60)
    monkeypatch.setattr(neighbours, "SHARD_MOST", 150)
    # The audit may not send the crowds to a second try.
    monkeypatch.setattr(neighbours, "recall", lambda links, audit: 1.0)
    rng = np.random.default_rng(6)
    x = rng.normal(size=(1500, 24))
    x[:500] = x[0] + rng.normal(size=(500, 24)) * 0.03
    x[500:900] = x[500] + rng.normal(size=(400, 24)) * 0.26
    x[1000:1010] = x[1010:1020] * 3
    x[:1500:2] *= 1.7
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    rows = sorted(neighbours.near_duplicates(df.repartition(5)).collect())
    near = brute_force(x)
    links = near.sum(1)
    assert 0 < near[500:900, 500:900].mean() < 0.95  # the wide crowd links in part
    assert [r.n_links for r in rows[:900]] == links[:900].tolist()
    pairs = [(int(a), int(b)) for a, b in zip(*np.nonzero(near))]
    assert [r.component_id for r in rows[:900]] == components(len(x), pairs)[:900]


def test_low_recall_ends_in_an_exact_search(spark, monkeypatch):
    """When no retry is good enough the result is exact and not the last try."""
    monkeypatch.setattr(neighbours, "SHARD", 20)
    monkeypatch.setattr(neighbours, "SHARD_MOST", 40)
    monkeypatch.setattr(neighbours, "FANOUT", 6)
    monkeypatch.setattr(neighbours, "recall", lambda links, audit: 0.5)
    rng = np.random.default_rng(7)
    x = np.repeat(rng.normal(size=(80, 12)), 3, axis=0) + rng.normal(size=(240, 12)) * 0.12
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    rows = sorted(neighbours.near_duplicates(df).collect())
    near = brute_force(x)
    assert [r.n_links for r in rows] == near.sum(1).tolist()
    pairs = [(int(a), int(b)) for a, b in zip(*np.nonzero(near))]
    assert [r.component_id for r in rows] == components(len(x), pairs)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [1.0, None]),
        (7, [nan, 1.0]), (8, [inf, 1.0]), (9, [0.0, 1.0]), (9, [0.0, 1.0]), (10, [1.0, 0.0, 0.0]),
        (None, [1.0, 0.0]), (11, [1e300, 1e300]), (12, [1e-300, 1e-300]),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("node", F.lit(0))
    got = {}
    for r in neighbours.near_duplicates(df).collect():
        got.setdefault(r.vec_id, []).append((r.n_links, r.component_id, r.kept))
    assert got[1] == [(2, 1, True)] and got[2] == [(2, 1, False)] and got[None] == [(2, 1, False)]
    for loner in (3, 4, 5, 6, 7, 8, 10):
        assert got[loner] == [(0, loner, True)]
    assert got[9] == [(1, 9, True)] * 2
    assert got[11] == [(1, 11, True)] and got[12] == [(1, 11, False)]
    assert neighbours.near_duplicates(df.where("false")).count() == 0
