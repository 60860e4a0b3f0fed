"""Placement by lookup table."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pytest

from meterwell.llm import sharding
from meterwell.llm.queries import queries
from meterwell.sources.scratch import scratch_dir


def plain_table(shards, slots):
    """Turn taking over written-out preference lists."""
    import hashlib

    orders = []
    for name in shards:
        digest = hashlib.sha256(name.encode()).digest()
        start, step = int.from_bytes(digest[:8], "big"), int.from_bytes(digest[8:16], "big")
        step = step % (slots - 1) + 1
        orders.append([(start + i * step) % slots for i in range(slots)])
        assert sorted(orders[-1]) == list(range(slots))
    table = {}
    while len(table) < slots:
        for shard, order in enumerate(orders):
            if len(table) < slots:
                table[next(s for s in order if s not in table)] = shard
    return [table[s] for s in range(slots)]


def test_table_equals_plain_turn_taking():
    shards = [f"s{i}" for i in range(7)]
    assert sharding.lookup_table(shards, 101).tolist() == plain_table(shards, 101)


def test_slots_are_even_and_stay_when_a_shard_goes():
    names = sharding.shard_names(40)
    table = sharding.lookup_table(names)
    counts = np.bincount(table)
    assert counts.max() - counts.min() <= 1
    fewer = sharding.lookup_table(names[:-1])
    stayed = (table == fewer)[table != 39].mean()
    assert stayed > 0.95
    weighted = np.bincount(sharding.lookup_table(["a", "b"], 997, [3, 1]))
    assert abs(weighted[0] - 3 * weighted[1]) <= 3


@pytest.mark.parametrize("shards, slots, weights", [
    ([], 101, None), (["a", "a"], 101, None), (["a"], 100, None), (["a", "b"], 101, [1, 0]),
])
def test_bad_tables_are_refused(shards, slots, weights):
    with pytest.raises(ValueError):
        sharding.lookup_table(shards, slots, weights)


def test_placement_of_odd_documents(spark, odd_documents, no_documents):
    names = sharding.shard_names(5)
    placed = sharding.place(odd_documents, names)
    assert placed.columns == [c for c in odd_documents.columns if c != "shard"] + ["shard"]
    rows = placed.collect()
    assert len(rows) == odd_documents.count() and {r["shard"] for r in rows} <= set(names)
    of = {}
    for r in rows:
        of.setdefault((r["doc_id"], r["text"]), set()).add(r["shard"])
    assert all(len(shards) == 1 for shards in of.values())
    assert sharding.place(no_documents, names).count() == 0
    path = scratch_dir(spark, "shards")
    sharding.write_shards(placed, path)
    assert spark.read.parquet(path).count() == len(rows)


def test_query_places_every_document_evenly(spark, documents):
    rows = queries()["op5_sharding"](spark, "/root/testdata/sf0.001").collect()
    assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in documents.select("doc_id").collect())
    table = sharding.lookup_table(sharding.shard_names())
    slots = {r.doc_id: r.s for r in documents.select("doc_id", sharding.slot_of(["doc_id", "text"]).alias("s")).collect()}
    assert all(r.shard == sharding.shard_names()[table[slots[r.doc_id]]] for r in rows)
    assert max(Counter(r.shard for r in rows).values()) < 20
