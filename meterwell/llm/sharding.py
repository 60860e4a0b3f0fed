"""Sharding by a permutation-filled lookup table."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Slots of the table: a prime, some hundred times the shards. It bounds what is broadcast.
SLOTS = 65_537
SHARDS = 64


def shard_names(n: int = SHARDS) -> list[str]:
    return [f"shard-{i:05}" for i in range(n)]


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n**0.5) + 1))


def lookup_table(
    shards: Sequence[str], slots: int = SLOTS, weights: Sequence[int] | None = None
) -> np.ndarray:
    """The shard number of each slot.

    A shard's name gives it a preference order of all slots: a start and a step, which
    visit every slot once because their number is prime. Shards take turns, each
    claiming the next slot of its order that is free (as many as its weight), until none
    is left. So shards of equal weight differ by one slot at most, and when a shard comes
    or goes nearly all other slots stay where they were.
    """
    if not _is_prime(slots):
        raise ValueError(f"{slots} slots: not a prime")
    if not shards or len(set(shards)) < len(shards) or len(shards) > slots:
        raise ValueError("shards must be different, at least one, and no more than slots")
    turns = list(weights or [1] * len(shards))
    if len(turns) != len(shards) or min(turns) < 1:
        raise ValueError("a weight of at least one for each shard")
    starts, steps = [], []
    for name in shards:
        digest = hashlib.sha256(name.encode()).digest()
        starts.append(int.from_bytes(digest[:8], "big") % slots)
        steps.append(int.from_bytes(digest[8:16], "big") % (slots - 1) + 1)
    table, at, free = [-1] * slots, starts, slots
    while True:
        for shard, turn in enumerate(turns):
            for _ in range(turn):
                slot = at[shard]
                while table[slot] >= 0:
                    slot = (slot + steps[shard]) % slots
                table[slot] = shard
                at[shard] = (slot + steps[shard]) % slots
                free -= 1
                if not free:
                    return np.array(table, np.int32)


def slot_of(keys: Sequence[str | Column], slots: int = SLOTS) -> Column:
    """The slot of a row: a hash of its key columns. Nulls have slots like other values."""
    return F.pmod(F.xxhash64(*keys), F.lit(slots)).cast("int")


def place(
    docs: DataFrame,
    shards: Sequence[str],
    keys: Sequence[str] = ("doc_id", "text"),
    slots: int = SLOTS,
    weights: Sequence[int] | None = None,
    shard_col: str = "shard",
) -> DataFrame:
    """`docs` with the shard of each row; a column of that name is replaced.

    One look at a broadcast table of `slots` rows for each row, no shuffle. Rows with the
    same keys go together; with the text among the keys, a group of one id or source is
    spread over all shards and only whole repeats stay together. Null and empty keys are
    placed like any other; an empty table gives an empty one.
    """
    table = lookup_table(shards, slots, weights)
    rows = [(slot, shards[shard]) for slot, shard in enumerate(table.tolist())]
    looked_up = docs.sparkSession.createDataFrame(rows, "__slot int, __shard string")
    marked = docs.drop(shard_col).withColumn("__slot", slot_of(keys, slots))
    return (
        marked.join(F.broadcast(looked_up), "__slot")
        .withColumnRenamed("__shard", shard_col)
        .drop("__slot")
    )


def write_shards(placed: DataFrame, path: str, shard_col: str = "shard") -> None:
    """One folder per shard; a shard of many rows is written by many tasks."""
    placed.hint("rebalance", F.col(shard_col)).write.partitionBy(shard_col).parquet(path)


def shard_loads(placed: DataFrame, text_col: str = "text", shard_col: str = "shard") -> DataFrame:
    """(shard, n_docs, n_chars): how much each shard got."""
    return placed.groupBy(shard_col).agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.sum(F.coalesce(F.length(text_col), F.lit(0))).cast("long").alias("n_chars"),
    )
