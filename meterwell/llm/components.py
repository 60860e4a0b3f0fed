"""Connected components of a link table by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterwell.llm.tables import stored


def connected_components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) for every long node of `links`; component is the smallest node.

    Each round lets every node follow the neighbour that comes first in an order
    drawn anew for the round, then replaces nodes by what they follow. That shrinks
    chains as fast as stars, so rounds grow with the logarithm of the longest chain.
    Links stay in tables; the driver sees one count a round. A hub with many links
    is pre-aggregated by `min` and its joins are split by adaptive execution.
    Null ends and self-links are ignored; an empty link table gives an empty result.
    """
    left, right = F.least(a, b), F.greatest(a, b)
    edges = links.where(F.col(a) != F.col(b)).select(left.alias("a"), right.alias("b"))
    edges = stored(edges.distinct(), "links")
    rounds: list[DataFrame] = []
    while not edges.isEmpty():
        draw = F.lit(len(rounds))
        both = edges.select(F.col("a").alias("node"), F.col("b").alias("near")).union(
            edges.select(F.col("b").alias("node"), F.col("a").alias("near"))
        )
        order = F.struct(F.xxhash64("near", draw).alias("h"), F.col("near").alias("id"))
        own = F.struct(F.xxhash64("node", draw).alias("h"), F.col("node").alias("id"))
        follow = both.groupBy("node").agg(F.min(order).alias("first"))
        follow = stored(follow.select("node", F.least("first", own)["id"].alias("head")), "heads")
        for end in ("a", "b"):
            step = follow.select(F.col("node").alias(end), F.col("head").alias(f"{end}_head"))
            edges = edges.join(step, end).drop(end).withColumnRenamed(f"{end}_head", end)
        edges = edges.where("a != b").select(
            F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
        )
        edges = stored(edges.distinct(), "links")
        rounds.append(follow)
    if not rounds:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    labels = rounds[0]
    for follow in rounds[1:]:
        step = follow.select(F.col("node").alias("head"), F.col("head").alias("next"))
        labels = labels.join(step, "head", "left").select(
            "node", F.coalesce("next", "head").alias("head")
        )
    labels = stored(labels, "labels")
    smallest = labels.groupBy("head").agg(F.min("node").alias("component"))
    return labels.join(smallest, "head").select("node", "component")
