"""Embedding near-duplicates on a robust-pruned flat graph."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterwell.llm.components import connected_components
from meterwell.llm.tables import stored

COSINE = 0.95
# Vectors in a shard: what splits aim at, and what a task searches by graph. Larger shards
# that no split separates are searched exactly, in pairs of blocks of about SHARD_MOST.
SHARD, SHARD_MOST = 600, 4_000
# Sampled links from which a vector counts as part of a crowd; ANGLE is COSINE as an angle.
SEEN, ANGLE = 8, float(np.arccos(COSINE))
# What the name of a shard that is searched exactly starts with; such come first in order.
WHOLE = "!"
# Shards a split makes, shards a vector goes to at the first and at later splits.
FANOUT, OVERLAP, LATER_OVERLAP = 64, 3, 2
# Vectors that centroids are fitted to, a shard; rounds of fitting; splits at most.
SAMPLE, ROUNDS, DEPTH = 4_096, 6, 8
# Nearest and drawn candidates of a node, edges kept of each, and the slack of pruning.
NEAR, DRAWN, NEAR_EDGES, FAR_EDGES, ALPHA = 64, 32, 24, 8, 1.2
# Queries searched together, nodes each expands in a step, steps without gain that end it.
QUERIES, WIDTH, PATIENCE = 256, 8, 3
# Vectors whose links are counted by brute force: at first, and at most. They are four times
# as many in each draw until LINKED of them have a link. RECALL is what they must show.
AUDIT, AUDIT_MOST, LINKED, RECALL = 200, 12_800, 50, 0.95
# Drawn vectors that are compared with a batch at a time.
DRAWN_AT_ONCE = 1_024


def _matrix(vectors: pd.Series) -> np.ndarray:
    """Unit rows in double precision."""
    x = np.stack([np.asarray(v, np.float64) for v in vectors])
    x /= np.abs(x).max(1, keepdims=True)  # so that squares neither overflow nor vanish
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def centroids(x: np.ndarray, k: int) -> np.ndarray:
    """At most `k` unit centroids of spherical k-means, from evenly spaced first rows."""
    c = x[np.unique(np.linspace(0, len(x) - 1, k).astype(int))]
    for _ in range(ROUNDS):
        nearest = (x @ c.T).argmax(1)
        sums = np.zeros_like(c)
        np.add.at(sums, nearest, x)
        norms = np.sqrt((sums * sums).sum(1, keepdims=True))
        c = np.where(norms > 1e-12, sums / np.maximum(norms, 1e-12), c)
    return c


def _joined(touch: np.ndarray) -> np.ndarray:
    """The smallest index that each row of the symmetric matrix `touch` is connected to."""
    label = np.arange(len(touch))
    while True:
        least = np.where(touch, label[None, :], len(label)).min(1, initial=len(label))
        new = np.minimum(label, least)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def crowds(x: np.ndarray, c: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The cell of each centroid of `c`, and the cosine from which a cell takes a vector.

    `x` is a sample of `size` vectors. A vector is crowded if about SHARD / 4 others are
    linked to it; a split would tear its links apart. So centroids that linked crowded
    vectors are nearest to share one cell, named by the smallest. A crowd's cell takes
    only what is near enough to be linked to a vector of the crowd; other cells take all.
    """
    nearest = (x @ c.T).argmax(1)
    least = max(SEEN, SHARD / 4 * len(x) / size)
    degree = np.concatenate(
        [(x[at : at + 512] @ x.T >= COSINE).sum(1) - 1 for at in range(0, len(x), 512)]
    )
    crowded = degree >= least
    y, near = x[crowded], nearest[crowded]
    touch = np.zeros((len(c), len(c)), bool)
    for at in range(0, len(y), 512):
        i, j = np.nonzero(y[at : at + 512] @ y.T >= COSINE)
        touch[near[at + i], near[j]] = True
    cell, takes = _joined(touch | touch.T), np.full(len(c), -2.0)
    away = np.arccos(np.clip(np.einsum("nd,nd->n", y, c[near]), -1, 1))
    for own in np.unique(cell[near]):
        # The crowd's radius is that of a sample, so some more is allowed.
        reach = 1.2 * away[cell[near] == own].max() + ANGLE + 0.05
        takes[cell == own] = np.cos(min(np.pi, reach))
    return cell, takes


def valid_vectors(rows: DataFrame) -> DataFrame:
    """The rows (id, v) whose vector has a direction: no null or non-finite part, not zero."""
    sound = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where(F.col("v").isNotNull() & sound & F.exists("v", lambda x: x != 0))


def _fitted(members: DataFrame, sizes: DataFrame, aim: int) -> DataFrame:
    """(shard, c, cell, takes) of each shard in `sizes`: its centroids and crowds.

    They are fitted in a task per shard to about SAMPLE of its vectors, drawn by hash;
    there is a centroid for each `aim` vectors, up to FANOUT.
    """
    share = F.col("sample") / F.col("size")
    place = F.pmod(F.xxhash64("node", "shard"), F.lit(1 << 30)) / (1 << 30)
    sized = sizes.withColumn("sample", F.lit(SAMPLE))

    def fit(own: pd.DataFrame) -> pd.DataFrame:
        x = _matrix(own.sort_values("node")["v"])
        size = int(own["size"].iloc[0])
        c = centroids(x, int(np.clip(-(-size // aim), 2, FANOUT)))
        cell, takes = crowds(x, c, size)
        return pd.DataFrame(
            {"shard": own["shard"].iloc[:1], "c": [c.ravel()], "cell": [cell], "takes": [takes]}
        )

    sampled = members.join(sized, "shard").where(place < share)
    fitted = sampled.groupBy("shard").applyInPandas(
        fit, "shard string, c array<double>, cell array<int>, takes array<double>"
    )
    return stored(fitted, "centroids")  # its size on disk decides how it is joined


def _split(members: DataFrame, fitted: DataFrame, overlap: int) -> DataFrame:
    """Members (node, n, v, shard) of the shards in `fitted`, each in its nearest new shards."""

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for shard, own in batch.groupby("shard"):
                x = _matrix(own["v"])
                c = np.asarray(own["c"].iloc[0]).reshape(-1, x.shape[1])
                cell, takes = np.asarray(own["cell"].iloc[0]), np.asarray(own["takes"].iloc[0])
                sims, names = x @ c.T, np.unique(cell)
                best = np.stack([sims[:, cell == i].max(1) for i in names], axis=1)
                best[best < takes[names]] -= 4  # after all cells that take it
                order = np.argsort(-best, axis=1, kind="stable")[:, :overlap]
                for j in range(order.shape[1]):
                    taken = best[np.arange(len(x)), order[:, j]] >= (-1.5 if j else -9)
                    yield pd.DataFrame(
                        {"node": own["node"][taken], "n": own["n"][taken], "v": own["v"][taken],
                         "shard": [f"{shard}.{i}" for i in names[order[taken, j]]]}
                    )

    joined = members.join(fitted, "shard").select("node", "n", "v", "shard", "c", "cell", "takes")
    return joined.mapInPandas(assign, "node long, n long, v array<double>, shard string")


def shards(nodes: DataFrame, overlap: int = OVERLAP) -> DataFrame:
    """Members (node, n, v, shard) of overlapping cluster shards.

    Shards of more than SHARD_MOST vectors are split by their own centroids until none
    is left that can be. What is one crowd, or is large after DEPTH splits, stays whole
    and gets a name that starts with WHOLE.
    """
    members = stored(nodes.withColumn("shard", F.lit("0")), "members")
    done: list[DataFrame] = []
    whole = F.concat(F.lit(WHOLE), "shard")
    for depth in range(DEPTH + 1):
        sizes = members.groupBy("shard").agg(F.count(F.lit(1)).alias("size"))
        large = stored(sizes.where(F.col("size") > (SHARD_MOST if depth else SHARD)), "large")
        if large.isEmpty():
            break
        done.append(members.join(large, "shard", "left_anti"))
        if depth == DEPTH:
            members = members.join(large, "shard", "left_semi").withColumn("shard", whole)
            break
        fitted = _fitted(members, large, SHARD)
        one = F.size(F.array_distinct("cell")) == 1
        crowd = fitted.where(one).join(large, "shard").select("shard", "size")
        kept = members.join(crowd, "shard")
        named = F.when(F.col("size") > SHARD_MOST, whole).otherwise(F.col("shard"))
        done.append(kept.withColumn("shard", named).select(members.columns))
        members = _split(members, fitted.where(~one), LATER_OVERLAP if depth else overlap)
        members = stored(members, "members")
    for part in done:
        members = members.unionByName(part)
    return members


def pruned_graph(x: np.ndarray) -> np.ndarray:
    """Out-edges of each row of `x`: NEAR_EDGES near ones and FAR_EDGES far ones, -1 for none.

    Robust pruning takes the nearest candidate left and drops those that are nearer to
    it, by the factor ALPHA, than to the node. Near candidates are the nearest rows, far
    ones are drawn at random, so that a tight group keeps ways in and out.
    """
    n = len(x)
    rng = np.random.default_rng(n)
    near = np.empty((n, min(NEAR, n - 1)), np.int64)
    for at in range(0, n, 512):
        sims = x[at : at + 512] @ x.T
        sims[np.arange(len(sims)), np.arange(at, at + len(sims))] = -np.inf
        near[at : at + 512] = np.argpartition(-sims, near.shape[1] - 1, axis=1)[:, : near.shape[1]]
    drawn = rng.integers(0, n, (n, min(DRAWN, n - 1)))
    return np.concatenate([_pruned(x, near, NEAR_EDGES), _pruned(x, drawn, FAR_EDGES)], axis=1)


def _pruned(x: np.ndarray, candidates: np.ndarray, edges: int) -> np.ndarray:
    out = np.full((len(x), edges), -1, np.int64)
    for at in range(0, len(x), 256):
        own = np.arange(at, min(at + 256, len(x)))
        found = candidates[own]
        vectors = x[found]
        away = np.sqrt(np.maximum(2 - 2 * np.einsum("qcd,qd->qc", vectors, x[own]), 0))
        away[found == own[:, None]] = np.inf
        for e in range(edges):
            best = away.argmin(1)
            some = np.isfinite(away[np.arange(len(own)), best])
            if not some.any():
                break
            chosen = found[np.arange(len(own)), best]
            out[own[some], e] = chosen[some]
            between = np.sqrt(np.maximum(2 - 2 * np.einsum("qcd,qd->qc", vectors, x[chosen]), 0))
            away[ALPHA * between <= away] = np.inf
            away[np.arange(len(own)), best] = np.inf
    return out


def range_search(x: np.ndarray, edges: np.ndarray, queries: np.ndarray, medoid: int) -> np.ndarray:
    """Similarity of each query row to each row it met, -2 for rows it didn't meet.

    Greedy search starts at the medoid and at the query's own node and expands the
    WIDTH most similar nodes a step. Within the range every node met is expanded;
    outside, it goes on while the best similarity still grows.
    """
    q, n = len(queries), len(x)
    sims = np.full((q, n), -2.0, np.float32)
    closed = np.zeros((q, n), bool)
    rows = np.arange(q)
    low = x.astype(np.float32)
    for start in (np.full(q, medoid), queries):
        sims[rows, start] = np.einsum("qd,qd->q", low[queries], low[start])
    best = np.full(q, -2.0)
    waited = np.zeros(q, np.int64)
    active = rows
    width = min(WIDTH, n)
    while len(active):
        view = np.where(closed[active], -3.0, sims[active])
        top = np.argpartition(-view, width - 1, axis=1)[:, :width]
        value = np.take_along_axis(view, top, 1)
        head = value.max(1)
        waited[active] = np.where(head > best[active], 0, waited[active] + 1)
        best[active] = np.maximum(best[active], head)
        going = (head >= COSINE - 1e-3) | ((head > -2) & (waited[active] < PATIENCE))
        i, j = np.nonzero((value > -2) & going[:, None])
        owner, node = active[i], top[i, j]
        closed[owner, node] = True
        target = edges[node]
        owner, target = np.repeat(owner, target.shape[1]), target.ravel()
        fresh = (target >= 0) & (sims[owner, np.maximum(target, 0)] == -2)
        owner, target = owner[fresh], target[fresh]
        if len(owner):
            pair = np.unique(owner * n + target)
            owner, target = pair // n, pair % n
            sims[owner, target] = np.einsum("pd,pd->p", low[queries[owner]], low[target])
        active = active[going]
    return sims


def _edges(members: pd.DataFrame) -> pd.DataFrame:
    members = members.sort_values("node", kind="stable")
    node = members["node"].to_numpy(np.int64)
    if len(node) < 2:
        return pd.DataFrame({"node": node[:0], "near": node[:0]})
    out = pruned_graph(_matrix(members["v"]))
    source, _ = np.nonzero(out >= 0)
    return pd.DataFrame({"node": node[source], "near": node[out[out >= 0]]})


def _search(members: pd.DataFrame) -> pd.DataFrame:
    """Ties (node, near): each member and the smallest one its links here lead to.

    Pairs themselves aren't given out. Only links verified in double precision tie.
    """
    members = members.sort_values("node", kind="stable")
    node = members["node"].to_numpy(np.int64)
    n = len(node)
    x = _matrix(members["v"])
    adjacent = [np.searchsorted(node, near) for near in members["nears"]]
    known = [at[(at < n) & (node[np.minimum(at, n - 1)] == near)]
             for at, near in zip(adjacent, members["nears"])]
    edges = np.full((n, max(1, *map(len, known))), -1, np.int64)
    for i, at in enumerate(known):
        edges[i, : len(at)] = at
    mean = x.mean(0)
    medoid = int((x @ mean).argmax())
    root = np.arange(n)

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = int(root[i])
        return i

    for at in range(0, n, QUERIES):
        queries = np.arange(at, min(at + QUERIES, n))
        sims = range_search(x, edges, queries, medoid)
        q, t = np.nonzero(sims >= COSINE - 1e-3)
        own = queries[q]
        exact = np.concatenate(
            [np.einsum("pd,pd->p", x[own[b : b + 65536]], x[t[b : b + 65536]])
             for b in range(0, len(own), 65536)] or [np.zeros(0)]
        )
        right = (exact >= COSINE) & (own != t)
        # One pass over the links of a query joins its component.
        for a, b in zip(own[right].tolist(), t[right].tolist()):
            if root[a] != root[b]:
                a, b = find(a), find(b)
                root[max(a, b)] = min(a, b)
    tops = np.array([find(i) for i in range(n)])
    tied = tops != np.arange(n)
    return pd.DataFrame({"node": node[tied], "near": node[tops[tied]]})


def _counted(members: pd.DataFrame) -> pd.DataFrame:
    """Rows (node, links) of a shard's members of components: their links, verified exactly.

    Members of one component are compared with one another in double precision, so a
    link counts at both ends, whichever search met it and in whichever shard. A pair
    that an earlier shard holds too is left to that shard, which compares it as well.
    """
    members = members.sort_values("component", kind="stable")
    here = members["shard"].iloc[0]
    x, copies = _matrix(members["v"]), members["n"].to_numpy(np.int64)
    before = [[s for s in held if s < here] for held in members["shards"]]
    number = {s: i for i, s in enumerate(sorted({s for held in before for s in held}))}
    earlier = np.zeros((len(x), len(number)), np.float32)
    for i, held in enumerate(before):
        earlier[i, [number[s] for s in held]] = 1
    links = np.zeros(len(x), np.int64)
    _, starts = np.unique(members["component"].to_numpy(), return_index=True)
    for start, end in zip(starts, [*starts[1:], len(x)]):
        y, e, n = x[start:end], earlier[start:end], end - start
        linked = np.empty((n, n), bool)
        for at in range(0, n, 512):
            linked[at : at + 512] = y[at : at + 512] @ y.T >= COSINE
            linked[at : at + 512] &= ~(e[at : at + 512] @ e.T > 0)
        linked &= linked.T
        np.fill_diagonal(linked, False)
        links[start:end] = [copies[start:end][row].sum() for row in linked]
    out = pd.DataFrame({"node": members["node"].to_numpy(np.int64), "links": links})
    return out[out["links"] > 0]


def _blocks(members: DataFrame) -> DataFrame:
    """(shard, node, n, v, earlier, block): shards cut into blocks of about SHARD_MOST.

    Members of a block have the nearest centroid and the earlier whole shards that hold
    them in common.
    """
    sizes = stored(members.groupBy("shard").agg(F.count(F.lit(1)).alias("size")), "sizes")

    def nearest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for _, own in batch.groupby("shard"):
                x = _matrix(own["v"])
                c = np.asarray(own["c"].iloc[0]).reshape(-1, x.shape[1])
                yield own.drop(columns="c").assign(near=(x @ c.T).argmax(1))

    fitted = _fitted(members, sizes, SHARD_MOST // 2).select("shard", "c")
    types = "shard string, node long, n long, v array<double>, earlier array<string>"
    placed = members.join(fitted, "shard").select("shard", "node", "n", "v", "earlier", "c")
    placed = stored(placed.mapInPandas(nearest, f"{types}, near long"), "placed")
    counts = placed.groupBy("shard", "near", "earlier").agg(F.count(F.lit(1)).alias("size"))
    counts = stored(counts, "block-sizes").select(
        "shard", "near", F.col("earlier").alias("sign"), "size"
    )
    part = F.pmod(F.xxhash64("node"), F.ceil(F.col("size") / SHARD_MOST))
    name = F.concat_ws("/", "shard", "near", F.concat_ws(",", "earlier"), part)
    same = ["shard", "near"]
    joined = placed.join(counts, same).where(F.col("earlier") == F.col("sign"))
    return joined.select("shard", "node", "n", "v", "earlier", name.alias("block"))


def _outline(block: pd.DataFrame) -> pd.DataFrame:
    """One row for a block: its mean direction, the radius about it, and what it counts."""
    x = _matrix(block["v"])
    c = x.sum(0)
    c = c / np.sqrt(c @ c) if c @ c > 1e-24 else x[0]
    radius = float(np.arccos(np.clip((x @ c).min(), -1, 1)))
    return pd.DataFrame(
        {"shard": block["shard"].iloc[:1], "block": block["block"].iloc[:1], "c": [c],
         "earlier": block["earlier"].iloc[:1], "radius": radius, "copies": int(block["n"].sum()),
         "first": int(block["node"].min())}
    )


def _met(pair: pd.DataFrame) -> pd.DataFrame:
    """Rows (node, links, near) of the links between two blocks, or inside one, by comparing all."""
    a, b = pair[pair["side"] == 0], pair[pair["side"] == 1]
    if inside := not len(b):
        b = a
    x, y = _matrix(a["v"]), _matrix(b["v"])
    node_a, node_b = a["node"].to_numpy(np.int64), b["node"].to_numpy(np.int64)
    n_a, n_b = a["n"].to_numpy(np.int64), b["n"].to_numpy(np.int64)
    linked = np.empty((len(x), len(y)), bool)
    for at in range(0, len(x), 512):
        linked[at : at + 512] = x[at : at + 512] @ y.T >= COSINE
    if inside:
        linked &= linked.T
        np.fill_diagonal(linked, False)
    links_a = np.array([n_b[row].sum() for row in linked], np.int64)
    links_b = np.array([n_a[row].sum() for row in linked.T], np.int64)
    # Each linked member takes the smallest node of its component inside the pair.
    far = np.iinfo(np.int64).max
    top_a, top_b = node_a.copy(), node_b.copy()
    changed = True
    while changed:
        before = top_a.sum(), top_b.sum()
        for i in range(0, len(x), 512):
            met = np.where(linked[i : i + 512], top_b[None, :], far).min(1)
            top_a[i : i + 512] = np.minimum(top_a[i : i + 512], met)
        for i in range(0, len(y), 512):
            met = np.where(linked[:, i : i + 512], top_a[:, None], far).min(0)
            top_b[i : i + 512] = np.minimum(top_b[i : i + 512], met)
        changed = before != (top_a.sum(), top_b.sum())
    out = pd.DataFrame({"node": node_a, "links": links_a, "near": top_a})
    if not inside:
        other = pd.DataFrame({"node": node_b, "links": links_b, "near": top_b})
        out = pd.concat([out, other], ignore_index=True)
    return out[out["links"] > 0]


def _exactly(members: DataFrame) -> DataFrame:
    """(node, links, near) of all links inside each shard of (shard, node, n, v, earlier).

    Pairs that a shard in `earlier` holds too are left to it. Two blocks whose centres
    and radii rule links out don't meet, those in which all must be linked are counted
    without their vectors, any other two meet in a task.
    """
    blocks = stored(_blocks(members), "blocks")
    outlines = stored(
        blocks.groupBy("block").applyInPandas(
            _outline,
            "shard string, block string, c array<double>, earlier array<string>,"
            " radius double, copies long, first long",
        ),
        "outlines",
    )
    a, b = (
        outlines.select("shard", *(F.col(c).alias(f"{c}_{s}") for c in outlines.columns[1:]))
        for s in "ab"
    )

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                p, q = np.stack(batch.pop("c_a")), np.stack(batch.pop("c_b"))
                angle = np.arccos(np.clip(np.einsum("nd,nd->n", p, q), -1, 1))
                angle[batch["block_a"] == batch["block_b"]] = 0
                radii = (batch["radius_a"] + batch["radius_b"]).to_numpy()
                batch["every"] = angle + radii <= ANGLE - 1e-6
                yield batch[angle - radii <= ANGLE + 1e-6].drop(columns=["radius_a", "radius_b"])

    pairs = a.join(b, "shard").where("block_a <= block_b AND NOT arrays_overlap(earlier_a, earlier_b)")
    ends = [f"{c}_{s}" for c in ("block", "copies", "first", "c", "radius") for s in "ab"]
    types = "block_a string, block_b string, copies_a long, copies_b long, first_a long, first_b long"
    pairs = stored(pairs.select(ends).mapInPandas(judge, f"{types}, every boolean"), "block-pairs")
    other = pairs.where("block_a != block_b")
    every = pairs.where("every").select(
        F.col("block_a").alias("block"), F.col("copies_b").alias("copies"), F.col("first_b").alias("near"),
        (F.col("block_a") == F.col("block_b")).alias("own"),
    ).union(other.where("every").select("block_b", "copies_a", "first_a", F.lit(False)))
    sums = every.groupBy("block").agg(
        F.sum("copies").alias("copies"), F.max("own").alias("own"), F.collect_set("near").alias("nears")
    )
    counted = blocks.join(sums, "block").select(
        "node", (F.col("copies") - F.when(F.col("own"), F.col("n")).otherwise(0)).alias("links"),
        F.array_min("nears").alias("near"), "block", "nears",
    )
    # A whole block is tied to the first node of each block by one of its own members.
    firsts = outlines.select(F.col("block").alias("of"), F.col("first").alias("head"))
    heads = counted.join(firsts, (F.col("block") == F.col("of")) & (F.col("node") == F.col("head")))
    ties = heads.select("node", F.lit(0).cast("long").alias("links"), F.explode("nears").alias("near"))
    some = pairs.where("NOT every")
    sides = some.select(
        F.col("block_a").alias("block"), F.lit(0).alias("side"), "block_a", "block_b"
    ).union(
        some.where("block_a != block_b").select("block_b", F.lit(1), "block_a", "block_b")
    )
    meeting = blocks.join(sides, "block").select("block_a", "block_b", "side", "node", "n", "v")
    met = meeting.groupBy("block_a", "block_b").applyInPandas(
        _met, "node long, links long, near long"
    )
    return counted.select("node", "links", "near").union(ties).union(met)


def _labelled(ties: DataFrame) -> DataFrame:
    """(node, component) of every node of `ties` (node, near)."""
    return stored(connected_components(ties, "node", "near"), "components")


def _summed(labels: DataFrame, counts: DataFrame) -> DataFrame:
    """(node, links, component) of every node that has a link."""
    links = counts.groupBy("node").agg(F.sum("links").alias("links"))
    joined = labels.join(links, "node", "left")
    return stored(joined.select("node", F.coalesce("links", F.lit(0)).alias("links"), "component"), "found")


def _all_links(nodes: DataFrame) -> DataFrame:
    """(node, links, component) of every node with a link, from one shard searched exactly."""
    none = F.array().cast("array<string>")
    one = nodes.select(F.lit(WHOLE).alias("shard"), "*", none.alias("earlier"))
    exact = stored(_exactly(one), "exact")
    return _summed(_labelled(exact), exact)


def _brute_force(nodes: DataFrame, size: int) -> DataFrame:
    """(node, true_links) of about `size` nodes drawn by hash, counted against all nodes.

    The drawn vectors are the queries, sent to every task: `size` bounds what is sent.
    """
    total = max(nodes.count(), 1)
    place = F.pmod(F.xxhash64("node", F.lit(7)), F.lit(1 << 30)) / (1 << 30)
    drawn = nodes.where(place < size / total).toPandas()  # about `size` rows

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = drawn["node"].to_numpy()
        total = np.zeros(len(own), np.int64)
        parts = [slice(at, at + DRAWN_AT_ONCE) for at in range(0, len(own), DRAWN_AT_ONCE)]
        q = _matrix(drawn["v"]) if len(drawn) else None
        for batch in batches:
            y = _matrix(batch["v"]) if len(batch) else None
            for part in parts if len(batch) else []:
                other = own[part, None] != batch["node"].to_numpy()
                total[part] += ((q[part] @ y.T >= COSINE) & other) @ batch["n"].to_numpy(np.int64)
        yield pd.DataFrame({"node": own, "found": total})

    counted = nodes.mapInPandas(count, "node long, found long")
    return counted.groupBy("node").agg(F.sum("found").alias("true_links"))


def audited(nodes: DataFrame) -> DataFrame:
    """(node, true_links) of drawn nodes, of which LINKED have a link if any draw holds so many.

    A draw of too few linked nodes is followed by one four times as large, up to all
    nodes or AUDIT_MOST of them. So where no drawn node is linked, none of all nodes is,
    or fewer than about three in AUDIT_MOST are.
    """
    total, size = nodes.count(), AUDIT
    while True:
        audit = stored(_brute_force(nodes, size), "audit")
        if size >= min(total, AUDIT_MOST) or audit.where("true_links > 0").count() >= LINKED:
            return audit
        size = min(4 * size, AUDIT_MOST)


def recall(links: DataFrame, audit: DataFrame) -> float:
    """Share of the audited nodes' true links that `links` (node, links) holds; 1 if none.

    The lower of the share of all links and of the mean share of a linked node, so that
    neither one large group nor many small ones hide what the others lose.
    """
    found = F.coalesce("links", F.lit(0))
    row = (
        audit.where("true_links > 0")
        .join(links, "node", "left")
        .agg((F.sum(found) / F.sum("true_links")).alias("pooled"),
             F.avg(found / F.col("true_links")).alias("mean"))
        .first()
    )
    return 1.0 if row["mean"] is None else min(row["pooled"], row["mean"])


def _linked(nodes: DataFrame, overlap: int) -> DataFrame:
    """(node, links, component) of the linked nodes, from the graph over `overlap` shards a node."""
    every = stored(shards(nodes, overlap), "shards")
    is_whole = F.col("shard").startswith(WHOLE)
    members, whole = every.where(~is_whole), every.where(is_whole)
    graph = members.groupBy("shard").applyInPandas(_edges, "node long, near long")
    lists = graph.distinct().groupBy("node").agg(F.collect_list("near").alias("nears"))
    none = F.array().cast("array<bigint>")
    joined = members.join(lists, "node", "left").withColumn("nears", F.coalesce("nears", none))
    ties = stored(joined.groupBy("shard").applyInPandas(_search, "node long, near long"), "ties")
    of = every.groupBy("node").agg(F.collect_list("shard").alias("shards"))
    exact = None
    if not whole.isEmpty():
        before = F.filter("shards", lambda s: s.startswith(WHOLE) & (s < F.col("shard")))
        held = whole.join(of, "node").withColumn("earlier", F.sort_array(before))
        exact = stored(_exactly(held.select("shard", "node", "n", "v", "earlier")), "exact")
        ties = ties.union(exact.select("node", "near"))
    labels = _labelled(ties)
    in_components = members.join(labels, "node").join(of, "node")
    counts = in_components.groupBy("shard").applyInPandas(_counted, "node long, links long")
    return _summed(labels, counts.union(exact.select("node", "links")) if exact else counts)


def near_duplicates(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """(id, n_links, component_id, kept) for every row of `vectors`; ids are whole numbers.

    Links are pairs of cosine >= COSINE, verified in double precision; `component_id` is
    the smallest id reachable by them. Equal vectors are one node with a count. Nodes
    are dealt to overlapping shards of nearest centroids; each shard builds a pruned
    graph, the adjacency lists of all shards are united, and each shard searches from
    its medoid for its members' links. What it finds ties its members into components;
    then each shard compares its members of a component with one another and counts, so
    no pair is given out and no link that one end found is missing at the other. The
    links of drawn nodes, AUDIT and more of them until LINKED have a link, are counted by
    brute force; below a recall of RECALL the graph is built again over twice as many
    shards a node, and at FANOUT all nodes are searched exactly.
    A crowd of more than SHARD_MOST vectors that link among themselves isn't split: its
    links are counted exactly, in pairs of blocks.

    Vectors that are null, empty, zero or hold null or non-finite parts link with
    nothing, nor do vectors of different lengths with each other. Rows that repeat an
    id are rows of their own: each links with its copies. A row with a null id links as
    any other and is never the smallest of others. Other columns are ignored; an empty
    table gives an empty one.
    """
    rows = vectors.select(
        F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v")
    )
    rows = stored(rows.withColumn("row", F.monotonically_increasing_id()), "vectors")
    # Nodes are numbered by their first row; ids come back at the end.
    copies = valid_vectors(rows).groupBy("v").agg(
        F.min("row").alias("node"), F.count(F.lit(1)).alias("n"), F.min("id").alias("first_id")
    )
    copies = stored(copies, "nodes")
    found_parts = []
    for (length,) in copies.select(F.size("v")).distinct().collect():  # one row a length
        nodes = copies.where(F.size("v") == length).select("node", "n", "v")
        audit = audited(nodes)
        overlap = OVERLAP
        found = _linked(nodes, overlap)
        while recall(found, audit) < RECALL:
            overlap *= 2
            found = _linked(nodes, overlap) if overlap < FANOUT else _all_links(nodes)
            if overlap >= FANOUT:
                break
        found_parts.append(found)
    if not found_parts:
        return rows.select(
            F.col("id").alias(id_col), F.lit(0).cast("long").alias("n_links"),
            F.col("id").alias("component_id"), F.lit(True).alias("kept"),
        )
    found = found_parts[0]
    for part in found_parts[1:]:
        found = found.union(part)
    placed = copies.join(found, "node", "left").select(
        "v", "n", "first_id", "links", F.coalesce("component", "node").alias("component")
    )
    firsts = placed.groupBy("component").agg(F.min("first_id").alias("component_id"))
    result = placed.join(firsts, "component")
    result = result.select(
        F.col("v").alias("_v"), "component_id",
        (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
    )
    component = F.coalesce("component_id", F.col("id"))
    return rows.join(result, F.col("v") == F.col("_v"), "left").select(
        F.col("id").alias(id_col),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        component.alias("component_id"),
        component.eqNullSafe(F.col("id")).alias("kept"),
    )
