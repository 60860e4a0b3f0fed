"""Centroid clustering with a vantage-point tree over the centroids, in exact integers."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterwell.llm.tables import stored

CLUSTERS = 8
ROUNDS = 10
DIMENSIONS = 64
SEED = 3
# A component becomes floor(SCALE * x).
SCALE = 1024
# Largest component in size, with which squared distances and sums of 2^36 rows fit a long.
LIMIT = 1 << 26
# Centroids in a leaf of the tree.
LEAF = 2
# Cells of the table of bounds that one search holds at a time.
_CELLS = 1 << 22
# Share by which bounds are loosened, well over the error of a square root in doubles.
_SLACK = 1e-9


def squared(v: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of `v` to the vector `c`."""
    away = v - c
    return np.einsum("ij,ij->i", away, away)


@dataclass
class _Node:
    """A vantage point with its two children, or a leaf with its centroids."""

    # Least and greatest distance of the members from the parent's vantage point.
    low: float
    high: float
    vantage: int = -1
    children: tuple[int, ...] = ()
    leaf: list[int] = field(default_factory=list)


class VantageTree:
    """A vantage-point tree over integer centroids.

    An inner node's vantage point is its member farthest from their mean; the others
    go to a near and a far half by their distance from it. `nearest` is exact: bounds
    are loosened by more than their rounding error, a node whose bound equals the best
    distance is still visited, distances are compared as integers, and of equal ones
    the smaller centroid number wins.
    """

    def __init__(self, centroids: np.ndarray):
        self.centroids = np.asarray(centroids, np.int64)
        self.nodes: list[_Node] = []
        if len(self.centroids):
            self._grow(list(range(len(self.centroids))), 0.0, np.inf)

    def _grow(self, members: list[int], low: float, high: float) -> int:
        at = len(self.nodes)
        node = _Node(low, high)
        self.nodes.append(node)
        if len(members) <= LEAF:
            node.leaf = members
            return at
        points = self.centroids[members].astype(float)
        node.vantage = members[int(((points - points.mean(0)) ** 2).sum(1).argmax())]
        others = [m for m in members if m != node.vantage]
        far = np.sqrt(squared(self.centroids[others], self.centroids[node.vantage]))
        order = np.argsort(far, kind="stable")
        halves = [half for half in np.array_split(order, 2) if len(half)]
        node.children = tuple(
            self._grow([others[i] for i in half], far[half[0]], far[half[-1]]) for half in halves
        )
        return at

    def nearest(self, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(centroid number, squared distance) of each row of `v`."""
        step = max(1, _CELLS // max(len(self.nodes), 1))
        found = [self._search(v[i : i + step]) for i in range(0, len(v), step)]
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return tuple(np.concatenate(part) for part in zip(*found))

    def _search(self, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Best first for every vector: each step visits the open node with its least bound.

        `bound` holds each vector's queue, infinite where a node isn't open.
        """
        best = np.full(len(v), np.iinfo(np.int64).max)
        who = np.full(len(v), len(self.centroids))
        bound = np.full((len(v), len(self.nodes)), np.inf)
        bound[:, 0] = 0
        going = np.arange(len(v))

        def meet(rows: np.ndarray, centroid: int) -> np.ndarray:
            d = squared(v[rows], self.centroids[centroid])
            wins = (d < best[rows]) | ((d == best[rows]) & (centroid < who[rows]))
            best[rows[wins]], who[rows[wins]] = d[wins], centroid
            return d

        while len(going):
            at = bound[going].argmin(1)
            least = bound[going, at]
            inside = least <= np.sqrt(best[going])
            going, at, least = going[inside], at[inside], least[inside]
            bound[going, at] = np.inf
            for number in np.unique(at).tolist():
                node, here = self.nodes[number], at == number
                rows = going[here]
                for centroid in node.leaf:
                    meet(rows, centroid)
                if node.vantage < 0:
                    continue
                d = np.sqrt(meet(rows, node.vantage))
                for child in node.children:
                    low, high = self.nodes[child].low, self.nodes[child].high
                    apart = np.maximum(d - high, low - d) - _SLACK * (d + high)
                    bound[rows, child] = np.maximum(apart, least[here])
        return who, best


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims).astype(np.int64)


def _sums(tree: VantageTree, dims: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Per task: the number of vectors and the sums of components of every cluster."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(tree.centroids)
        n, total = np.zeros(k, np.int64), np.zeros((k, dims), np.int64)
        for batch in batches:
            v = _matrix(batch.column("v"), dims)
            who, _ = tree.nearest(v)
            n += np.bincount(who, minlength=k)
            np.add.at(total, who, v)
        own = np.flatnonzero(n)
        yield pa.record_batch(
            [
                pa.array(own.astype(np.int32)),
                pa.array(n[own]),
                pa.array(total[own].tolist(), pa.list_(pa.int64())),
            ],
            ["cluster", "n", "total"],
        )

    return run


def _assigned(tree: VantageTree, dims: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            who, best = tree.nearest(_matrix(batch.column("v"), dims))
            columns = [batch.column("id"), pa.array(who.astype(np.int32)), pa.array(best)]
            yield pa.record_batch(columns, ["id", "cluster", "distance"])

    return run


def integer_vectors(
    vectors: DataFrame, id_col: str, vec_col: str, dims: int = DIMENSIONS
) -> DataFrame:
    """(id, v array<int>) of the vectors with exactly `dims` components, all finite."""

    def scaled(x: Column) -> Column:
        return F.floor(F.lit(float(SCALE)) * x.cast("double"))

    def usable(x: Column) -> Column:
        value = x.cast("double")
        return value.isNotNull() & ~F.isnan(value) & (F.abs(value) != F.lit(float("inf")))

    own = vectors.select(F.col(id_col).alias("id"), F.col(vec_col).alias("x"))
    own = own.where((F.size("x") == dims) & F.forall("x", usable))
    too_large = F.exists("x", lambda x: F.abs(x.cast("double")) > LIMIT / SCALE)
    refused = F.raise_error(F.lit(f"a component is over {LIMIT // SCALE} in size"))
    return own.select(
        "id", F.when(too_large, refused).otherwise(F.transform("x", scaled)).cast("array<int>").alias("v")
    )


def _seeds(rows: DataFrame, k: int, seed: int) -> np.ndarray:
    ticket = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    first = rows.select("v", ticket.alias("ticket")).orderBy(F.asc_nulls_last("ticket"), "v").limit(k)
    return np.array([r.v for r in first.collect()], np.int64)


def _moved(rows: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round: exact floors of the means, empty clusters as they were."""
    dims = centroids.shape[1]
    schema = "cluster int, n long, total array<long>"
    sums = rows.select("v").mapInArrow(_sums(VantageTree(centroids), dims), schema)
    each = sums.select("cluster", "n", F.posexplode("total").alias("pos", "part"))
    totals = each.groupBy("cluster", "pos").agg(F.sum("n").alias("n"), F.sum("part").alias("total"))
    new = centroids.copy()
    for r in totals.collect():
        new[r.cluster, r.pos] = r.total // r.n
    return new


def cluster(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    k: int = CLUSTERS,
    rounds: int = ROUNDS,
    seed: int = SEED,
    dims: int = DIMENSIONS,
) -> DataFrame:
    """(id, cluster, distance, cluster_inertia, inertia, centroid_sha256), a row per usable vector.

    Usable are vectors with exactly `dims` components, none null or non-finite; a
    component becomes floor(SCALE * x). Components over LIMIT / SCALE in size, whose
    distances a long can't hold, end the job with an error. Seeds are the `k` vectors
    with the smallest hash of seed and id, fewer in a smaller table; a null id comes
    last there, and rows that repeat an id are told apart by their vectors. Every
    repeated row counts. Each round builds a vantage-point tree over the centroids and
    sends it to all tasks, which give back sums per cluster; ties go to the smaller
    number, an empty cluster keeps its centroid, and rounds that would change nothing
    any more are left out. Other columns are ignored, whatever their names; an empty
    table gives an empty one.

    The driver holds k x dims numbers. Vectors are written once and read each round,
    so a lost executor costs a re-read; no vector is ever shuffled.
    """
    rows = stored(integer_vectors(vectors, id_col, vec_col, dims), "vectors")
    centroids = _seeds(rows, k, seed)
    id_ddl = rows.schema["id"].dataType.simpleString()
    schema = f"id {id_ddl}, cluster int, distance long"
    if not len(centroids):
        none = rows.select("id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance"))
        return _with_sums(none, centroids, id_col)
    for _ in range(rounds):
        moved = _moved(rows, centroids)
        if (moved == centroids).all():
            break
        centroids = moved
    found = rows.mapInArrow(_assigned(VantageTree(centroids), dims), schema)
    return _with_sums(stored(found, "clusters"), centroids, id_col)


def _with_sums(found: DataFrame, centroids: np.ndarray, id_col: str) -> DataFrame:
    """`found` with the sums of its clusters, of which there are as many as centroids at most."""
    exact = F.sum(F.col("distance").cast("decimal(38,0)"))
    sums = {r.cluster: int(r.d) for r in found.groupBy("cluster").agg(exact.alias("d")).collect()}
    total = sum(sums.values())
    digests = [
        hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()
    ]
    table = [(c, d, total, digests[c]) for c, d in sorted(sums.items())]
    by_cluster = found.sparkSession.createDataFrame(
        table, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    )
    return found.join(F.broadcast(by_cluster), "cluster").select(
        F.col("id").alias(id_col), "cluster", "distance", "cluster_inertia", "inertia",
        "centroid_sha256",
    )


def _sql() -> str:
    """The same rows in DuckDB SQL: one pair of steps for each round."""
    steps = [
        f"""WITH raw AS (SELECT row_number() OVER () AS r, vec_id, embedding AS e FROM embeddings
             WHERE len(embedding) = {DIMENSIONS}
               AND len([x FOR x IN embedding IF x IS NOT NULL AND isfinite(x)]) = {DIMENSIONS}),
v AS MATERIALIZED (SELECT r, vec_id, unnest(range({DIMENSIONS})) AS i,
         CAST(floor({SCALE} * CAST(unnest(e) AS DOUBLE)) AS BIGINT) AS x FROM raw),
s AS (SELECT r, row_number() OVER (ORDER BY sha256('{SEED}:' || vec_id)) - 1 AS c FROM raw),
c0 AS MATERIALIZED (SELECT c, i, x FROM v JOIN s USING (r) WHERE c < {CLUSTERS})"""
    ]

    def nearest(n: int) -> str:
        return f"""a{n} AS MATERIALIZED (
  SELECT r, any_value(vec_id) AS vec_id, arg_min(c, (d, c)) AS c, min(d) AS d FROM (
    SELECT v.r, any_value(v.vec_id) AS vec_id, k.c, sum((v.x - k.x) * (v.x - k.x)) AS d
    FROM v JOIN c{n} k ON v.i = k.i GROUP BY v.r, k.c) GROUP BY r)"""

    for n in range(ROUNDS):
        steps.append(nearest(n))
        steps.append(f"""m{n} AS (SELECT a.c, v.i, sum(v.x) AS t, count(*) AS n FROM v JOIN a{n} a ON v.r = a.r
           GROUP BY a.c, v.i),
c{n + 1} AS MATERIALIZED (
  SELECT k.c, k.i, CAST(CASE WHEN m.n IS NULL THEN k.x ELSE (m.t - ((m.t % m.n) + m.n) % m.n) // m.n END
                        AS BIGINT) AS x
  FROM c{n} k LEFT JOIN m{n} m ON k.c = m.c AND k.i = m.i)""")
    steps.append(nearest(ROUNDS))
    return ",\n".join(steps) + f"""
SELECT vec_id, CAST(c AS INT) AS cluster, CAST(d AS BIGINT) AS distance,
       CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
       CAST(sum(d) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM a{ROUNDS} JOIN (SELECT c, sha256(string_agg(x, ',' ORDER BY i)) AS centroid_sha256
                     FROM c{ROUNDS} GROUP BY c) USING (c)
"""


SQL = _sql()
