"""Centroid clustering with a vantage-point tree over the centroids.

Vectors are scaled to integers, so that distances, sums and ties are exact. Each round
builds a vantage-point tree over the centroids and broadcasts it (its size depends on
the number of centroids alone). A vector visits the tree's nodes best first, by
lower bounds of their distances, and stops when no node left can hold a centroid as near
as the nearest found, equally near ones included. Tasks return sums per cluster;
only these reach the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from homestats.llm.common import materialize

#: A leaf of the tree holds at most so many centroids.
LEAF_CENTROIDS = 4
#: Lower bounds of vectors and nodes in memory at a time.
FRONTIER_CELLS = 1 << 22
#: Bounds are lowered by this share of the lengths that they come from: more than all rounding errors.
MARGIN = 2.0**-48


@dataclass
class Node:
    """A vantage centroid with two subtrees, or a leaf's centroids by number."""

    centroids: np.ndarray
    #: Of each subtree: its node, and the least and the largest distance of its centroids to the vantage centroid.
    children: tuple[tuple[int, float, float], ...] = ()


def squared_distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows of integers, as long integers.

    Products of floating-point numbers are used where all intermediate results are integers
    below 2^53. Values whose distances may pass 64 bits are an error.
    """
    most = max(int(np.abs(x).max(initial=0)), int(np.abs(c).max(initial=0)))
    largest = x.shape[1] * (2 * most) ** 2
    if largest < 2**53:
        a, b = x.astype(np.float64), c.astype(np.float64)
        return ((a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * (a @ b.T)).astype(np.int64)
    if largest >= 2**63:
        raise ValueError(f"components of up to {most} after scaling have squared distances beyond 64 bits")
    return np.stack([((x - row) ** 2).sum(1) for row in c], axis=1) if len(c) else np.empty((len(x), 0), np.int64)


class VantageTree:
    """A vantage-point tree over centroids (rows of integers)."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids
        self.nodes: list[Node] = []
        if len(centroids):
            self._build(np.arange(len(centroids)))

    def _build(self, members: np.ndarray) -> int:
        at = len(self.nodes)
        if len(members) <= LEAF_CENTROIDS:
            self.nodes.append(Node(np.sort(members)))
            return at
        # the vantage centroid is the one whose distances to the others spread most
        among = squared_distances(self.centroids[members], self.centroids[members])
        lengths = np.sqrt(among.astype(np.float64))
        i = int(np.argmax(lengths.std(1)))
        self.nodes.append(Node(members[i : i + 1]))
        order = np.argsort(among[i], kind="stable")
        order = order[order != i]
        children = []
        for part in (order[: len(order) // 2], order[len(order) // 2 :]):
            child = self._build(members[part])
            children.append((child, float(lengths[i, part[0]]), float(lengths[i, part[-1]])))
        self.nodes[at].children = tuple(children)
        return at

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(number, squared distance)`` of each row's nearest centroid, of equally near ones the smallest number."""
        rows = max(1, FRONTIER_CELLS // max(1, len(self.nodes)))
        parts = [self._nearest(x[a : a + rows]) for a in range(0, len(x), rows)]
        if not parts:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])

    def _nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each vector has a frontier of its own; all vectors take a step at a time, those at one node together."""
        n = len(x)
        best = np.full(n, np.iinfo(np.int64).max)
        which = np.full(n, len(self.centroids), np.int64)
        frontier = np.full((n, len(self.nodes)), np.inf)
        frontier[:, 0] = 0
        active = np.arange(n)
        while len(active):
            node = frontier[active].argmin(1)
            bound = frontier[active, node]
            # inclusive: a node whose bound equals the radius may hold an equally near centroid of smaller number
            go = np.isfinite(bound) & (bound <= np.sqrt(best[active].astype(np.float64)))
            active, node, bound = active[go], node[go], bound[go]
            frontier[active, node] = np.inf
            for i in np.unique(node).tolist():
                here = node == i
                self._visit(self.nodes[i], active[here], bound[here], x, best, which, frontier)
        return which, best

    def _visit(self, node: Node, rows, bound, x, best, which, frontier) -> None:
        distances = squared_distances(x[rows], self.centroids[node.centroids])
        first = distances.argmin(1)  # numbers ascend, so of equal ones the first has the smallest
        found, number = distances[np.arange(len(rows)), first], node.centroids[first]
        better = (found < best[rows]) | (found == best[rows]) & (number < which[rows])
        best[rows[better]], which[rows[better]] = found[better], number[better]
        if not node.children:
            return
        length = np.sqrt(found.astype(np.float64))  # to the vantage centroid
        for child, least, most in node.children:
            low = np.maximum(length - most, least - length) - (length + most) * MARGIN
            frontier[rows, child] = np.maximum(bound, low)


# ---- Spark ----


def scaled_vectors(vectors: DataFrame, dims: int, scale: int, vec_id: str, embedding: str) -> DataFrame:
    """``(vec_id, v)``: vectors of ``dims`` finite components, each as ``floor(scale * x)``."""
    x = F.col(embedding)
    finite = F.forall(x, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c.cast("double")) < F.lit(float("inf"))), F.lit(False)))
    kept = vectors.filter((F.size(x) == dims) & finite)
    return kept.select(F.col(vec_id).alias("vec_id"), F.transform(x, lambda c: F.floor(F.lit(float(scale)) * c.cast("double"))).alias("v"))


def _rows(batch: pa.RecordBatch, dims: int) -> np.ndarray:
    return batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def _sums(kept: DataFrame, tree: VantageTree, dims: int) -> list:
    """``(cluster, at, n, total)``: of each cluster that has vectors, their number and the sums of their components."""
    spark = kept.sparkSession
    shared = spark.sparkContext.broadcast(tree)
    k = len(tree.centroids)

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = shared.value
        numbers, totals = np.zeros(k, np.int64), [[0] * dims for _ in range(k)]
        for batch in batches:
            x = _rows(batch, dims)
            cluster, _ = tree.nearest(x)
            numbers += np.bincount(cluster, minlength=k)
            for c in np.unique(cluster).tolist():
                part = x[cluster == c].sum(0)  # a batch's rows are too few for an overflow
                totals[c] = [a + int(b) for a, b in zip(totals[c], part.tolist(), strict=True)]
        some = [c for c in range(k) if numbers[c]]
        yield pa.RecordBatch.from_arrays([
            pa.array(np.repeat(np.array(some, np.int32), dims)), pa.array(np.tile(np.arange(dims, dtype=np.int32), len(some))),
            pa.array(np.repeat(numbers[some], dims), pa.int64()),
            pa.array([str(t) for c in some for t in totals[c]], pa.string()),
        ], names=["cluster", "at", "n", "total"])

    parts = kept.select("v").mapInArrow(add_up, "cluster int, at int, n long, total string")
    found = parts.groupBy("cluster", "at").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    rows = found.collect()  # centroids times components at most
    shared.unpersist()
    return rows


def cluster_vectors(
    vectors: DataFrame, k: int = 16, rounds: int = 3, dims: int = 64, scale: int = 64, seed: int = 1,
    vec_id: str = "vec_id", embedding: str = "embedding",
) -> DataFrame:
    """``(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256)`` of every vector that takes part.

    Vectors with ``dims`` components, none null or not finite, take part, as integers
    ``floor(scale * x)``; all others, null ones included, have no row. The first
    centroids are the ``k`` vectors with the smallest SHA-256 of ``seed:vec_id`` (a null id
    counts as an empty one; equal ids go by their vectors); fewer vectors, fewer
    centroids. Each round assigns every vector to the nearest centroid, of equally near ones to
    the smallest number, and moves centroids to the floor of their vectors' means; one
    without vectors stays. ``distance`` is squared; inertias are sums of it, null beyond 64 bits.
    Repeated rows are vectors of their own, other columns are ignored whatever their names, and an empty
    table gives no rows. Components whose squared distances may pass 64 bits (over
    about 10^8 after scaling) are an error, not a wrong result.
    """
    spark = vectors.sparkSession
    kept = materialize(scaled_vectors(vectors, dims, scale, vec_id, embedding), "vectors")
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    first = kept.select(F.sha2(name.cast("binary"), 256).alias("h"), "v").orderBy("h", "v").limit(k).collect()
    centroids = np.array([r["v"] for r in first], np.int64).reshape(-1, dims)
    for _ in range(rounds):
        moved = centroids.copy()
        for r in _sums(kept, VantageTree(centroids), dims):
            moved[r["cluster"], r["at"]] = int(r["total"]) // r["n"]
        centroids = moved

    shared = spark.sparkContext.broadcast(VantageTree(centroids))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = shared.value
        for batch in batches:
            cluster, distance = tree.nearest(_rows(batch, dims))
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(cluster.astype(np.int32)), pa.array(distance)], names=["vec_id", "cluster", "distance"])

    schema = T.StructType([kept.schema["vec_id"], T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())])
    assigned = materialize(kept.mapInArrow(assign, schema), "assigned")
    per_cluster = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()  # k rows at most
    totals = {r["cluster"]: int(r["total"]) for r in per_cluster}
    whole = sum(totals.values())

    def long_or_none(n: int) -> int | None:
        return n if n < 2**63 else None

    known = [
        (c, long_or_none(totals[c]), long_or_none(whole), hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest())
        for c in sorted(totals)
    ]
    clusters = spark.createDataFrame(known, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(clusters), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
