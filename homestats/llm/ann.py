"""Approximate nearest neighbours by learned partitions.

A bounded sample of the vectors gives a neighbour graph, which is cut into balanced
partitions with few edges between them; a small classifier learns which partition
a vector's neighbours lie in. Every vector is indexed in its most probable
partition. A query is routed to its most probable partitions, until their
probabilities sum to ``mass``, and reranked there against all their vectors.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from homestats.llm.common import materialize


@dataclass(frozen=True)
class Settings:
    """Parameters; ``sample_rows`` bounds what the driver sees."""

    sample_rows: int = 8192
    parts: int = 32
    neighbours: int = 10
    slack: float = 1.1  # a partition holds at most this many times its even share of the sample
    hidden: int = 64
    epochs: int = 16
    mass: float = 0.96
    least_probes: int = 3
    block_rows: int = 16_384  # vectors of a partition that one task holds at a time
    block_queries: int = 4_096
    seed: int = 7


# ---- learning, on the sample ----


def neighbour_graph(vectors: np.ndarray, k: int) -> np.ndarray:
    """Each vector's ``k`` nearest by inner product, in blocks."""
    n = len(vectors)
    k = min(k, n - 1)
    out = np.empty((n, k), np.int64)
    for a in range(0, n, 512):
        scores = vectors[a : a + 512] @ vectors.T
        scores[np.arange(len(scores)), np.arange(a, a + len(scores))] = -np.inf
        out[a : a + 512] = np.argpartition(scores, n - k, axis=1)[:, n - k :] if k else out[a : a + 512]
    return out


def cut_graph(graph: np.ndarray, parts: int, slack: float, rounds: int = 20) -> np.ndarray:
    """A balanced partition of the graph with few edges cut.

    Regions grow to an even size by their strongest link to what is left; then nodes
    move to the partition that most of their neighbours are in, highest gain first,
    as long as that partition has room.
    """
    n = len(graph)
    links: list[list[int]] = [list(map(int, row)) for row in graph]
    for i, row in enumerate(graph):
        for j in row:
            links[j].append(i)
    part = np.full(n, -1, np.int64)
    size = -(-n // parts)
    nxt = 0
    for p in range(parts):
        pull: dict[int, int] = {}
        heap: list[tuple[int, int]] = []
        taken = 0
        while taken < size:
            node = -1
            while heap:
                strength, x = heapq.heappop(heap)
                if part[x] < 0 and pull.get(x) == -strength:
                    node = x
                    break
            if node < 0:
                while nxt < n and part[nxt] >= 0:
                    nxt += 1
                if nxt == n:
                    break
                node = nxt
            part[node] = p
            taken += 1
            for x in links[node]:
                if part[x] < 0:
                    pull[x] = pull.get(x, 0) + 1
                    heapq.heappush(heap, (-pull[x], x))
    most = max(1, int(slack * n / parts + 1))
    edges_from = np.repeat(np.arange(n), [len(x) for x in links])
    edges_to = np.array([y for x in links for y in x], np.int64)
    for _ in range(rounds):
        votes = np.zeros((n, parts))
        np.add.at(votes, (edges_from, part[edges_to]), 1)
        gains = votes - votes[np.arange(n), part][:, None]
        best = gains.argmax(1)
        sizes = np.bincount(part, minlength=parts)
        moved = 0
        for i in np.argsort(-gains[np.arange(n), best], kind="stable"):
            if gains[i, best[i]] <= 0:
                break
            if sizes[best[i]] < most:
                sizes[part[i]] -= 1
                sizes[best[i]] += 1
                part[i] = best[i]
                moved += 1
        if moved < n / 200:
            break
    return part


@dataclass(frozen=True)
class Router:
    """A classifier with one hidden layer: probabilities of partitions for vectors."""

    first: np.ndarray
    second: np.ndarray

    def probabilities(self, vectors: np.ndarray) -> np.ndarray:
        x = _scaled(vectors)
        h = np.maximum(np.concatenate([x, np.ones((len(x), 1))], 1) @ self.first, 0)
        z = np.concatenate([h, np.ones((len(h), 1))], 1) @ self.second
        z = np.exp(z - z.max(1, keepdims=True))
        return z / z.sum(1, keepdims=True)


def _scaled(vectors: np.ndarray) -> np.ndarray:
    """Vectors at length 8 (about one per component at 64), which the classifier sees."""
    biggest = np.abs(vectors).max(1, keepdims=True)
    v = vectors / np.where(biggest > 0, biggest, 1)
    return v * (8 / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-300))


def train_router(vectors: np.ndarray, graph: np.ndarray, part: np.ndarray, s: Settings) -> Router:
    """Fit to where each sample vector and its neighbours lie, by Adam on cross-entropy."""
    rng = np.random.default_rng(s.seed)
    n, dim = vectors.shape
    parts = int(part.max()) + 1
    goal = np.zeros((n, parts))
    np.add.at(goal, (np.arange(n), part), 1.0)
    if graph.shape[1]:
        np.add.at(goal, (np.repeat(np.arange(n), graph.shape[1]), part[graph].ravel()), 1.0)
    goal /= goal.sum(1, keepdims=True)
    x, goal = np.concatenate([_scaled(vectors), np.ones((n, 1))], 1).astype(np.float32), goal.astype(np.float32)
    shapes = ((dim + 1, s.hidden), (s.hidden + 1, parts))
    weights = [rng.normal(0, (c / shape[0]) ** 0.5, shape).astype(np.float32) for c, shape in zip((2, 1), shapes, strict=True)]
    moments = [[np.zeros_like(w), np.zeros_like(w)] for w in weights]
    step = 0
    for epoch in range(s.epochs):
        rate = np.float32(4e-3 * (1 - epoch / s.epochs) + 1e-4)
        order = rng.permutation(n)
        for a in range(0, n, 256):
            rows = order[a : a + 256]
            h = np.maximum(x[rows] @ weights[0], 0)
            h1 = np.concatenate([h, np.ones((len(h), 1), np.float32)], 1)
            z = h1 @ weights[1]
            z = np.exp(z - z.max(1, keepdims=True))
            d = (z / z.sum(1, keepdims=True) - goal[rows]) / len(rows)
            back = (d @ weights[1][:-1].T) * (h > 0)
            step += 1
            for w, m, g in zip(weights, moments, (x[rows].T @ back, h1.T @ d), strict=True):
                g = g + np.float32(1e-5) * w
                m[0] = np.float32(0.9) * m[0] + np.float32(0.1) * g
                m[1] = np.float32(0.999) * m[1] + np.float32(0.001) * g * g
                w -= rate * (m[0] / np.float32(1 - 0.9**step)) / (np.sqrt(m[1] / np.float32(1 - 0.999**step)) + np.float32(1e-8))
    return Router(*(w.astype(np.float64) for w in weights))


def learn(sample: np.ndarray, s: Settings) -> Router:
    """Graph, partitions and classifier from the sample, with fewer partitions for a small sample."""
    parts = max(1, min(s.parts, len(sample) // 64))
    unit = sample / np.maximum(np.linalg.norm(sample, axis=1, keepdims=True), 1e-300)
    graph = neighbour_graph(unit, s.neighbours)
    return train_router(sample, graph, cut_graph(graph, parts, s.slack), s)


# ---- indexing and search, on Spark ----


def _matrix(column) -> np.ndarray:
    """A list column without nulls, all of one length, as rows in double precision."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.empty((0, 0))


def probes(probabilities: np.ndarray, mass: float, least: int, sizes: np.ndarray | None = None, rows: int = 0) -> list[np.ndarray]:
    """Each row's partitions, most probable first, until they hold ``mass`` (at least ``least`` of them) and ``rows`` vectors."""
    order = np.argsort(-probabilities, axis=1, kind="stable")
    reached = np.cumsum(np.take_along_axis(probabilities, order, 1), 1)
    number = np.maximum((reached < mass).sum(1) + 1, least)
    if sizes is not None:
        number = np.maximum(number, (np.cumsum(sizes[order], 1) < rows).sum(1) + 1)
    return [row[:k] for row, k in zip(order, number, strict=True)]


def nearest_in_block(q_ids, queries, v_ids, vectors, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(row of the query, vec_id, score)`` of each query's ``k`` nearest in a block of vectors.

    Equal vectors beyond those of the ``k + 1`` smallest ids, or beyond ``k`` rows of an id,
    can't be among them: a query's own rows, however many, are those of one id. A
    matrix product finds all rows within rounding of the k-th score; those are
    scored again in a fixed order of summation, so equal vectors score equally.
    """
    bytewise = np.ascontiguousarray(vectors).view([("", "V", vectors.shape[1] * 8)]).ravel()
    _, same = np.unique(bytewise, return_inverse=True)
    order = np.lexsort((v_ids, same))
    first = np.concatenate(([True], same[order][1:] != same[order][:-1]))
    start = np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))
    new = first | np.concatenate(([True], v_ids[order][1:] != v_ids[order][:-1]))
    number = np.cumsum(new)  # of the id, over all vectors
    row = np.arange(len(order)) - np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
    keep = order[(number - number[start] <= k) & (row < k)]
    v_ids, vectors = v_ids[keep], vectors[keep]
    longest = np.linalg.norm(vectors, axis=1).max()
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for a in range(0, len(queries), 256):
        part = queries[a : a + 256]
        scores = part @ vectors.T
        own = q_ids[a : a + 256, None] == v_ids[None, :]
        scores[own] = -np.inf
        room = 1e-12 * longest * np.linalg.norm(part, axis=1) * vectors.shape[1]
        if len(v_ids) > k:
            kth = np.partition(scores, len(v_ids) - k, axis=1)[:, len(v_ids) - k]
            q, v = np.nonzero((scores >= (kth - room)[:, None]) & ~own)
        else:
            q, v = np.nonzero(~own)
        exact = (part[q] * vectors[v]).sum(1)
        order = np.lexsort((v_ids[v], -exact, q))
        q, v, exact = q[order], v[order], exact[order]
        start = np.searchsorted(q, q, side="left")
        top = np.arange(len(q)) - start < k
        found.append((a + q[top], v_ids[v[top]], exact[top]))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))


def usable(rows: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """``(vec_id, vector)`` of the rows that take part: with an id, and a finite vector that isn't zero."""
    v = F.col("vector")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists(v, lambda x: x != 0)
    return rows.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("vector")).filter(
        F.col("vec_id").isNotNull() & v.isNotNull() & fine
    )


def search(
    rows: DataFrame, is_query, k: int = 20, settings: Settings = Settings(), vec_id: str = "vec_id", embedding: str = "embedding"
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` nearest found of each row that ``is_query`` selects.

    ``is_query`` maps the id column to a condition. Nearness is the largest inner
    product of the original vectors in double precision, ties to the smaller id; a
    query's own rows (those with its id) aren't candidates. Vectors that are null,
    zero, empty, or hold a null or non-finite component take no part, nor do rows
    without an id or with another number of components than most rows have (of equally
    frequent numbers, the smaller). Repeated candidate rows count separately; repeated
    queries once. With no usable rows the result is empty.
    """
    spark = rows.sparkSession
    schema = "query_id long, rank int, vec_id long, score double"
    valid = usable(rows, vec_id, embedding)
    dims = valid.groupBy(F.size("vector").alias("dim")).count().orderBy(F.desc("count"), "dim").limit(1).collect()
    if not dims:
        return spark.createDataFrame([], schema)
    valid = valid.filter(F.size("vector") == dims[0]["dim"])
    # the smallest hashes: the same bounded sample for any partitioning
    sample = valid.orderBy(F.xxhash64("vec_id"), "vec_id", "vector").limit(settings.sample_rows).select("vector").collect()
    router = learn(np.array([r["vector"] for r in sample]), settings)

    @F.arrow_udf(T.IntegerType())
    def home(vectors: pa.Array) -> pa.Array:
        if not len(vectors):
            return pa.array([], pa.int32())
        return pa.array(router.probabilities(_matrix(vectors)).argmax(1).astype(np.int32))

    index = materialize(valid.withColumn("part", home(F.col("vector"))), "ann-index")
    sizes = np.zeros(router.second.shape[1], np.int64)
    for r in index.groupBy("part").count().collect():  # at most settings.parts rows
        sizes[r["part"]] = r["count"]

    @F.arrow_udf(T.ArrayType(T.IntegerType()))
    def route(vectors: pa.Array) -> pa.Array:
        if not len(vectors):
            return pa.array([], pa.list_(pa.int32()))
        # ten times the results wanted are looked at, so k are found wherever there are as many
        found = probes(router.probabilities(_matrix(vectors)), settings.mass, settings.least_probes, sizes, 10 * k + 1)
        return pa.array([f.astype(np.int32) for f in found], pa.list_(pa.int32()))

    asked = index.filter(is_query(F.col("vec_id"))).dropDuplicates(["vec_id", "vector"])
    asked = materialize(asked.select(
        F.col("vec_id").alias("query_id"), F.col("vector").alias("query"), F.xxhash64("vector").alias("tag"),
        F.explode(route(F.col("vector"))).alias("part"),
    ), "ann-queries")
    # a partition of any size is searched block by block: at most settings.parts rows here
    counts = index.groupBy("part").agg(F.count(F.lit(1)).alias("rows")).join(
        asked.groupBy("part").agg(F.count(F.lit(1)).alias("queries")), "part"
    )
    blocks = counts.select(
        "part",
        F.ceil(F.col("rows") / settings.block_rows).cast("int").alias("row_blocks"),
        F.ceil(F.col("queries") / settings.block_queries).cast("int").alias("query_blocks"),
    )
    blocks = F.broadcast(spark.createDataFrame(blocks.collect(), "part int, row_blocks int, query_blocks int"))

    def dealt(side: DataFrame, by: tuple[str, str], own: str, other: str) -> DataFrame:
        mine = F.pmod(F.xxhash64(*by), F.col(f"{own}_blocks")).cast("int")
        all_others = F.explode(F.sequence(F.lit(0), F.col(f"{other}_blocks") - 1))
        return side.join(blocks, "part").withColumn(f"{own}_block", mine).withColumn(f"{other}_block", all_others).drop("row_blocks", "query_blocks")

    keys = ["part", "row_block", "query_block"]
    out = T.StructType([
        T.StructField("query_id", T.LongType()), T.StructField("tag", T.LongType()),
        T.StructField("vec_id", T.LongType()), T.StructField("score", T.DoubleType()),
    ])

    def nearest(queries: pa.Table, vectors: pa.Table) -> pa.Table:
        if not queries.num_rows or not vectors.num_rows:
            return pa.table({f.name: pa.array([], t) for f, t in zip(out, (pa.int64(), pa.int64(), pa.int64(), pa.float64()), strict=True)})
        q_ids, tags = queries["query_id"].to_numpy(), queries["tag"].to_numpy()
        row, ids, score = nearest_in_block(q_ids, _matrix(queries["query"]), vectors["vec_id"].to_numpy(), _matrix(vectors["vector"]), k)
        return pa.table({"query_id": q_ids[row], "tag": tags[row], "vec_id": ids, "score": score})

    left = dealt(asked, ("query_id", "query"), "query", "row").groupBy(*keys)
    right = dealt(index, ("vec_id", "vector"), "row", "query").groupBy(*keys)
    found = left.cogroup(right).applyInArrow(nearest, out)
    best = Window.partitionBy("query_id", "tag").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best).cast("int")).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
    )
