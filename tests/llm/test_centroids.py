import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from homestats.llm import centroids
from homestats.llm.centroids import VantageTree, cluster_vectors, squared_distances

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, k, rounds, dims, scale=64):
    kept = [(i, v) for i, v in rows if v is not None and len(v) == dims and all(x is not None and np.isfinite(x) for x in v)]
    kept = [(i, [int(np.floor(scale * float(np.float32(x)))) for x in v]) for i, v in kept]
    named = sorted((hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest(), v) for i, v in kept)
    cents = [v for _, v in named[:k]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), n) for n, c in enumerate(cents)) for _, v in kept]

    for _ in range(rounds):
        got = assign()
        for c in range(len(cents)):
            mine = [v for (_, v), (_, n) in zip(kept, got, strict=True) if n == c]
            if mine:
                cents[c] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    got = assign()
    sums = {c: sum(d for d, n in got if n == c) for c in range(len(cents))}
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cents]
    return sorted((repr(i), n, d, sums[n], sum(sums.values()), sha[n]) for (i, _), (d, n) in zip(kept, got, strict=True))


def found(df):
    return sorted((repr(r[0]), *r[1:]) for r in df.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256").collect())


@pytest.mark.parametrize("spread", [3, 50, 2**24])
@pytest.mark.parametrize("k", [1, 4, 5, 40, 300])
def test_tree_finds_the_nearest_and_the_smallest_of_equally_near_ones(k, spread):
    r = np.random.default_rng(k)
    c = r.integers(-spread, spread, (k, 3))
    c[k // 2 :: 7] = c[0]  # equal centroids
    x = np.concatenate([r.integers(-spread, spread, (400, 3)), c, (c[:1] + c[-1:]) // 2])
    want = ((x[:, None].astype(object) - c[None].astype(object)) ** 2).sum(2)
    number, distance = VantageTree(c).nearest(x)
    assert distance.tolist() == want.min(1).tolist()
    assert number.tolist() == [int(np.argmin(w)) for w in want]


def test_tree_skips_far_centroids():
    r = np.random.default_rng(0)
    c = np.concatenate([r.integers(0, 50, (200, 8)), r.integers(10_000, 10_050, (200, 8))])
    tree, seen = VantageTree(c), []
    visit = tree._visit
    tree._visit = lambda node, rows, *rest: (seen.append(len(rows) * len(node.centroids)), visit(node, rows, *rest))
    number, _ = tree.nearest(r.integers(0, 50, (300, 8)))
    assert (number < 200).all() and sum(seen) < 300 * 260


def test_distances_are_exact_for_large_integers():
    x, c = np.array([[2**29, -(2**29), 1]]), np.array([[-(2**29), 2**29, 0]])
    assert squared_distances(x, c).tolist() == [[2**61 + 1]]
    with pytest.raises(ValueError, match="64 bits"):
        squared_distances(x * 4, c)


@pytest.mark.parametrize("k", [3, 16, 500])
def test_equals_brute_force_with_awkward_vectors(spark, k):
    r = np.random.default_rng(3)
    rows = [(i, r.normal(size=4).astype(np.float32).tolist()) for i in range(120)]
    rows += [(200 + i, [0.25, -0.25, 0.5, 0.0]) for i in range(60)]  # ties
    rows += [(7, rows[7][1]), (7, rows[8][1]), (None, [9.0, 9.0, 9.0, -9.0]), (None, [1.0, 2.0, 3.0, 4.0]), (400, [1e5, -1e5, 0.0, 0.0])]
    odd = [(300, None), (301, []), (302, [None, 1.0, 1.0, 1.0]), (303, [float("nan"), 1.0, 1.0, 1.0]), (304, [float("inf")] * 4),
           (305, [float("-inf")] * 4), (306, [1.0, 2.0, 3.0]), (307, [1.0] * 5), (308, [-0.0] * 4)]
    rows += odd
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], SCHEMA).repartition(5)
    df = df.withColumn("cluster", F.lit("mine")).withColumn("v", F.lit(1)).withColumn("distance", F.lit(None).cast("string"))
    got = found(cluster_vectors(df, k, dims=4))
    assert got == brute(rows, k, 3, 4)


def test_empty_tables_and_no_vector_left(spark):
    empty = cluster_vectors(spark.createDataFrame([], SCHEMA))
    assert empty.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"] and not empty.collect()
    assert not cluster_vectors(spark.createDataFrame([(1, [1.0], 0)], SCHEMA)).collect()


def test_inertia_beyond_64_bits_is_null(spark):
    rows = [(i, [float((-1) ** i * 2**26)] * 2, 0) for i in range(32)]
    out = cluster_vectors(spark.createDataFrame(rows, SCHEMA), 1, rounds=1, dims=2, scale=8).collect()
    assert {r["inertia"] for r in out} == {None} and {r["cluster"] for r in out} == {0}
    assert all(r["distance"] == 2**59 for r in out)


def test_leaves_hold_few_centroids():
    tree = VantageTree(np.arange(400).reshape(-1, 2))
    assert all(len(n.centroids) <= centroids.LEAF_CENTROIDS for n in tree.nodes)
    assert sorted(i for n in tree.nodes for i in n.centroids.tolist()) == list(range(200))
