import numpy as np
import pytest
from pyspark.sql import functions as F

from homestats.llm import ann
from homestats.llm.catalog import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, is_query, k):
    dims = {}
    good = []
    for i, v, *_ in rows:
        if i is None or v is None or not v or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            continue
        good.append((i, np.array(v, np.float32).astype(float)))
        dims[len(v)] = dims.get(len(v), 0) + 1
    if not good:
        return {}
    dim = min(dims, key=lambda d: (-dims[d], d))
    good = [(i, v) for i, v in good if len(v) == dim]
    out = {}
    for q, v in good:
        if is_query(q):
            scored = sorted(((-float((v * w).sum()), j) for j, w in good if j != q))
            out[q] = [(j, -s) for s, j in scored[:k]]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    return out


def test_awkward_vectors_ties_and_repeats(spark):
    r = np.random.default_rng(0)
    rows = [(i, r.normal(size=4).astype(np.float32).tolist(), 0) for i in range(60)]
    rows += [(100 + i, [1.0, 0.0, 0.0, 0.0], 0) for i in range(40)]  # ties
    rows += [(200, None, 0), (205, [], 0), (210, [0.0] * 4, 0), (215, [None, 1.0, 1.0, 1.0], 0), (220, [float("nan"), 1.0, 1.0, 1.0], 0)]
    rows += [(225, [float("inf"), 1.0, 1.0, 1.0], 0), (230, [1.0, 2.0], 0), (None, [9.0] * 4, None), (7, rows[7][1], 0), (7, rows[7][1], None)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("score", F.lit("mine")).withColumn("part", F.lit(3))
    settings = ann.Settings(mass=1.1, least_probes=99, block_rows=16, block_queries=4)  # every partition: exact
    got = found(ann.search(df, lambda i: i % 5 == 0, 6, settings))
    want = brute(rows, lambda i: i % 5 == 0, 6)
    assert set(got) == set(want)
    for q, expected in want.items():
        assert [x[0] for x in got[q]] == list(range(1, len(expected) + 1))
        assert [x[1] for x in got[q]] == [j for j, _ in expected]
        assert np.allclose([x[2] for x in got[q]], [s for _, s in expected], atol=1e-12)


@pytest.mark.parametrize("rows", [[], [(1, None, 0)], [(0, [1.0, 2.0], 0)]])
def test_few_or_no_vectors(spark, rows):
    assert ann.search(spark.createDataFrame(rows, SCHEMA), lambda i: i % 5 == 0).count() == 0


def test_fewer_candidates_than_asked(spark):
    rows = [(i, [float(i + 1), 1.0], 0) for i in range(4)]
    got = found(ann.search(spark.createDataFrame(rows, SCHEMA), lambda i: i == 0, 20))
    assert [x[1] for x in got[0]] == [3, 2, 1]


def test_probing_goes_on_until_there_are_enough_rows():
    p = np.array([[0.9, 0.06, 0.04], [0.3, 0.3, 0.4]])
    assert [x.tolist() for x in ann.probes(p, 0.5, 1)] == [[0], [2, 0]]
    assert [x.tolist() for x in ann.probes(p, 0.5, 1, np.array([1, 2, 50]), 10)] == [[0, 1, 2], [2, 0]]
    assert [x.tolist() for x in ann.probes(p, 0.5, 1, np.array([1, 2, 3]), 10)] == [[0, 1, 2], [2, 0, 1]]


def test_block_search_equals_brute_force():
    r = np.random.default_rng(2)
    v = np.round(r.normal(size=(500, 6)), 1)
    v = np.concatenate([v, np.repeat(v[:3], 60, axis=0)])
    ids = r.permutation(len(v))
    q, got_ids, score = ann.nearest_in_block(ids[:50], v[:50], ids, v, 10)
    for i in range(50):
        s = (v[i] * v).sum(1)
        order = np.lexsort((ids, -s))
        want = [j for j in order if ids[j] != ids[i]][:10]
        assert got_ids[q == i].tolist() == ids[want].tolist() and np.array_equal(score[q == i], s[want])


def test_partitions_are_balanced_and_cut_few_edges():
    r = np.random.default_rng(3)
    centres = r.normal(size=(8, 16)) * 4
    v = np.concatenate([c + r.normal(size=(100, 16)) for c in centres])
    graph = ann.neighbour_graph(v / np.linalg.norm(v, axis=1, keepdims=True), 10)
    part = ann.cut_graph(graph, 8, 1.1)
    assert np.bincount(part, minlength=8).max() <= 112
    assert (part[graph] == part[:, None]).mean() > 0.9


def test_recall_of_the_query(spark):
    folder = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    got, want = found(QUERIES["op2_nearest_neighbours"](spark, folder)), brute(rows, lambda i: i % 20 == 0, 20)
    assert set(got) == set(want) and all(len(got[q]) == len(want[q]) for q in want)
    hits = sum(len({x[1] for x in got[q]} & {j for j, _ in want[q]}) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values()))


def test_many_own_rows_hide_no_equal_vectors_of_other_ids():
    k = 5
    v_ids = np.array([1] * 30 + [2] * 8 + list(range(3, 20)))
    vectors = np.ones((len(v_ids), 4))
    for q in (1, 2, 7):
        _, ids, score = ann.nearest_in_block(np.array([q]), np.ones((1, 4)), v_ids, vectors, k)
        assert ids.tolist() == [i for i in v_ids.tolist() if i != q][:k] and set(score) == {4.0}
