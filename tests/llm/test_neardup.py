import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from conftest_words import words
from pyspark.sql import functions as F

from homestats.llm import neardup
from homestats.llm.components import connected_components


def shingles(text):
    import regex

    w = [x for x in (regex.sub(r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$", "", y) for y in regex.split(r"[\x20\x09-\x0D]+", (text or "").lower())) if x]
    return Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else Counter([tuple(w)] if w else [])


def similarity(a, b):
    union = sum((a | b).values())
    return sum((a & b).values()) / union if union else 0.0


def brute_classes(texts, least):
    sets = [shingles(t) for t in texts]
    up = list(range(len(texts)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            if (texts[i] or "") == (texts[j] or "") or similarity(sets[i], sets[j]) >= least:
                up[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(len(texts))]


def edited(text, share, seed):
    r = random.Random(seed)
    return " ".join(f"e{seed}{i}" if r.random() < share else w for i, w in enumerate(text.split()))


def test_signatures_agree_as_weighted_similarity():
    r = np.random.default_rng(0)
    pairs = []
    for t in range(40):
        n = int(r.integers(5, 300))
        elements = r.integers(0, 2**63, n).astype(np.uint64)
        x, y = r.integers(1, 9, n), r.integers(1, 9, n)
        drop = r.random(n) < 0.2
        bounds = np.array([0, n, n + int((~drop).sum())])
        s = neardup.dart_minhash(bounds, np.concatenate([elements, elements[~drop]]), np.concatenate([x, y[~drop]]), 400, seed=t + 1)
        y0 = np.where(drop, 0, y)
        pairs.append(((s[0] == s[1]).mean(), np.minimum(x, y0).sum() / np.maximum(x, y0).sum()))
    got, want = np.array(pairs).T
    assert abs((got - want).mean()) < 0.01 and np.abs(got - want).max() < 0.12


def test_signature_depends_on_the_set_alone():
    e, w = np.arange(1, 60, dtype=np.uint64) * np.uint64(977), np.arange(1, 60) % 5 + 1
    alone = neardup.dart_minhash(np.array([0, 59]), e, w, 120)
    p = np.random.default_rng(1).permutation(59)
    both = neardup.dart_minhash(np.array([0, 3, 3, 62]), np.concatenate([e[:3], e[p]]), np.concatenate([w[:3], w[p]]), 120)
    assert np.array_equal(both[2], alone[0]) and not both[1].any() and (both[0] != 0).all()


def test_matrix_similarities_are_exact():
    r = np.random.default_rng(5)
    sets = [np.unique(r.integers(0, 9000, int(n))).astype(np.uint64) for n in r.integers(0, 7000, 12)] + [np.empty(0, np.uint64)]
    got = neardup.similarities(sets)
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            assert i == j or got[i, j] == pytest.approx(neardup.jaccard(a, b))


@pytest.mark.parametrize("blocks", [neardup.BLOCK_NODES, 4])
def test_classes_equal_brute_force(make_docs, awkward, monkeypatch, blocks):
    monkeypatch.setattr(neardup, "BLOCK_NODES", blocks)
    base = [words(150, i) for i in range(12)]
    texts = list(base) + [base[0]] * 3 + [t.upper().replace("X", "X,") for t in base[1:3]]
    texts += [edited(b, share, 10 * k + j) for k, b in enumerate(base[3:9]) for j, share in enumerate((0.01, 0.02, 0.03, 0.05, 0.2))]
    texts += [edited(base[9], 0.02, 500 + i) for i in range(40)]  # a group whose links go by several steps
    texts += [words(4, 77), words(4, 77).upper(), words(3, 78), "...", "!!!"]
    texts += [t for _, t, _ in awkward]
    docs = make_docs(list(enumerate(texts))).withColumn("class_id", F.lit("mine")).withColumn("root", F.lit(0))
    got = {r["doc_id"]: r["class_id"] for r in neardup.near_duplicate_classes(docs).collect()}
    want = brute_classes(texts, 0.8)
    assert [got[i] for i in range(len(texts))] == want
    kept = neardup.keep_one_per_class(docs)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == sorted(set(want))


def test_missing_and_equal_ids(make_docs, awkward, empty_docs):
    docs = make_docs(awkward)
    classes = neardup.near_duplicate_classes(docs).collect()
    assert len(classes) == len(awkward)
    texts = [t or "" for _, t, _ in awkward]
    kept = [r["text"] or "" for r in neardup.keep_one_per_class(docs).collect()]
    assert sorted(kept) == sorted(set(texts))  # one row per text here, of repeated rows a single one
    assert neardup.near_duplicate_classes(empty_docs).count() == 0 and neardup.keep_one_per_class(empty_docs).count() == 0


def test_shuffled_texts_equal_broadcast(make_docs, monkeypatch):
    docs = make_docs([(i, edited(words(100, i // 4), 0.02, i)) for i in range(24)])
    plain = sorted(map(repr, neardup.near_duplicate_classes(docs).collect()))
    monkeypatch.setattr(neardup, "BROADCAST_NODES", 0)
    assert sorted(map(repr, neardup.near_duplicate_classes(docs).collect())) == plain


@pytest.mark.parametrize("edges", [[], [(1, 1)], [(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 30)], [(3, 1), (1, 3), (7, 5), (5, 9), (2, 9)]])
def test_components(spark, edges):
    got = {tuple(r) for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    up = {}

    def find(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = find(a), find(b)
            up[max(a, b)] = min(a, b)
    assert got == {(x, find(x)) for x in up}


def test_random_components(spark):
    r = random.Random(1)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(200)]
    test_components(spark, edges)


def test_elements_keep_repeated_shingles():
    bounds, s, w = neardup.weighted_shingles(pa.array(["a b c d e a b c d e", None, "a", "A, B!"]))
    assert np.diff(bounds).tolist() == [5, 0, 1, 1] and sorted(w[:5].tolist()) == [1, 1, 1, 1, 2]
