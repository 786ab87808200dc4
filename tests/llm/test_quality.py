import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from conftest_words import words
from pyspark.sql import functions as F

from homestats.llm import quality


def brute(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = Counter(zip(w, w[1:], w[2:], strict=False))
    covered = {j for i in range(len(w) - 2) if windows[tuple(w[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(covered)


def test_measures_equal_brute_force(awkward):
    import random

    r = random.Random(5)
    texts = [t for _, t, _ in awkward] + ["".join(r.choices("ab \n\t.#|É", k=r.randint(0, 60))) for _ in range(500)]
    got = quality.measure_batch(pa.array(texts, pa.string())).to_pylist()
    assert [tuple(g[m] for m in quality.MEASURES[:5]) for g in got] == [brute(t) for t in texts]


def bad_text(kind, i):
    w = words(120, 1000 + i).split()
    if kind == "symbols":
        return " ".join(x + "***" for x in w)
    if kind == "table":
        return " | ".join(w)
    return " ".join(x.upper() + "!!" for x in w)


@pytest.fixture(scope="module")
def corpus():
    good = [(i, words(100 + i % 50, i)) for i in range(300)]
    bad = [(1000 + i, bad_text(("symbols", "table", "loud")[i % 3], i)) for i in range(45)]
    return good, bad


def test_good_texts_stay_and_bad_ones_go(make_docs, corpus, awkward):
    good, bad = corpus
    short = [(5000 + i, t, s) for i, (_, t, s) in enumerate(awkward)]
    out = {r["doc_id"]: r for r in quality.assess(make_docs([*good, *bad, *short])).collect()}
    assert all(out[i]["kept"] for i, _ in good)
    assert not any(out[i]["kept"] for i, _ in bad)
    for i, t, _ in short:
        m = brute(t)
        assert out[i]["base_failed"] == (m[0] < 50 or 100 * m[4] > 50 * m[0])
        assert not (out[i]["base_failed"] and out[i]["kept"])


def test_filter_agrees_with_assessment(make_docs, corpus, awkward):
    good, bad = corpus
    docs = make_docs([*good[:200], *bad, *awkward]).withColumn("n_words", F.lit("mine")).withColumn("kept", F.lit("mine"))
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns and kept.filter("n_words <> 'mine'").count() == 0
    want = sorted(str(r["doc_id"]) for r in quality.assess(docs.select("doc_id", "text")).filter("kept").collect())
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == want


def test_empty_table(empty_docs):
    assert quality.assess(empty_docs).count() == 0
    assert quality.keep_good(empty_docs).count() == 0


def test_model_recovers_simulated_classes():
    """Held-out accuracy of the estimated posterior on votes with known classes and error rates."""
    rng = np.random.default_rng(0)
    n, m = 20_000, len(quality.RULES)
    good = rng.random(n) < 0.85
    kind = rng.integers(0, m // 2, n)
    votes = np.where(rng.random((n, m)) < 0.1, 0, 1)
    for i in range(m):
        hit = ~good & (kind == i // 2) & (rng.random(n) < 0.9)
        noise = rng.random(n) < 0.01
        votes[hit | noise, i] = -1
    patterns, counts = np.unique(votes[: n // 2], axis=0, return_counts=True)
    model = quality.fit_label_model(patterns, counts)
    joint = np.stack([
        s + sum(np.array(v[i])[votes[n // 2 :, i] + 1] for i in range(m)) for s, v in zip(model.shares, model.votes, strict=True)
    ], axis=1)
    said = joint[:, 0] >= np.log(np.exp(joint - joint.max(1, keepdims=True)).sum(1)) + joint.max(1) - np.log(2)
    accuracy, all_must_pass = (said == good[n // 2 :]).mean(), ((votes[n // 2 :] >= 0).all(1) == good[n // 2 :]).mean()
    assert accuracy > 0.93 and accuracy > all_must_pass
