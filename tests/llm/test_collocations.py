import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from homestats.llm import collocations as C
from homestats.llm.catalog import ORACLES

DROP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, top, least, longest=5, share=100):
    counts, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(DROP)):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for m in range(1, longest + 1):
                for i in range(len(words) - m + 1):
                    counts[lang, tuple(words[i : i + m])] += 1
    frequent = {k: a for k, a in counts.items() if a >= least}
    out = {}
    for (lang, p), a in frequent.items():
        if len(p) < 2:
            continue
        inside = [
            f for (x, q), f in frequent.items() if x == lang and len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
        ]
        if any(100 * f >= share * a for f in inside):
            continue
        cuts = [(1000 * a * n[lang] // (counts[lang, p[:k]] * counts[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), counts[lang, p[:k]], counts[lang, p[k:]]))
    return sorted(
        (lang, i + 1, p.decode(), -a, l, r, n[lang], -s) for lang, rows in out.items() for i, (s, a, p, l, r) in enumerate(sorted(rows)[:top])
    )


def found(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def corpus(seed, n=120):
    r = random.Random(seed)
    rows = []
    for _ in range(n):
        lang = r.choice(["en", "en", "en", "fr", "de", None, ""])
        words = [f"w{min(int(r.expovariate(0.09)), 60)}" for _ in range(r.randint(0, 40))]
        if r.random() < 0.4:
            at = r.randint(0, len(words))
            words[at:at] = r.choice(["new York city", "a B c d E f", "ÉTÉ ça là", "x x x x x x x"]).split(" ")
        text = "".join(w + r.choice([" ", " ", " ", "  ", "\t", ", ", ".", "\n", "\x0b", " !", "\xa0"]) for w in words)
        rows.append((lang, text))
    return rows


@pytest.mark.parametrize(("seed", "top", "least", "first", "longest"), [(1, 8, 4, None, 5), (3, 1000, 5, 5, 3), (5, 12, 4, 9, 5)])
def test_equals_brute_force_in_waves(spark, seed, top, least, first, longest):
    rows = corpus(seed)
    rows += [rows[0], rows[0], ("en", None), (None, ""), ("fr", " \t\n"), ("xx", "only once here"), (None, "z" * 9000 + " " + "q " * 400)]
    df = spark.createDataFrame([(x, t, 1, "n", 2.0) for x, t in rows], "lang string, text string, n int, phrase string, total double").repartition(3)
    got = found(C.collocations(df, top, least, longest, first=first))
    want = brute(rows, top, least, longest)
    assert got == want and len(want) > 4


def test_a_language_is_settled_before_all_words_are_expanded(spark, monkeypatch):
    r = random.Random(7)
    lines = ["rare%d pair%d" % (i, i) for i in range(12) for _ in range(6)] * 1
    lines += [" ".join(r.choices(["the", "of", "and", "to"], k=12)) for _ in range(200)]
    rows = [("en", x) for x in lines]
    passes = []
    whole = C._pass
    monkeypatch.setattr(C, "_pass", lambda *a: (passes.append(1), whole(*a))[1])
    df = spark.createDataFrame(rows, "lang string, text string")
    got = found(C.collocations(df, 5, 5, first=10))
    assert got == brute(rows, 5, 5) and all(x[2].startswith("rare") for x in got)
    assert len(passes) <= 6  # one wave


@pytest.mark.parametrize("share", [100, 50])
def test_dropped_inside_longer_ones(spark, share):
    rows = [("en", "a b c d e f g")] * 6 + [("en", "b c d")] * 3 + [("en", "a b")] * 6 + [("en", "a a a a a a")]
    assert found(C.collocations(spark.createDataFrame(rows, "lang string, text string"), 50, 4, share=share)) == brute(rows, 50, 4, share=share)


def test_empty_and_rare(spark, empty_docs):
    out = C.collocations(empty_docs)
    assert out.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"] and out.collect() == []
    assert C.collocations(spark.createDataFrame([("en", "too few words")], "lang string, text string")).collect() == []


def test_filters_that_let_everything_through_change_nothing(spark, monkeypatch):
    rows = corpus(9, 60)
    df = spark.createDataFrame(rows, "lang string, text string")
    monkeypatch.setattr(C, "bit_filter", lambda phrases: C.BitFilter(np.full(4, 2**64 - 1, np.uint64)))
    assert found(C.collocations(df, 6, 4, first=6)) == brute(rows, 6, 4)


def test_hashes_of_phrases_are_those_of_the_corpus():
    words = C.Words(pa.array(["Un DEUX trois", "deux trois"]), pa.array(["fr", None]))
    for m in (1, 2, 3):
        want = C.phrase_hashes(pa.array(["fr"]), pa.array([" ".join(["un", "deux", "trois"][:m])]))
        assert words.hashes(m)[0] == want[0]
    assert words.hashes(2)[3] == C.phrase_hashes(pa.array(["und"]), pa.array(["deux trois"]))[0]
    assert words.hashes(2)[3] != words.hashes(2)[1]


def test_scores_are_exact_beyond_64_bits(spark):
    a, n, l, r = 10**13 + 7, 10**15 + 3, 10**13 + 9, 10**13 + 11  # noqa: E741
    c = spark.createDataFrame([("en", "x y", a, n)], "lang string, phrase string, a long, n long")
    counts = spark.createDataFrame([("en", "x", l), ("en", "y", r)], "lang string, phrase string, n long")
    row = C._scored(c, counts, 100).first()
    assert row["score"] == 1000 * a * n // (l * r)


def test_bounds_hold_for_every_phrase():
    for seed in range(3):
        rows = corpus(seed + 20)
        for lang, _, phrase, a, _, _, n, score in brute(rows, 10**6, 3):
            words = Counter(w for x, t in rows if (x if x is not None else "und") == lang for p in re.split("[.,;:!?\n-\r]", t.translate(DROP)) for w in re.findall("[^ \t]+", p))
            assert score <= 1000 * n // max(words[phrase.split(" ")[0]], words[phrase.split(" ")[-1]]), (phrase, a)


def test_query_has_sql():
    assert "op13_collocations" in ORACLES and F is not None


def test_runs_hold_frequent_words_that_have_a_neighbour():
    words = C.Words(pa.array(["a b rare c d. a. b c", None, "a rare b", "d e f"]), pa.array(["en", "en", None, "en"]))
    rare = C.phrase_hashes(pa.array(["en", "und"]), pa.array(["rare", "rare"]))
    rows = words.runs(lambda hashes: ~np.isin(hashes, rare))
    want = [C.phrase_hashes(pa.array(["en"] * len(r)), pa.array(r)).tolist() + [0] for r in (["a", "b"], ["c", "d"], ["b", "c"], ["d", "e", "f"])]
    assert rows.flatten().to_numpy().view(np.uint64).tolist() == sum(want, [])
    runs = C.Runs(rows)
    pairs = C.phrase_hashes(pa.array(["en"] * 5), pa.array(["a b", "c d", "b c", "d e", "e f"]))
    assert runs.hashes(2)[runs.whole(2)].tolist() == pairs.tolist()


def test_words_of_equal_hash_get_another_salt(spark, monkeypatch):
    whole = C.text_hashes
    monkeypatch.setattr(C, "text_hashes", lambda words, salt=0: whole(words, salt) if salt else np.full(len(words), 5, np.uint64))
    rows = [("en", "one two three")] * 4 + [("en", "two one")] * 3 + [("fr", "one two")] * 4
    assert found(C.collocations(spark.createDataFrame(rows, "lang string, text string"), 9, 3)) == brute(rows, 9, 3)


def test_a_task_sums_its_counts(spark, monkeypatch):
    """Phrases are counted a block of rows at a time; the blocks' counts of a task are one row a phrase."""
    monkeypatch.setattr(C, "ROWS", 1)
    rows = C.Words(pa.array(["a b c. " * 200, "b c d. " * 200]), pa.array(["en", "en"])).runs(lambda hashes: np.ones(len(hashes), bool))
    counts = [some.counted(2, np.flatnonzero(some.whole(2))) for some in C._some_runs([pa.RecordBatch.from_arrays([rows], names=["codes"])])]
    assert len(counts) > 2
    got = C.summed(counts)
    pairs = C.phrase_hashes(pa.array(["en"] * 4), pa.array(list("abcd")))
    want = {(int(pairs[i].view(np.int64)), int(pairs[i + 1].view(np.int64))): n for i, n in ((0, 200), (1, 400), (2, 200))}
    assert got.num_rows == 3 and {tuple(c): n for c, n in zip(got["codes"].to_pylist(), got["n"].to_pylist(), strict=True)} == want
