import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from homestats.llm import linededup

SPACE = " \t\n\x0b\x0c\r"


def key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(SPACE))


def brute(texts, min_docs, min_chars):
    found = Counter(k for t in texts for k in {key(x) for x in (t or "").split("\n")} if len(k) >= min_chars)
    gone = {k for k, n in found.items() if n >= min_docs}
    out = []
    for t in texts:
        lines = (t or "").split("\n")
        kept = [x for x in lines if key(x) not in gone]
        out.append(("\n".join(kept), len(lines), len(lines) - len(kept)))
    return out


def random_texts(n, seed):
    r = random.Random(seed)
    lines = ["Common", "common ", "\tCOMMON", "é", "É", "a", "", " ", "rare1", "rare2", "x  y"] + [f"l{i}" for i in range(30)]
    return ["\n".join(r.choices(lines, k=r.randint(0, 8))) for _ in range(n)]


@pytest.mark.parametrize("batches,fanout,min_docs,min_chars", [(1, 2, 10, 1), (4, 2, 10, 1), (7, 3, 4, 2), (3, 2, 2, 0), (2, 2, 1, 1)])
def test_equals_brute_force(make_docs, batches, fanout, min_docs, min_chars):
    texts = random_texts(120, batches) + [None, "", "Common\n" * 3]
    docs = make_docs(list(enumerate(texts)))
    out = linededup.drop_frequent_lines(docs, min_docs, min_chars, batches, fanout).orderBy("doc_id").collect()
    assert [(r["text"], r["n_lines"], r["n_dropped"]) for r in out] == brute(texts, min_docs, min_chars)


def test_awkward_documents(make_docs, awkward):
    rows = awkward * 4  # each row four times
    docs = make_docs(rows).withColumn("n_lines", F.lit("mine")).withColumn("k", F.lit(1)).withColumn("drops", F.lit(2))
    out = linededup.drop_frequent_lines(docs, min_docs=8)
    assert set(out.columns) == {*docs.columns, "n_dropped"}
    want = sorted((x[0] is None, x[0] or 0, *b) for x, b in zip(rows, brute([r[1] for r in rows], 8, 1), strict=True))
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["text"], r["n_lines"], r["n_dropped"]) for r in out.collect())
    assert got == want


def test_empty_table(empty_docs):
    assert linededup.drop_frequent_lines(empty_docs).count() == 0


def test_runs_are_levelled_and_settled_keys_stored_once(spark):
    runs = linededup.LineRuns(spark, min_docs=3, fanout=2)
    batch = lambda rows: spark.createDataFrame(rows, linededup.LineRuns._SCHEMA)
    runs.add(batch([(1, 1, 2), (2, 2, 1)]))
    assert [len(x) for x in runs.levels] == [1]
    runs.add(batch([(1, 1, 1), (3, 3, 2)]))
    assert [len(x) for x in runs.levels] == [0, 1]
    assert {tuple(r) for r in runs.settled().collect()} == {(1, 1)}
    runs.add(batch([(1, 1, 5), (3, 3, 1)]))  # key 1 is settled: it isn't stored again
    assert {tuple(r) for r in runs._read(runs.levels[0]).collect()} == {(3, 3, 1)}
    runs.add(batch([(4, 4, 9)]))
    assert [len(x) for x in runs.levels] == [0, 0, 1]
    assert {tuple(r) for r in runs.finish().distinct().collect()} == {(1, 1), (3, 3), (4, 4)}


def test_every_run_is_sorted(spark):
    import random as rnd

    keys = [(rnd.Random(i).randrange(10**6), i, 1) for i in range(500)]
    runs = linededup.LineRuns(spark, 10, 3)
    runs.add(spark.createDataFrame(keys, linededup.LineRuns._SCHEMA).repartition(3))
    parts = runs._read(runs.levels[0]).withColumn("f", F.input_file_name()).collect()
    by_file = {}
    for r in parts:
        by_file.setdefault(r["f"], []).append((r["h1"], r["h2"]))
    assert all(v == sorted(v) for v in by_file.values())
