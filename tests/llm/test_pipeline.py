from collections import Counter

import corpus_pipeline
from conftest_words import words
from test_linededup import brute as brute_lines
from test_neardup import brute_classes
from test_packing import verify

from homestats.llm import mixing


def test_each_stage_equals_brute_force_on_its_own_input(spark, make_docs, awkward):
    shared = "This line is in very many documents."
    rows = [(i, f"{words(70 + i, i)}\n{shared}\n{words(30, 500 + i)}", f"s{i % 3}") for i in range(30)]
    rows += [(100 + i, rows[i][1], "s1") for i in range(5)]
    rows += [(200 + i, " | ".join(words(90, 40 + i).split()), "s2") for i in range(6)]
    rows += [(300 + i, " ".join(w + "$$$" for w in words(90, 60 + i).split()), None) for i in range(6)]
    docs = make_docs([*rows, *awkward])
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)

    kept = stages["quality rules"](spark, docs, "").collect()
    ids = [r["doc_id"] for r in kept]
    assert set(range(30)) <= set(ids) and not [i for i in ids if i is not None and 200 <= i < 400]
    docs = spark.createDataFrame(kept, docs.schema)

    lined = stages["line dedup"](spark, docs, "")
    assert lined.columns == columns
    want = Counter((r["doc_id"], t) for r, (t, _, _) in zip(kept, brute_lines([r["text"] for r in kept], 10, 1), strict=True))
    lined = lined.collect()
    assert Counter((r["doc_id"], r["text"]) for r in lined) == want and all(r["n_chars"] == len(r["text"]) for r in lined)
    assert not any(shared in r["text"] for r in lined)
    docs = spark.createDataFrame(lined, docs.schema)

    single = stages["MinHash near-dedup"](spark, docs, "")
    assert single.columns == columns
    single = single.collect()
    assert len(single) == len(set(brute_classes([r["text"] for r in lined], 0.8)))
    docs = spark.createDataFrame(single, docs.schema)

    mixed = stages["mixing sources to target weights"](spark, docs, "")
    assert mixed.columns == columns
    copies = Counter()  # by id: several rows may have one
    for r in mixing.mix_plan(docs).collect():
        copies[r["doc_id"]] += r["copies"]
    mixed = mixed.collect()
    assert Counter(r["doc_id"] for r in mixed) == +copies
    docs = spark.createDataFrame(mixed, docs.schema)

    packed = stages["packing"](spark, docs, "").collect()
    verify(packed, Counter((r["doc_id"], r["text"]) for r in mixed), 2048)


def test_run_and_empty_stages(spark, empty_docs):
    assert corpus_pipeline.run(spark, "/root/testdata/sf0.001").count() > 0
    docs = empty_docs
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "")
    assert docs.count() == 0
