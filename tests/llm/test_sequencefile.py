import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from homestats.llm import sequencefile as S
from homestats.llm.catalog import QUERIES
from homestats.llm.common import scratch_path

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = ["a", "B", "é", "\n", " ", "  ", "\t", "\xa0", "'s", "'ll", "1", "23", ".", ",", "!!", "<|endoftext|>", "<|endof", "漢字", "\U0001f600",
       " ", "\x1c", "\x85", "\x0b", "\r\n", "don't", " x", "ŋ", "İ", "ﬁ", "́", "ʰ", "_", "-", " ", "​"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def want_ids(library, texts):
    return [e.ids + [2] for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.mark.parametrize("remembered", [S.REMEMBERED_UNITS, 10])
def test_encoder_equals_the_library(library, monkeypatch, remembered):
    monkeypatch.setattr(S, "REMEMBERED_UNITS", remembered)
    r = random.Random(5)
    encoder = S.PieceEncoder(PATH)
    for _ in range(4):
        texts = ["".join(r.choices(ODD, k=r.randint(0, 16))) for _ in range(1500)] + ["", None, "x" * 9000, " " * 700, "ab " * 3000]
        bounds, ids = encoder.encode(pa.array(texts), 2)
        assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)] == want_ids(library, texts)


def test_units_are_learned_by_parts(library):
    texts = ["a word,\nword. word! word", "a\nword\n<|endoftext|>\nword-- ça,\nça", "word\n\nword \nword", "\nword's\n12", "word"]
    encoder = S.PieceEncoder(PATH)
    bounds, ids = encoder.encode(pa.array(texts), 2)
    assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)] == want_ids(library, texts)
    assert {u for u in encoder.place if "word" in u} == {" word", "word", "word\n\nword", " \nword", "\nword's\n12"}
    assert {" ça", "ça", "--", ","} <= set(encoder.place)


def test_other_tokenizers_get_whole_texts():
    path = public_tokenizers.path("word_bpe_49k.json")
    encoder, library = S.PieceEncoder(path), Tokenizer.from_file(path)
    texts = ["Some words, e.g.  these", "", None, "More\nof them's"]
    assert not encoder.by_units
    for _ in range(2):
        bounds, ids = encoder.encode(pa.array(texts), 7)
        want = [e.ids + [7] for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]
        assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)] == want


@pytest.mark.parametrize("n", [0, 1, 7, 8, 31, 32, 33, 64, 200])
def test_any_sequence_is_a_view_of_the_map(tmp_path, n):
    path, ids = str(tmp_path / "x.arrow"), np.arange(n) * 3 % 65_536
    with pa.OSFile(path, "wb") as f:
        out = S.SequenceWriter(f, 8, "uint16", 4, 9)
        for part in np.array_split(ids, 3):
            out.add(part)
        out.close()
    with pa.memory_map(path) as f:  # the file is an ordinary Arrow stream
        table = pa.ipc.open_stream(f).read_all()
    before = pa.total_allocated_bytes()
    file = S.SequenceFile(path)
    assert len(file) == table.num_rows == -(-n // 8) == out.n_sequences
    for i in random.Random(1).sample(range(len(file)), len(file)):
        got, mask = file[i]
        k = min(8, n - 8 * i)
        assert got.dtype == np.uint16 and got.tolist() == ids[8 * i : 8 * i + k].tolist() + [9] * (8 - k) and mask.to_pylist() == [True] * k + [False] * (8 - k)
        assert not got.flags.owndata and pa.total_allocated_bytes() == before
    for a, k in ((0, n), (n // 3, n // 2), (n, 0)):
        assert np.concatenate([*file.runs(a, k), np.empty(0)]).tolist() == ids[a : a + k].tolist()
    with pytest.raises(IndexError):
        file[len(file)]


def check(rows, docs, library):
    """Rows of a result against documents in order of their ids; those of equal ids in any order."""
    got = sorted(((r["start"], r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in rows))
    assert [g[0] for g in got] == [0, *np.cumsum([g[2] for g in got])[:-1].tolist()][: len(got)]
    assert [(i is not None, i or 0) for _, i, _, _ in got] == sorted((i is not None, i or 0) for i, _ in docs)
    want = [(i, len(ids), crc(ids)) for (i, _), ids in zip(docs, want_ids(library, [t for _, t in docs]), strict=True)]
    assert sorted((repr(i), n, c) for _, i, n, c in got) == sorted((repr(i), n, c) for i, n, c in want)


@pytest.mark.parametrize("file_ids", [1 << 26, 300])
def test_round_trip_of_awkward_documents(spark, make_docs, awkward, library, file_ids):
    docs = [(i, t) for i, t, *_ in awkward] + [(20 + i, f"Some text {i} <|endoftext|>") for i in range(50)] + [(30, "again")] * 40
    random.Random(2).shuffle(docs)
    df = make_docs([(i, t, "s") for i, t in docs]).repartition(6)
    df = df.withColumn("digest", F.lit("x")).withColumn("row", F.lit(None).cast("int")).withColumn("start", F.lit(1))
    path = scratch_path(spark, "sequences")
    S.write_sequences(df, path, PATH, length=256, file_ids=file_ids, per_batch=8)
    check(S.read_documents(spark, path).collect(), docs, library)
    # all sequences together hold all ids in order, and padding only where a file ends
    rows = S.read_sequences(spark, path).orderBy("sequence_id").collect()
    assert [r["sequence_id"] for r in rows] == list(range(len(rows))) and {len(r["ids"]) for r in rows} == {256}
    flat = [i for r in rows for i, m in zip(r["ids"], r["mask"], strict=True) if m]
    files = S.manifest(spark, path)
    assert len(flat) == sum(len(i) for i in want_ids(library, [t for _, t in docs])) == files.agg(F.sum("n_ids")).first()[0]
    assert sum(False in r["mask"] for r in rows) <= files.count() and (file_ids > 300 or files.count() > 5)
    ordered = sorted((r for r in S.read_documents(spark, path).collect()), key=lambda r: r["start"])
    assert all(crc(flat[r["start"] : r["start"] + r["n_tokens"]]) == r["ids_crc32"] for r in ordered)


def test_empty_table(spark, empty_docs):
    path = scratch_path(spark, "sequences")
    S.write_sequences(empty_docs, path, PATH)
    assert S.read_documents(spark, path).collect() == [] and S.read_sequences(spark, path).collect() == []


def test_files_of_failed_attempts_are_not_read(spark, make_docs, library, tmp_path):
    import pathlib

    path, once = str(tmp_path / "out"), str(tmp_path / "failed")
    docs = [(i, f"text number {i}") for i in range(40)]
    whole = S.SequenceWriter.close

    def close(self):
        whole(self)
        if not pathlib.Path(once).exists():
            pathlib.Path(once).touch()
            raise RuntimeError("a lost task")

    S.SequenceWriter.close = close
    try:
        S.write_sequences(make_docs(docs), path, PATH)
    finally:
        S.SequenceWriter.close = whole
    assert len(list(pathlib.Path(path).glob("*.sequences.arrow"))) > S.manifest(spark, path).count()
    check(S.read_documents(spark, path).collect(), docs, library)


def test_query_covers_the_whole_table(spark, library):
    docs = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    out = QUERIES["op12_sequence_files"](spark, "/root/testdata/sf0.001")
    assert out.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    check(out.collect(), docs, library)
