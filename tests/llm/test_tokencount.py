import random

import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from homestats.llm import tokencount as T
from homestats.llm.catalog import QUERIES

PATH = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = SentencePieceProcessor(model_file=PATH)
PARTS = list("ab  ▁\n\té日'st,.0 <s>|") + ["the", "ing", "<unk>", "　", "\U0001f600", "\x00", "  ", "</s>", "<0x41>", "ñ", "\r\n"]


def test_counts_equal_the_library():
    r = random.Random(3)
    texts = ["".join(r.choices(PARTS, k=r.randint(0, 30))) for _ in range(5000)]
    texts += ["", " ", "   ", "▁", "\n", "a" * 3000, "ab" * 2000, " a ", ".", "a.", "a.\n.b", None]
    known = {}
    vocabulary = T.Vocabulary(PATH)
    got = T.count_tokens_batch(vocabulary, known, pa.array(texts, pa.string())).tolist()
    assert got == [len(x) for x in LIBRARY.encode([t or "" for t in texts])]
    assert T.count_tokens_batch(vocabulary, known, pa.array([], pa.string())).tolist() == []


def test_merging_is_by_lowest_rank_and_leftmost():
    v = object.__new__(T.Vocabulary)
    v.ranks = {"a": 9, "b": 9, "c": 9, "ab": 1, "bc": 0, "aa": 2, "aaa": 2}
    assert v.count("abc") == 2  # bc goes first, and then a + bc isn't in the vocabulary
    assert v.count("aaaa") == 2 and v.count("aaa") == 1
    assert v.count("zé") == 3  # bytes of what the vocabulary lacks


def test_merging_by_hand():
    v = object.__new__(T.Vocabulary)
    v.ranks = {"a": 9, "b": 9, "c": 9, "bc": 0, "abc": 5}
    assert v.count("abc") == 1 and v.count("abcabc") == 2 and v.count("") == 0


def test_awkward_documents(make_docs, awkward, empty_docs):
    out = make_docs(awkward).withColumn("n_tokens", F.lit("mine")).select("text", T.token_count(F.col("text"), PATH).alias("n")).collect()
    assert [r["n"] for r in out] == [len(LIBRARY.encode(r["text"] or "")) for r in out]
    assert empty_docs.select(T.token_count(F.col("text"), PATH)).count() == 0


@pytest.mark.parametrize("remembered", [0, 400_000])
def test_forgetting_changes_nothing(monkeypatch, remembered):
    monkeypatch.setattr(T, "REMEMBERED_UNITS", remembered)
    v, known = T.Vocabulary(PATH), {}
    texts = pa.array(["the cat sat", "on the mat", "the cat sat"])
    assert T.count_tokens_batch(v, known, texts).tolist() == T.count_tokens_batch(v, known, texts).tolist() == [len(x) for x in LIBRARY.encode(texts.to_pylist())]


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    for r in QUERIES["op9_token_counts"](spark, folder).collect():
        n = len(LIBRARY.encode(texts[r["doc_id"]]))
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(texts[r["doc_id"]].encode()), n, n > 4096)
