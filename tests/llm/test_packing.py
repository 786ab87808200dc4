import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from homestats.llm import packing
from homestats.llm.catalog import QUERIES

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)


def ids_of(text):
    return [*LIBRARY.encode(text or "", add_special_tokens=False).ids, 1]


@pytest.mark.parametrize("remembered", [0, 500_000])
def test_ids_equal_the_library(monkeypatch, remembered):
    monkeypatch.setattr(packing, "REMEMBERED_WORDS", remembered)
    r = random.Random(3)
    parts = list("abÉİΣσ  \n\té́'st,.0 <s>") + ["the", "'ll", "<|endoftext|>", "　", "\U0001f600", "\x00", "  ", "\x1c", "\x85", "ﬁ"]
    parts += ["ΑΣ", "ς", "É.", "ß", "ẞ", "Dž", "K", "ſ", "Word,", "WORD!?", "(x)", "don't", "don't."]
    texts = ["".join(r.choices(parts, k=r.randint(0, 30))) for _ in range(3000)] + ["", " ", None]
    encoder = packing.WordEncoder(PATH)
    assert encoder.direct
    encoder.encode(pa.array(texts[1000:2000]), 1)
    bounds, ids = encoder.encode(pa.array(texts), 1)
    assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)] == [ids_of(t) for t in texts]


def test_words_are_learned_without_case_and_closing_marks():
    texts = ["Word, word. WORD!? word Été, été### don't don't.", "<|endoftext|>word <|endoftext|>, a\x00b a\x00, 12. x1", "ÉTÉ. #été Word_"]
    encoder = packing.WordEncoder(PATH)
    bounds, ids = encoder.encode(pa.array(texts), 1)
    assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)] == [ids_of(t) for t in texts]
    assert {w for w in encoder.place if "word" in w.lower() and "<" not in w} == {"word"}
    assert {w for w in encoder.place if "t" in w and "<" not in w} == {"été", "#été", "don't", "don't."}


def test_plan_places_every_length_once_and_never_overfills():
    r = np.random.default_rng(1)
    for trial in range(60):
        most = int(r.integers(1, 60))
        histogram = Counter(r.integers(1, most + 1, int(r.integers(0, 300))).tolist())
        plan = packing.shortest_pack_first(histogram, most)
        placed = Counter()
        for count, lengths in plan.patterns:
            assert count > 0 and sum(lengths) <= most and list(lengths) == sorted(lengths, reverse=True)
            for n in lengths:
                placed[n] += count
        assert placed == +histogram
        assert len(plan.patterns) <= 2 * most
        # ranks of a length are covered once, without gaps
        for n, (ranks, _, _) in plan.slots().items():
            counts = [c for c, lengths in plan.patterns for x in lengths if x == n]
            assert ranks.tolist() == np.cumsum([0, *counts[:-1]]).tolist()


def test_shortest_pack_goes_first():
    plan = packing.shortest_pack_first({7: 1, 5: 1, 3: 1}, 10)
    assert sorted(plan.patterns) == [(1, (5, 3)), (1, (7,))]


def test_long_lengths_need_no_more_packs_than_first_fit():
    r = random.Random(0)
    lengths = [r.randint(1, 2048) for _ in range(5000)]
    plan = packing.shortest_pack_first(Counter(lengths), 2048)
    packs = sum(c for c, _ in plan.patterns)
    assert packs <= 1.02 * sum(lengths) / 2048 + 1


def verify(rows, texts, max_len):
    """Each id in exactly one piece, sequences gapless and not too long; ``texts`` counts (id, text)."""
    docs, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        docs[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at and length > 0
            at += length
        assert at <= max_len
    want = Counter()
    for (i, text), n in texts.items():
        ids = ids_of(text)
        for a in range(0, len(ids), max_len):
            part = np.array(ids[a : a + max_len], "<u4")
            want[i, a, len(part), zlib.crc32(part.tobytes()), len(ids)] += n
    assert Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in rows) == want
    totals = [sum(n for _, n in p) for p in sequences.values()]
    return sum(max_len - t for t in totals if t & (t - 1)) / max(1, sum(totals))


@pytest.mark.parametrize("max_len", [16, 2048])
def test_awkward_documents(make_docs, awkward, max_len):
    docs = make_docs(awkward).repartition(3).withColumn("length", F.lit("mine")).withColumn("part", F.lit(-1))
    rows = packing.pack(docs, PATH, max_len, ids=True).collect()
    verify(rows, Counter((i, t) for i, t, _ in awkward), max_len)
    for r in rows:
        assert len(r["ids"]) == r["length"] and zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"]


def test_empty_table(empty_docs):
    assert packing.pack(empty_docs, PATH).count() == 0


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    texts = Counter((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").collect())
    assert verify(QUERIES["op6_pack_sequences"](spark, folder).collect(), texts, 2048) < 0.02
