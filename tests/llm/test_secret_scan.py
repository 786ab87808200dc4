import hashlib
import random
import re

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from homestats.llm import secret_scan as S
from homestats.llm.catalog import QUERIES

ENCODE = S.load_encoding(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN).encode_ordinary


def brute(text):
    """The base spans by the patterns as they are stated."""
    text = text or ""
    assign = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    letters = "".join(f"[{c}{c.upper()}]" if c.islower() else c for c in "password|passwd|secret|token|api_?key")
    found = [(m.start(), 0, m.end()) for m in re.finditer(assign.replace("password|passwd|secret|token|api_?key", letters), text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found)


def test_base_spans_equal_stated_patterns():
    r = random.Random(2)
    parts = ["password", "PassWd", "secret", "toKen", "api_key", "APIKEY", "toKen", "ſecret", ":", "=", " ", '"', "'", "\n", "é", "abc123", "x",
             "AKIA", "ABCDEF0123456789", "0123456789abcdef", "deadbeef", "F", "_", ".", "-", "+/", "\U0001f600"]
    for _ in range(3000):
        text = "".join(r.choices(parts, k=r.randint(0, 25)))
        assert S.base_spans(text, text.encode()) == brute(text), text


def token(r, n):
    return "".join(r.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", k=n))


def test_random_strings_are_found_and_known_ones_left(make_docs):
    r = random.Random(4)
    for _ in range(200):
        s = token(r, 40)
        spans = S.scan_text(f"see {s} here", ENCODE, S.RunTest())
        assert spans == [{"kind": "random", "start": 4, "end": 44}], s
    for s in (
        "3F2504E0-4F89-41D3-9A0C-0305E82C3301", "D41D8CD98F00B204E9800998ECF8427E", "=" * 40, "2024-01-01-2024-12-31-0001",
        "src/main/python/operators/aggregate_functions", "InternationalStandardOrganizationName2", "antidisestablishmentarianism",
    ):
        assert S.scan_text(f"see {s} here", ENCODE, S.RunTest()) == [], s


def test_a_random_run_inside_a_base_span_is_that_span():
    s = token(random.Random(9), 40)
    assert [x["kind"] for x in S.scan_text(f"password = {s} and {s}", ENCODE, S.RunTest())] == ["assign", "random"]


def test_awkward_documents(make_docs, awkward, empty_docs):
    spans = S.secret_spans(F.col("text"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    out = make_docs(awkward).withColumn("kind", F.lit("mine")).select("doc_id", "text", "kind", spans.alias("found")).collect()
    for r in out:
        assert r["found"] is not None and [(x["start"], S.KINDS.index(x["kind"]), x["end"]) for x in r["found"] if x["kind"] != "random"] == brute(r["text"])
    assert empty_docs.select(spans.alias("found")).count() == 0


@pytest.mark.parametrize("sf", ["sf0.001"])
def test_query(spark, sf):
    folder = f"/root/testdata/{sf}"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    out = QUERIES["op3_secret_scan"](spark, folder).collect()
    assert {r["doc_id"] for r in out} == set(texts)
    for r in out:
        want = brute(texts[r["doc_id"]])
        listed = ",".join(f"{S.KINDS[k]}:{a}:{b}" for a, k, b in want)
        assert r["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest()
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == tuple(sum(k == i for _, k, _ in want) for i in range(3))
        assert set(listed.split(",")) <= set(r["spans"].split(",")) or not want


@pytest.mark.parametrize("prefix", [
    "private_signing_key=", "/api/integrations/webhooks/incoming/", "https://example.org/callback?session=", "service-account-credential-",
    "https://example.org/download/archive/signature=",
])
@pytest.mark.parametrize("n", [20, 24, 32])
def test_secrets_joined_to_names_and_paths(prefix, n):
    r = random.Random(n)
    tried = 0
    for _ in range(100):
        s = token(r, n)
        if len(s) > 2.0 * len(ENCODE(s)):
            continue  # not below the ratio by itself
        tried += 1
        for after in ("", "/settings/overview"):
            text = f"see {prefix}{s}{after} here"
            at = text.index(s)
            spans = S.scan_text(text, ENCODE, S.RunTest())
            assert any(x["kind"] == "random" and x["start"] <= at and at + n <= x["end"] for x in spans), text
    assert tried > 50


def test_known_strings_in_paths_are_left():
    for s in (
        "/application/users/profile/settings/3F2504E0-4F89-41D3-9A0C-0305E82C3301/organization/department/overview",
        "/articles/2024/01/31/the-state-of-the-union-address",
        "src/v1/components/button_group/index-2024-01-02", "application_settings=production_environment_2",
    ):
        assert S.scan_text(f"see {s} here", ENCODE, S.RunTest()) == [], s


def _random(r, n, letters):
    return "".join(r.choices(letters, k=n))


LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"


@pytest.mark.parametrize("before", ["AKIA{caps}/", "{hex}/", "{hex}_", "password={word}/+//"])
def test_secrets_joined_to_a_base_span_are_found_whole(before):
    r = random.Random(before)
    for _ in range(60):
        joined = before.format(caps=_random(r, 16, LETTERS[:26]), hex=_random(r, 40, "0123456789abcdef"), word=_random(r, 8, LETTERS))
        secret = _random(r, 40, LETTERS)
        text = f"see {joined}{secret} here"
        spans = S.scan_text(text, ENCODE, S.RunTest())
        if before.startswith("password"):  # the base pattern takes the whole run
            assert [s["kind"] for s in spans] == ["assign"]
            continue
        assert [text[s["start"] : s["end"]] for s in spans if s["kind"] == "random"] == [secret]
        assert len(spans) == 2


@pytest.mark.parametrize(("letters", "n", "least"), [(LETTERS, 16, 0.97), (LETTERS[26:52], 40, 0.85), (LETTERS[:26], 40, 0.85), (LETTERS + "!@#$%^&*()", 32, 0.9)])
def test_short_one_case_and_punctuated_secrets(letters, n, least):
    r = random.Random(n)
    texts = [f"see {_random(r, n, letters)} here" for _ in range(200)]
    assert sum(len(S.scan_text(t, ENCODE, S.RunTest())) == 1 for t in texts) >= least * 200


def test_parameters_set_length_marks_and_the_ratio_of_one_case():
    text = "see q7Zx9Kd2mP4vT1 and jqzxkvwpmbtgfrdhcnlsyq and aB3$xY9!kL2#mN7%pQ here"
    kinds = {t: len(S.scan_text(text, ENCODE, t)) for t in (S.RunTest(), S.RunTest(min_chars=14), S.RunTest(one_case_ratio=0.5), S.RunTest(marks=""))}
    assert list(kinds.values()) == [2, 3, 1, 1]


def test_few_false_alarms_on_prose(spark):
    texts = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()]
    spans = [(t, s) for t in texts for s in S.scan_text(t, ENCODE, S.RunTest()) if s["kind"] == "random"]
    assert len(spans) <= 2
