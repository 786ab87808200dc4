"""Fixtures for the tests of the llm subpackage: awkward documents, and small helpers."""

import random
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))
from conftest_words import words  # noqa: E402

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make_docs(spark):
    def make(rows):
        """Rows are ``(doc_id, text)`` or ``(doc_id, text, source)``."""
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s0", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, DOC_SCHEMA)

    return make


@pytest.fixture(scope="session")
def awkward():
    """Nulls, empty, blank, very long and repeated rows, missing and equal ids."""
    r = random.Random(1)
    long_text = " ".join("".join(r.choices("abcdefghijklmnop", k=r.randint(2, 8))) for _ in range(30_000))
    return [
        (1, None, "a"), (2, "", "a"), (3, " \t\n\x0b\x0c\r", None), (None, words(80, 2), "b"), (5, words(80, 2), None),
        (6, long_text, "b"), (7, "x" * 20_000, "c"), (8, words(60, 3), "a"), (8, words(60, 3), "a"), (8, words(70, 4), "a"),
        (9, "é" * 60 + " ß ﬁ　ﬂ   \U0001f600 \x00", "d"), (None, None, None), (10, "\n\n\n", "a"),
    ]


@pytest.fixture(scope="session")
def empty_docs(spark):
    return spark.createDataFrame([], DOC_SCHEMA)
