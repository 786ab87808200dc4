"""Token counts by heap-and-linked-list byte-pair merging.

A text's symbols form a doubly linked list; a heap holds its adjacent pairs that
are in the vocabulary, by rank. The lowest-ranked pair is popped and merged again
and again, and only the number of merges is kept: the count is the number of
initial symbols less the merges. No identifiers are made.

No piece of the vocabulary reaches across the start of a run of word marks (this
is checked when it is loaded), so a text falls into units that merge by
themselves, and each distinct unit of a batch is merged once.
"""

from __future__ import annotations

from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from homestats.llm.common import cached, text_slices, worker_state

MARK = "▁"
#: Units a Python worker remembers; when there are more it starts again.
REMEMBERED_UNITS = 400_000


class Vocabulary:
    """Ranks of the pieces of a sentencepiece BPE model with byte fallback."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        sp = SentencePieceProcessor(model_file=path)
        normal = [i for i in range(sp.vocab_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i))]
        if any(sp.is_unused(i) for i in normal) or sp.encode("a  b ", out_type=str)[-1:] != [MARK]:
            raise ValueError("only models that keep white space and use all their pieces are supported")
        # a piece's rank: the higher its score the lower; equal scores have equal ranks
        self.ranks = {sp.id_to_piece(i): -sp.get_score(i) for i in normal}
        self.whole = any(MARK in p.lstrip(MARK) for p in self.ranks)
        # No merge happens between two characters that follow each other in no piece: pieces end at a line feed
        # if no longer piece has one, and closing marks come off a word if no piece joins them to a letter.
        self.pairs = {p[i : i + 2] for p in self.ranks for i in range(len(p) - 1)}
        self.breaks = not any("\n" in p for p in self.pairs)
        joined = {y for x, y in self.pairs if x.isalpha()}
        self.closing = "".join(c for c in ".,;:!?)|" if c not in joined)

    def initial(self, symbol: str) -> int:
        """Tokens that a symbol is by itself: its bytes, if it isn't in the vocabulary."""
        return 1 if symbol in self.ranks else len(symbol.encode())

    def count(self, unit: str) -> int:
        """Tokens of a unit."""
        ranks = self.ranks
        symbols: list = list(unit)
        total = 0
        for s in symbols:
            total += 1 if s in ranks else len(s.encode())
        n = len(symbols)
        heap = [(ranks[p], i, p) for i in range(n - 1) if (p := symbols[i] + symbols[i + 1]) in ranks]
        if not heap:
            return total
        heapify(heap)
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        while heap:
            _, i, piece = heappop(heap)
            left = symbols[i]
            j = after[i]
            # an entry is stale once either symbol has been merged
            if left is None or j >= n or left + symbols[j] != piece:
                continue
            total -= 1
            symbols[i], symbols[j] = piece, None
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (p := piece + symbols[k]) in ranks:
                    heappush(heap, (ranks[p], i, p))
            h = before[i]
            if h >= 0 and (p := symbols[h] + piece) in ranks:
                heappush(heap, (ranks[p], h, p))
        return total


def _unit_count(vocabulary: Vocabulary, known: dict, unit: str) -> int:
    """Tokens of a unit; those of its independent parts are remembered."""
    if vocabulary.breaks and "\n" in unit:
        lines = unit.split("\n")
        return len(lines) - 1 + sum(_unit_count(vocabulary, known, x) for x in lines if x)
    if len(word := unit.rstrip(vocabulary.closing)) < len(unit) and word and word[-1].isalpha():
        return _unit_count(vocabulary, known, word) + _unit_count(vocabulary, known, unit[len(word) :])
    c = known.get(unit)
    if c is None:
        c = known[unit] = vocabulary.count(unit)
    return c


def _unit_counts(vocabulary: Vocabulary, known: dict, units: list[str]) -> np.ndarray:
    if len(known) > REMEMBERED_UNITS:
        known.clear()
    return np.fromiter((_unit_count(vocabulary, known, u) for u in units), np.int64, len(units))


def count_tokens_batch(vocabulary: Vocabulary, known: dict, texts: pa.Array) -> np.ndarray:
    """Tokens of each text, a mark put before it; null and empty texts have none."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if vocabulary.whole:
        return np.array([vocabulary.count(MARK + t.replace(" ", MARK)) if t else 0 for t in texts.to_pylist()], np.int64)
    pieces = pc.split_pattern(pc.replace_substring(texts, MARK, " "), " ")
    bounds = pieces.offsets.to_numpy().astype(np.int64)
    encoded = pieces.values[bounds[0] : bounds[-1]].dictionary_encode()
    bounds -= bounds[0]
    codes, words = encoded.indices.to_numpy(zero_copy_only=False), encoded.dictionary
    mark, nothing = pa.scalar(MARK, words.type), pa.scalar("", words.type)
    counts = _unit_counts(vocabulary, known, pc.binary_join_element_wise(mark, words, nothing).to_pylist())[codes]
    empty = pc.index(words, "").as_py()
    if empty >= 0:
        # an empty piece is a further mark before the next piece, or at the text's end
        gap = codes == empty
        counts[gap] = 0
        last = np.zeros(len(codes), bool)
        last[bounds[1:] - 1] = True
        run = 0
        for i in np.flatnonzero(gap | np.concatenate(([False], gap[:-1]))):
            if gap[i]:
                run += 1
                if last[i]:
                    counts[i] = _unit_counts(vocabulary, known, [MARK * run])[0]
                    run = 0
            else:
                if run:
                    counts[i] = _unit_counts(vocabulary, known, [MARK * (run + 1) + words[codes[i]].as_py()])[0]
                run = 0
    out = np.add.reduceat(counts, bounds[:-1]) if len(codes) else np.zeros(len(texts), np.int64)
    out[pc.equal(texts, "").to_numpy(zero_copy_only=False)] = 0
    return out


def token_count(text: Column, model_path: str) -> Column:
    """Number of tokens of whole texts under the model at ``model_path``, as a long column.

    Counts are those of the model's library without begin, end or special tokens:
    special strings in a text are ordinary text. Null and empty texts have 0 tokens.
    A very long text, or one without white space, is merged in time n log n. The count depends on the
    text alone: an empty table and other columns need no care.
    """

    @F.arrow_udf("long")
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        vocabulary = cached(("pieces", model_path), lambda: Vocabulary(model_path))
        known = worker_state().setdefault(("piece counts", model_path), {})
        for texts in batches:
            parts = [count_tokens_batch(vocabulary, known, texts[a:b]) for a, b in text_slices(texts)]
            yield pa.array(np.concatenate(parts) if parts else np.empty(0, np.int64), pa.int64())

    return count(text)
