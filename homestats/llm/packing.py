"""Packing token sequences: shortest pack first, over the histogram of lengths.

Documents are tokenized and cut into pieces of at most ``max_len`` tokens. Only
the histogram of piece lengths (at most ``max_len`` rows) reaches the driver: lengths
are placed longest first, all pieces of a length at once, into the packs with most
room, which changes counts of packing patterns. Pieces then find their place by
rank: the r-th piece of a length takes the r-th slot that the patterns have for
that length.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from homestats.llm.common import cached, materialize, text_slices, tidy, word_codes

#: Marks that a tokenizer parts from the letters before them: ASCII ones but ``'``, which it may take with letters, and ``<``.
CLOSING = "!\"#$%&()*+,-./:;=>?@[\\]^_`{|}~"
#: Letters that normalization leaves alone but for their case, and words of them.
LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff"
SIMPLE = f"^ ?[{LETTERS}]+$"
MARKED = f"^ ?[{LETTERS}]+[{re.escape(CLOSING)}]+$"
#: Words whose ids a Python worker remembers; when there are more, only those of the texts at hand are kept.
REMEMBERED_WORDS = 500_000
#: Texts are encoded in slices of about this many bytes.
ENCODE_BYTES = 8 << 20
#: Words that are given to the tokenizer as one text.
AT_ONCE = 500


def without_marks(words: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """``(bounds, parts)``: letters and the closing marks after them are two parts, any other word is one."""
    marked = np.flatnonzero(pc.match_substring_regex(words, MARKED).to_numpy(zero_copy_only=False))
    some, n = words.take(pa.array(marked)), len(words)
    sizes = np.ones(n, np.int64)
    sizes[marked] = 2
    bounds = np.concatenate(([0], np.cumsum(sizes)))
    which = np.empty(int(bounds[-1]), np.int64)
    which[bounds[:-1]] = np.arange(n)
    which[bounds[marked]] = n + np.arange(len(marked))
    which[bounds[marked] + 1] = n + len(marked) + np.arange(len(marked))
    parts = [words, pc.ascii_rtrim(some, characters=CLOSING), pc.replace_substring_regex(some, f"^ ?[{LETTERS}]+", "")]
    return bounds, pa.concat_arrays(parts).take(pa.array(which))


class WordEncoder:
    """Token ids of texts, each distinct word given to the tokenizer once, without the marks at its end.

    For tokenizers that never merge across ASCII white space and drop it: then a
    text's ids are its words' ids one after the other.
    """

    #: Put between words that are encoded at once; its id tells them apart.
    between, mark = " \x00 ", "\x00"
    #: Words of which many are encoded at once: they hold neither the mark nor added tokens.
    joinable = r"^[^\x00<]+$"

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        probe = "Ab\n c,d  e's"
        if self._ids([probe])[0] != [i for ids in self._ids(probe.split()) for i in ids]:
            raise ValueError("the tokenizer doesn't drop white space")
        self.direct = self._foresee(["a", "The", "straightforward", "zzQxv", "don", "Émíñß", "àÿÞ"])
        self._forget()

    def _foresee(self, words: list[str]) -> bool:
        """Whether letters can go to the model straight, marks after them be parted and words be encoded at once."""
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        if not all("<" in t for t in added):
            return False
        samples = [w + t for w in words for t in ("", ".", ",)", "!?")]
        bounds, parts = without_marks(self._folded(pa.array(samples, pa.large_string())))
        listed = parts.to_pylist()
        ids = [self._letters(w) if w.strip(" ").isalpha() else self._ids([w])[0] for w in listed]
        mark = self._ids([self.mark])[0]
        self.mark_id = mark[0]
        whole = self._ids(samples)
        return len(mark) == 1 and [sum(ids[i:j], []) for i, j in zip(bounds[:-1], bounds[1:], strict=True)] == whole and self._at_once(samples) == whole

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def _at_once(self, words: list[str]) -> list[list[int]]:
        """Ids of words without added tokens and marks, many words in one text."""
        out = []
        for i in range(0, len(words), AT_ONCE):
            part = words[i : i + AT_ONCE]
            ids = self.tokenizer.encode_batch_fast([self.between.join(part)], add_special_tokens=False)[0].ids
            flat = np.array(ids, np.uint32)
            cuts = [-1, *np.flatnonzero(flat == self.mark_id).tolist(), len(ids)]
            if len(cuts) != len(part) + 1:
                out += self._ids(part)
            else:
                out += [ids[a + 1 : b] for a, b in pairwise(cuts)]
        return out

    def _forget(self) -> None:
        self.place: dict[str, int] = {}
        self.starts, self.sizes, self.ids = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint32)

    def _keep(self, words: list[str]) -> None:
        """Forget all words but these: the frequent ones are among those of any texts."""
        known = [w for w in words if w in self.place]
        sizes, flat = self._take(np.array([self.place[w] for w in known], np.int64))
        self._forget()
        self._add(known, sizes, flat)

    def _add(self, words: list[str], sizes: np.ndarray, flat: np.ndarray) -> None:
        self.place.update(zip(words, range(len(self.starts), len(self.starts) + len(words)), strict=True))
        self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(sizes) - sizes])
        self.sizes = np.concatenate([self.sizes, sizes])
        self.ids = np.concatenate([self.ids, flat])

    def _take(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sizes and ids, one after the other, of the words at these places."""
        return taken(self.starts, self.sizes, self.ids, which)

    def _folded(self, words: pa.Array) -> pa.Array:
        """Words of letters and closing marks in lower case, as the tokenizer takes them."""
        simple = pc.match_substring_regex(words, f"^[{LETTERS}]+[{re.escape(CLOSING)}]*$")
        return pc.if_else(simple, pc.utf8_lower(words), words)

    def _letters(self, word: str) -> list[int]:
        """Ids of letters, straight from the tokenizer's model."""
        return [t.id for t in self.model.tokenize(word if word.isascii() and word[0] != " " else byte_level(word))]

    def _learn(self, words: list[str]) -> None:
        for i in range(0, len(words), 50_000):
            part = words[i : i + 50_000]
            found: list = [None] * len(part)
            if self.direct:
                kinds = pa.array(part, pa.large_string())
                simple = pc.match_substring_regex(kinds, SIMPLE).to_numpy(zero_copy_only=False)
                many = ~simple & pc.match_substring_regex(kinds, self.joinable).to_numpy(zero_copy_only=False)
                for k in np.flatnonzero(simple).tolist():
                    found[k] = self._letters(part[k])
                where = np.flatnonzero(many).tolist()
                for k, ids in zip(where, self._at_once([part[k] for k in where]), strict=True):
                    found[k] = ids
            rest = [k for k, ids in enumerate(found) if ids is None]
            for k, ids in zip(rest, self._ids([part[k] for k in rest]), strict=True):
                found[k] = ids
            sizes = np.fromiter(map(len, found), np.int64, len(found))
            self._add(part, sizes, np.fromiter(chain.from_iterable(found), np.uint32, int(sizes.sum())))

    def _most(self) -> int:
        return REMEMBERED_WORDS

    def _words(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
        """``(bounds, codes, words)``: text i has the words ``words[codes[bounds[i]:bounds[i + 1]]]``."""
        return word_codes(texts)

    def _parts(self, words: pa.Array) -> tuple[np.ndarray, pa.Array]:
        """``(bounds, parts)`` of words, whose ids are their parts' ids one after the other."""
        return without_marks(self._folded(words)) if self.direct else (np.arange(len(words) + 1), words)

    def encode(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """``(bounds, ids)``; each text's ids end with ``end_id``."""
        bounds, codes, words = self._words(texts)
        part_bounds, parts = self._parts(words)
        encoded = parts.dictionary_encode()
        listed = encoded.dictionary.to_pylist()
        if len(self.place) > self._most():
            self._keep(listed)
        found = list(map(self.place.get, listed))
        new = [k for k, place in enumerate(found) if place is None]
        self._learn([listed[k] for k in new])
        for k in new:
            found[k] = self.place[listed[k]]
        where = np.array(found, np.int64)
        sizes, ids = self._take(where[encoded.indices.to_numpy(zero_copy_only=False)])
        edges = np.concatenate(([0], np.cumsum(sizes)))[part_bounds]
        sizes, flat = taken(edges[:-1], np.diff(edges), ids, codes)
        total = np.concatenate(([0], np.cumsum(sizes)))
        out_bounds = total[bounds] + np.arange(len(bounds))  # one end id per text before
        out = np.full(int(out_bounds[-1]), end_id, np.uint32)
        inside = np.ones(len(out), bool)
        inside[out_bounds[1:] - 1] = False
        out[inside] = flat
        return out_bounds, out


#: What byte-level tokenizers write for the bytes without a visible character of their own.
_BYTES = {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if not (33 <= b < 127 or 161 <= b < 173 or b > 173))}


def byte_level(word: str) -> str:
    """A word as a byte-level tokenizer's model sees it, a character per byte."""
    return word.encode().decode("latin-1").translate(_BYTES)


def taken(starts: np.ndarray, sizes: np.ndarray, ids: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sizes and ids, one after the other, of some of the runs of ``ids`` that ``starts`` and ``sizes`` tell."""
    starts, sizes = starts[which], sizes[which]
    first = np.cumsum(sizes) - sizes
    return sizes, ids[np.repeat(starts - first, sizes) + np.arange(int(sizes.sum()))]


PIECE = T.StructType([
    T.StructField("start", T.LongType()), T.StructField("length", T.LongType()), T.StructField("ids_crc32", T.LongType()),
    T.StructField("doc_tokens", T.LongType()), T.StructField("part", T.LongType()), T.StructField("nth", T.LongType()),
])


def cut_pieces(docs: DataFrame, tokenizer_path: str, max_len: int, end_id: int, doc_id: str, text: str, ids: bool) -> DataFrame:
    """``(doc_id, start, length, ids_crc32, doc_tokens, part, nth[, ids])``, a row per piece.

    Every document gives full pieces and one with its rest, which is never empty. ``part`` is the task
    that wrote the piece, ``nth`` its number among the task's pieces of that length.
    """
    schema = T.StructType([T.StructField("doc_id", docs.schema[doc_id].dataType), *PIECE.fields])
    if ids:
        schema.add("ids", T.ArrayType(T.LongType()))

    @tidy
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = cached(("words", tokenizer_path), lambda: WordEncoder(tokenizer_path))
        part, seen = TaskContext.get().partitionId(), np.zeros(max_len + 1, np.int64)
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1)
            for a, b in text_slices(texts, ENCODE_BYTES):
                bounds, flat = encoder.encode(texts[a:b], end_id)
                sizes = np.diff(bounds)
                n_pieces = -(-sizes // max_len)
                doc = np.repeat(np.arange(b - a), n_pieces)
                first = np.concatenate(([0], np.cumsum(n_pieces)[:-1]))
                start = (np.arange(len(doc)) - first[doc]) * max_len
                length = np.minimum(max_len, sizes[doc] - start)
                order = np.argsort(length, kind="stable")
                run = np.concatenate(([0], np.flatnonzero(np.diff(length[order])) + 1)) if len(order) else order
                counts = np.diff(np.append(run, len(order)))
                nth = np.empty(len(order), np.int64)
                nth[order] = np.arange(len(order)) - np.repeat(run, counts) + seen[length[order]]
                seen[length[order[run]]] += counts
                at = bounds[doc] + start
                little = flat.astype("<u4", copy=False)
                crc = np.fromiter((zlib.crc32(little[i : i + n]) for i, n in zip(at, length, strict=True)), np.int64, len(at))
                columns = [keys[a:b].take(pa.array(doc)), *map(pa.array, (start, length, crc, sizes[doc], np.full(len(doc), part, np.int64), nth))]
                if ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(np.append(at, len(flat)).astype(np.int32)), pa.array(flat.astype(np.int64))))
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.select(doc_id, text).mapInArrow(cut, schema)


@dataclass
class PackPlan:
    """For each length, the slots that patterns have for it, by rank."""

    max_len: int
    #: Of each pattern: how many sequences have it, and its lengths in order of place.
    patterns: list[tuple[int, tuple[int, ...]]] = field(default_factory=list)

    def slots(self) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Of each length: first ranks of its slots, the first sequence of each, and the offset in it."""
        found: dict[int, list[tuple[int, int, int]]] = {}
        taken: dict[int, int] = {}
        sequence = 0
        for count, lengths in self.patterns:
            offset = 0
            for n in lengths:
                found.setdefault(n, []).append((taken.get(n, 0), sequence, offset))
                taken[n] = taken.get(n, 0) + count
                offset += n
            sequence += count
        return {n: tuple(np.array(c, np.int64) for c in zip(*rows, strict=True)) for n, rows in found.items()}


def shortest_pack_first(histogram: dict[int, int], max_len: int) -> PackPlan:
    """Pack ``{length: count}``, longest lengths first, into the packs with most room.

    A length's pieces go, as many at once as there are packs of a pattern, to the
    pattern with the most room left, while any has room for them; those left open new
    packs. Each length adds at most one pattern and splits at most one, so there
    are at most ``2 * max_len`` patterns, whatever the number of pieces.
    """
    open_packs: list[list[tuple[int, tuple[int, ...]]]] = [[] for _ in range(max_len + 1)]  # by room left
    for length in sorted((n for n, c in histogram.items() if c > 0), reverse=True):
        left, moved = histogram[length], []
        for room in range(max_len, length - 1, -1):
            while left and open_packs[room]:
                count, lengths = open_packs[room].pop()
                used = min(left, count)
                if used < count:
                    open_packs[room].append((count - used, lengths))
                moved.append((room - length, (used, (*lengths, length))))
                left -= used
        # a pack that took one piece may take another of this length
        while left and (again := [m for m in moved if m[0] >= length]):
            again.sort(key=lambda m: -m[0])
            room, (count, lengths) = again[0]
            moved.remove(again[0])
            used = min(left, count)
            if used < count:
                moved.append((room, (count - used, lengths)))
            moved.append((room - length, (used, (*lengths, length))))
            left -= used
        if left:
            per_pack = max_len // length
            if left >= per_pack:
                moved.append((max_len - per_pack * length, (left // per_pack, (length,) * per_pack)))
            if rest := left % per_pack:
                moved.append((max_len - rest * length, (1, (length,) * rest)))
        for room, pack in moved:
            open_packs[room].append(pack)
    return PackPlan(max_len, [p for packs in open_packs for p in packs])


PLACE = T.StructType([T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])


def pack(
    docs: DataFrame, tokenizer_path: str, max_len: int = 2048, end_id: int = 1,
    doc_id: str = "doc_id", text: str = "text", ids: bool = False,
) -> DataFrame:
    """Pieces of all documents and where they lie: a row per piece.

    ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset`` and, with
    ``ids``, the piece's token ids. A document's ids end with ``end_id``, so a null or
    empty text has one id. Offsets in a sequence leave no gap; a sequence holds
    ``max_len`` ids at most. Repeated rows are documents of their own. Pieces of equal
    length are interchangeable, so which of them lies where may differ between runs over
    other partitions; the lengths packed together do not. An empty table gives no rows; other
    columns are ignored, whatever their names.
    """
    pieces = materialize(cut_pieces(docs, tokenizer_path, max_len, end_id, doc_id, text, ids), "pieces")
    per_part = materialize(pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n")), "piece-counts")
    histogram = {r["length"]: r["n"] for r in per_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # <= max_len rows
    slots = shortest_pack_first(histogram, max_len).slots()

    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    earlier = per_part.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    ranked = pieces.join(earlier, ["part", "length"]).withColumn("rank", F.col("earlier") + F.col("nth"))

    @F.arrow_udf(PLACE)
    def place(lengths: pa.Array, ranks: pa.Array) -> pa.Array:
        n, r = lengths.to_numpy(zero_copy_only=False), ranks.to_numpy(zero_copy_only=False)
        sequence, offset = np.empty(len(n), np.int64), np.empty(len(n), np.int64)
        order = np.argsort(n, kind="stable")
        edges = np.concatenate(([0], np.flatnonzero(np.diff(n[order])) + 1, [len(n)])) if len(n) else [0]
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            rows = order[a:b]
            ranks_from, sequences, offsets = slots[int(n[rows[0]])]
            slot = np.searchsorted(ranks_from, r[rows], side="right") - 1
            sequence[rows] = sequences[slot] + r[rows] - ranks_from[slot]
            offset[rows] = offsets[slot]
        return pa.StructArray.from_arrays([pa.array(sequence), pa.array(offset)], ["sequence_id", "offset"])

    placed = ranked.withColumn("place", place(F.col("length"), F.col("rank")))
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "place.sequence_id", "place.offset"]
    return placed.select(*columns, *(["ids"] if ids else []))
