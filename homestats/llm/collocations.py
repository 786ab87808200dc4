"""Phrase collocation mining by best-first branch-and-bound growth.

A phrase's score is its least ``1000 * a * n / (l * r)`` over all cuts. As ``a`` exceeds neither
``l`` nor ``r``, no phrase scores above ``1000 * n / f`` for the count ``f`` of its first or of its
last word: a prefix's count bounds all that grows from it. So rare first words are
the best, and the search goes in waves:

1. a wave expands, per language, the unexpanded first words of the highest bounds: their
   frequent extensions are counted a word at a time up to the longest phrase;
2. phrases whose last word is expanded, too, are scored; the counts of their other parts, and
   of the phrases one word longer, come from one more pass;
3. a language is settled when its ``top``-th surviving score is above the bound of all words
   left, so that no phrase not yet seen can reach it or tie with it. Otherwise the
   next wave expands just the words whose bound isn't below that score, or all words if there
   are fewer survivors yet.

Texts are split twice: words are counted, then runs of two and more frequent words are written as the
words' 64-bit hashes, which differ for different words (checked, with another salt if not). Passes read
these. A pass first counts the hashes of its phrases, partly summed in each task; equal phrases
have equal hashes, so only the few whose hash is frequent are counted as lists of words. Which
phrases a pass looks at is told by bit filters of bounded size; what they let through by
mistake is counted and dropped, so filters never change a result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from homestats.llm.common import materialize, mix64, text_slices, tidy

#: Texts are split and counted in slices of about this many bytes.
COUNT_BYTES = 3 << 20
#: Hashes that a task holds before it sums them up.
HELD_HASHES = 1 << 22
#: Counts of phrases that a task holds before it sums them up.
HELD_PHRASES = 1 << 20
#: About as many words are written a row, and so many rows are looked at at once.
ROW_WORDS, ROWS = 512, 1024
#: A filter has so many bits per phrase, within these bounds.
BITS_PER_PHRASE, LEAST_BITS, MOST_BITS = 16, 1 << 16, 1 << 27
#: The first wave expands words of up to so many times the least count.
FIRST = 4

_COUNTS = "lang string, phrase string, n long"
_SEEDS = np.uint64(0x9E3779B97F4A7C15)

# What parts words and pieces.
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_KIND = np.zeros(256, np.uint8)
_KIND[list(b" \t")] = 1
_KIND[list(b".,;:!?\n\x0b\x0c\r")] = 2


def text_hashes(words: pa.Array, salt: int = 0) -> np.ndarray:
    """A 64-bit hash of each word, from its bytes by numpy."""
    words = words.cast(pa.large_string())
    offsets = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words) + 1]
    data = np.frombuffer(words.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]].astype(np.uint64)
    offsets = offsets - offsets[0]
    sizes = np.diff(offsets)
    place = (np.arange(len(data)) - np.repeat(offsets[:-1], sizes)).astype(np.uint64)
    sums = np.concatenate(([np.uint64(0)], np.cumsum(mix64(data + (place << np.uint64(8)) + np.uint64(1 + (salt << 48))), dtype=np.uint64)))
    return mix64(sums[offsets[1:]] - sums[offsets[:-1]] + sizes.astype(np.uint64) * _SEEDS)


class Phrases:
    """Phrases at the places of a sequence of words, from the words' hashes and pieces."""

    piece: np.ndarray
    hash: dict[int, np.ndarray]

    def within(self, m: int) -> int:
        """Number of places at which a phrase of ``m`` words may begin."""
        return max(0, len(self.piece) - m + 1)

    def whole(self, m: int) -> np.ndarray:
        """Where ``m`` words lie in one piece."""
        n = self.within(m)
        return self.piece[:n] == self.piece[m - 1 : m - 1 + n]

    def hashes(self, m: int) -> np.ndarray:
        """Hash of the ``m`` words from each place on (across pieces, too)."""
        if m not in self.hash:
            n = self.within(m)
            self.hash[m] = joined_hash(self.hashes(m - 1)[:n], self.hash[1][m - 1 : m - 1 + n])
        return self.hash[m]


class Words(Phrases):
    """The words of some texts: a code each, the piece it is in, and of each code the language, word and hash."""

    def __init__(self, texts: pa.Array, langs: pa.Array, salt: int = 0):
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
        offsets = offsets - offsets[0]
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        kind = _KIND[data]
        inside = np.concatenate((kind == 0, [False]))
        before = np.concatenate(([False], inside[:-1]))
        starts = np.flatnonzero(inside & (~before | edge))
        ends = np.flatnonzero(before & (~inside | edge))
        bytes_ = _LOWER[data[inside[:-1]]]
        cuts = np.concatenate(([0], np.cumsum(ends - starts)))
        flat = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(cuts.astype(np.int64)), pa.py_buffer(bytes_))
        encoded = flat.dictionary_encode()
        self.piece = np.cumsum((np.concatenate((kind == 2, [False])) | edge).astype(np.int32))[starts]
        owner = np.searchsorted(offsets, starts, side="right") - 1
        known = pc.fill_null(langs.cast(pa.string()), "und").dictionary_encode()
        lang = known.indices.to_numpy(zero_copy_only=False).astype(np.int64)[owner]
        # words of different languages are different words
        n_words = max(1, len(encoded.dictionary))
        both = lang * n_words + encoded.indices.to_numpy(zero_copy_only=False)
        present = np.zeros(max(1, len(known.dictionary)) * n_words, bool)
        present[both] = True
        kinds = np.flatnonzero(present)
        self.code = (np.cumsum(present) - 1)[both]
        self.langs, self.words = known.dictionary, encoded.dictionary
        self.lang_of, self.word_of = kinds // n_words, kinds % n_words
        lang_hash, word_hash = text_hashes(self.langs, salt), text_hashes(self.words, salt)
        hashes = mix64(word_hash[self.word_of] ^ mix64(lang_hash[self.lang_of] + _SEEDS)) if len(kinds) else np.empty(0, np.uint64)
        self.hash = {1: hashes[self.code]}

    def runs(self, frequent) -> pa.Array:
        """Runs of two and more frequent words of a piece: their hashes, each run with a zero after it, many runs a row."""
        hashes = self.hash[1]
        keep = np.flatnonzero(frequent(hashes))
        hashes, piece = hashes[keep], self.piece[keep]
        if not len(keep):
            return pa.array([], pa.list_(pa.int64()))
        new = np.concatenate(([True], (np.diff(keep) > 1) | (piece[1:] != piece[:-1])))
        sizes = np.diff(np.append(np.flatnonzero(new), len(keep)))
        hashes, sizes = hashes[np.repeat(sizes > 1, sizes)], sizes[sizes > 1]
        starts = np.cumsum(sizes + 1) - sizes - 1
        out = np.zeros(int((sizes + 1).sum()), np.uint64)
        out[np.arange(len(hashes)) + np.repeat(np.arange(len(sizes)), sizes)] = hashes
        first = starts[np.flatnonzero(np.diff(starts // ROW_WORDS, prepend=-1))]
        return pa.ListArray.from_arrays(pa.array(np.append(first, len(out)).astype(np.int32)), pa.array(out.view(np.int64)))

    def counted(self, m: int, at: np.ndarray) -> pa.RecordBatch | None:
        """The distinct phrases of ``m`` words at some places, and how many places each has."""
        if not len(at):
            return None
        n_codes = len(self.word_of)
        number, first = self.code[at], None
        for i in range(1, m):
            _, number = np.unique(number * n_codes + self.code[at + i], return_inverse=True)
        _, first, n = np.unique(number, return_index=True, return_counts=True)
        at = at[first]
        columns = [self.words.take(pa.array(self.word_of[self.code[at + i]])) for i in range(m)]
        phrase = columns[0] if m == 1 else pc.binary_join_element_wise(*columns, pa.scalar(" ", columns[0].type))
        lang = self.langs.take(pa.array(self.lang_of[self.code[at]]))
        return pa.RecordBatch.from_arrays([lang, phrase.cast(pa.string()), pa.array(n, pa.int64())], names=["lang", "phrase", "n"])


class Runs(Phrases):
    """Runs of frequent words, as ``Words.runs`` gives them."""

    def __init__(self, rows: pa.Array):
        hashes = rows.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
        self.piece = np.cumsum(hashes == 0, dtype=np.int32)
        self.hash = {1: hashes}

    def whole(self, m: int) -> np.ndarray:
        """Where ``m`` words lie in one run."""
        return (self.hash[1][: self.within(m)] != 0) & super().whole(m)

    def counted(self, m: int, at: np.ndarray) -> pa.RecordBatch | None:
        """The distinct phrases of ``m`` words at some places as lists of hashes, and how many places each has."""
        if not len(at):
            return None
        words = self.hash[1]
        number = np.unique(words[at], return_inverse=True)[1]
        for i in range(1, m):
            last, which = np.unique(words[at + i], return_inverse=True)
            number = np.unique(number * len(last) + which, return_inverse=True)[1]
        _, first, n = np.unique(number, return_index=True, return_counts=True)
        flat = words[at[first][:, None] + np.arange(m)].ravel()
        codes = pa.ListArray.from_arrays(pa.array(np.arange(len(first) + 1, dtype=np.int32) * m, pa.int32()), pa.array(flat.view(np.int64)))
        return pa.RecordBatch.from_arrays([codes, pa.array(n, pa.int64())], names=["codes", "n"])


def summed(counts: list[pa.RecordBatch]) -> pa.RecordBatch:
    """``(codes, n)`` of phrases of one length, each once."""
    m = len(counts[0]["codes"][0])
    flat = np.concatenate([x["codes"].flatten().to_numpy() for x in counts]).reshape(-1, m)
    n = np.concatenate([x["n"].to_numpy() for x in counts])
    order = np.lexsort(flat.T)
    flat, n = flat[order], n[order]
    first = np.flatnonzero(np.concatenate(([True], (flat[1:] != flat[:-1]).any(axis=1))))
    codes = pa.ListArray.from_arrays(pa.array(np.arange(len(first) + 1, dtype=np.int32) * m), pa.array(flat[first].ravel()))
    return pa.RecordBatch.from_arrays([codes, pa.array(np.add.reduceat(n, first))], names=["codes", "n"])


def joined_hash(phrase: np.ndarray, word: np.ndarray) -> np.ndarray:
    return mix64(phrase * _SEEDS + word)


def phrase_hashes(langs: pa.Array, phrases: pa.Array, salt: int = 0) -> np.ndarray:
    """The hash that ``Words`` gives each phrase of a language."""
    lists = pc.split_pattern(phrases.cast(pa.large_string()), " ")
    bounds = lists.offsets.to_numpy().astype(np.int64)
    words = lists.values[bounds[0] : bounds[-1]].dictionary_encode()
    bounds = bounds - bounds[0]
    hashes = text_hashes(words.dictionary, salt)[words.indices.to_numpy(zero_copy_only=False)]
    known = langs.dictionary_encode()
    lang = mix64(text_hashes(known.dictionary, salt)[known.indices.to_numpy(zero_copy_only=False)] + _SEEDS)
    sizes = np.diff(bounds)
    hashes = mix64(hashes ^ np.repeat(lang, sizes))
    out = hashes[bounds[:-1]]
    for i in range(1, int(sizes.max(initial=1))):
        more = np.flatnonzero(sizes > i)
        out[more] = joined_hash(out[more], hashes[bounds[:-1][more] + i])
    return out


class BitFilter:
    """Tells hashes that are surely not in a set from those that may be."""

    def __init__(self, bits: np.ndarray):
        self.bits, self.shift = bits, np.uint64(64 - (len(bits) * 64).bit_length() + 1)

    def __call__(self, hashes: np.ndarray) -> np.ndarray:
        at = hashes >> self.shift
        return (self.bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)) & np.uint64(1)).astype(bool)


def hashed(phrases: DataFrame, salt: int) -> DataFrame:
    """``(lang, phrase, hash)`` of phrases."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = pa.array(phrase_hashes(batch.column(0), batch.column(1), salt).view(np.int64))
            yield pa.RecordBatch.from_arrays([*batch.columns, hashes], names=["lang", "phrase", "hash"])

    return phrases.select("lang", "phrase").mapInArrow(add, "lang string, phrase string, hash long")


def bit_filter(hashes: DataFrame) -> BitFilter:
    """A filter of a column ``hash``; only its bits reach the driver, at most ``MOST_BITS``."""
    n = hashes.count()
    size = LEAST_BITS
    while size < min(MOST_BITS, n * BITS_PER_PHRASE):
        size *= 2
    shift = np.uint64(64 - size.bit_length() + 1)

    def marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64) >> shift
            slot, inverse = np.unique((at >> np.uint64(6)).astype(np.int64), return_inverse=True)
            mask = np.zeros(len(slot), np.uint64)
            np.bitwise_or.at(mask, inverse, np.uint64(1) << (at & np.uint64(63)))
            yield pa.RecordBatch.from_arrays([pa.array(slot), pa.array(mask.view(np.int64))], names=["slot", "mask"])

    found = hashes.select("hash").mapInArrow(marks, "slot long, mask long")
    found = found.groupBy("slot").agg(F.bit_or("mask").alias("mask")).toArrow()
    bits = np.zeros(size // 64, np.uint64)
    bits[found["slot"].to_numpy()] = found["mask"].to_numpy().view(np.uint64)
    return BitFilter(bits)


# ---- passes over the corpus ----


def _word_counts(texts: DataFrame) -> DataFrame:
    """``(lang, phrase, n)`` of all words, written."""

    @tidy
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, values = batch.column(0), batch.column(1)
            for a, b in text_slices(values, COUNT_BYTES):
                words = Words(values[a:b], langs[a:b])
                if (rows := words.counted(1, np.arange(len(words.code)))) is not None:
                    yield rows

    return materialize(texts.mapInArrow(count, _COUNTS).groupBy("lang", "phrase").agg(F.sum("n").alias("n")), "phrase-counts")


def _salt(every: DataFrame) -> int:
    """A salt with which all words' hashes differ, from each other and from the zero between runs."""
    salt = 0
    while not hashed(every, salt).groupBy("hash").count().filter("`count` > 1 OR hash = 0").isEmpty():
        salt += 1
    return salt


def _runs(texts: DataFrame, frequent, salt: int) -> DataFrame:
    """The texts' runs of frequent words, written."""

    @tidy
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, values = batch.column(0), batch.column(1)
            for a, b in text_slices(values, COUNT_BYTES):
                yield pa.RecordBatch.from_arrays([Words(values[a:b], langs[a:b], salt).runs(frequent.value)], names=["codes"])

    return materialize(texts.mapInArrow(write, "codes array<long>"), "phrase-runs")


def _some_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[Runs]:
    for batch in batches:
        for i in range(0, batch.num_rows, ROWS):
            yield Runs(batch.column(0).slice(i, ROWS))


def _pass(runs: DataFrame, words: DataFrame, least: int, choose) -> DataFrame:
    """``(lang, phrase, n)`` of the phrases that ``choose(runs)`` names, ``(m, places)`` each; those of ``least`` and more, written.

    ``words`` are ``(lang, phrase, hash)`` of the frequent words.
    """

    @tidy
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def flush() -> pa.RecordBatch:
            found, n = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n, pa.int64())], names=["hash", "n"])

        for some in _some_runs(batches):
            held += [some.hashes(m)[at] for m, at in choose(some)]
            if sum(map(len, held)) >= HELD_HASHES:
                yield flush()
        if held:
            yield flush()

    often = runs.mapInArrow(sums, "hash long, n long").groupBy("hash").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)
    shared = runs.sparkSession.sparkContext.broadcast(bit_filter(materialize(often.select("hash"), "phrase-hashes")))

    @tidy
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[pa.RecordBatch]] = {}  # by length of phrases
        size = 0
        for some in _some_runs(batches):
            for m, at in choose(some):
                if (rows := some.counted(m, at[shared.value(some.hashes(m)[at])])) is not None:
                    held.setdefault(m, []).append(rows)
                    size += rows.num_rows
            if size >= HELD_PHRASES:
                yield from map(summed, held.values())
                held, size = {}, 0
        yield from map(summed, held.values())

    counted = runs.mapInArrow(count, "codes array<long>, n long").groupBy("codes").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)
    counted = materialize(counted, "phrase-codes")
    shared.unpersist()
    each = counted.select("codes", "n", F.posexplode("codes").alias("at", "hash")).join(words.select("lang", F.col("phrase").alias("word"), "hash"), "hash")
    named = each.groupBy("codes", "n").agg(F.min("lang").alias("lang"), F.array_sort(F.collect_list(F.struct("at", "word"))).alias("w"))
    named = named.filter(F.size("w") == F.size("codes"))  # all words are frequent
    return materialize(named.select("lang", F.array_join("w.word", " ").alias("phrase"), "n"), "phrase-counts")


def _extensions(runs: DataFrame, words: DataFrame, prefixes: DataFrame, m: int, least: int, salt: int) -> DataFrame:
    """Phrases of ``m`` words that extend ``prefixes`` by a frequent word."""
    shared = runs.sparkSession.sparkContext.broadcast(bit_filter(hashed(prefixes, salt)))

    def choose(some: Runs):
        at = np.flatnonzero(some.whole(m))
        return [(m, at[shared.value(some.hashes(m - 1)[at])])]

    grown = _pass(runs, words, least, choose)
    shared.unpersist()
    return grown.join(prefixes.select("lang", F.col("phrase").alias("prefix")), (F.substring_index("phrase", " ", m - 1) == F.col("prefix")) & grown["lang"].eqNullSafe(prefixes["lang"]), "left_semi")


def _around(runs: DataFrame, words: DataFrame, wanted: DataFrame, parts: DataFrame, longest: int, least: int, salt: int) -> DataFrame:
    """Counts of ``parts``, and of the phrases that extend ``wanted`` by a frequent word before them."""
    shared = runs.sparkSession.sparkContext.broadcast((bit_filter(hashed(parts, salt)), bit_filter(hashed(wanted, salt))))

    def choose(some: Runs):
        is_part, is_wanted = shared.value
        out = []
        for m in range(2, longest + 1):
            n = some.within(m)
            at = np.flatnonzero(some.whole(m))
            hit = is_part(some.hashes(m)[at]) if m < longest else np.zeros(len(at), bool)
            if m > 2:
                hit |= is_wanted(some.hashes(m - 1)[1 : 1 + n][at])
            out.append((m, at[hit]))
        return out

    found = _pass(runs, words, least, choose)
    shared.unpersist()
    return found


# ---- scores ----


def _exact(c: str, digits: int):
    return F.col(c).cast(f"decimal({digits},0)")


def _words(phrase):
    return F.split(phrase, " ")


def _scored(candidates: DataFrame, counts: DataFrame, share: int) -> DataFrame:
    """``candidates (lang, phrase, a, n)`` with ``l, r, score`` of the lowest-scoring cut and whether they survive."""
    cuts = candidates.withColumn("w", _words(F.col("phrase"))).withColumn("k", F.explode(F.sequence(F.lit(1), F.size("w") - 1)))
    cuts = cuts.withColumn("left", F.array_join(F.slice("w", F.lit(1), F.col("k")), " "))
    cuts = cuts.withColumn("right", F.array_join(F.slice("w", F.col("k") + 1, F.size("w")), " ")).drop("w")
    part = counts.select(F.col("lang"), F.col("phrase").alias("left"), F.col("n").alias("l"))
    cuts = cuts.join(part, ["lang", "left"]).join(part.withColumnsRenamed({"left": "right", "l": "r"}), ["lang", "right"])
    cuts = cuts.withColumn("x", _exact("a", 15) * F.lit(1000).cast("decimal(4,0)") * _exact("n", 16)).withColumn("y", _exact("l", 16) * _exact("r", 16))
    least = F.min(F.struct(F.expr("x div y").alias("score"), "k", "l", "r"))
    scored = cuts.groupBy("lang", "phrase", "a", "n").agg(least.alias("cut"))
    # a longer phrase is at most as frequent as any phrase between the two, so one word more tells all
    words = counts.filter(F.size(_words(F.col("phrase"))) > 2).withColumn("w", _words(F.col("phrase")))
    inner = F.array(F.array_join(F.slice("w", F.lit(1), F.size("w") - 1), " "), F.array_join(F.slice("w", F.lit(2), F.size("w")), " "))
    longer = words.select("lang", F.explode(inner).alias("phrase"), "n").groupBy("lang", "phrase").agg(F.max("n").alias("longer"))
    out = scored.join(longer, ["lang", "phrase"], "left")
    gone = F.coalesce(100 * F.col("longer") >= share * F.col("a"), F.lit(False))
    return out.filter(~gone).select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")


def collocations(
    docs: DataFrame, top: int = 2000, least: int = 100, longest: int = 5, share: int = 100,
    first: int | None = None, lang: str = "lang", text: str = "text",
) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: the ``top`` phrases of each language.

    Texts, in lower case for A-Z, part at ``[.,;:!?]`` and line ends into pieces, and these at spaces and tabs into
    words. Phrases have 2 to ``longest`` words of one piece and occur ``a >= least`` times; ``n`` is
    the number of the language's words. Of a phrase's cuts into parts that occur ``l`` and ``r`` times the
    one with the lowest ``floor(1000 * a * n / (l * r))`` counts, of equal ones the first. Phrases inside a
    longer one with ``100 * f >= share * a`` are dropped. Ranks go by score, then ``a``, both descending,
    then by the phrase's bytes. A null language is ``und``; null, empty and blank texts have no
    words; repeated rows count each. Other columns are ignored, whatever their names. An empty
    table, and a language without frequent phrases, give no rows.

    The driver sees a row per language, and filters of at most 16 MB. ``first`` is the largest count of a first
    word that the first wave expands; it changes the work, never the result.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text"))
    every = _word_counts(texts)
    totals = materialize(every.groupBy("lang").agg(F.sum("n").alias("n"), F.max("n").alias("most")), "phrase-langs")
    words = materialize(every.filter(F.col("n") >= least), "phrase-words")
    salt = _salt(every)
    coded = materialize(hashed(words, salt), "phrase-words")
    frequent = spark.sparkContext.broadcast(bit_filter(coded))
    runs = _runs(texts, frequent, salt)
    frequent.unpersist()

    about = {r["lang"]: (r["n"], r["most"]) for r in totals.collect()}  # a row per language
    reach = dict.fromkeys((x for x, (_, most) in about.items() if most >= least), least - 1)
    goal = dict.fromkeys(reach, first if first is not None else FIRST * least)
    grown, done, known = [], [], []  # phrases found; those scored; counts of other phrases
    total = totals.select("lang", F.col("n").alias("total"))
    while reach:
        # languages not settled go on from where they are
        limits = spark.createDataFrame([(x, before, goal[x]) for x, before in reach.items()], "lang string, low long, high long")
        limits = F.broadcast(limits)
        level = words.join(limits, "lang").filter((F.col("n") > F.col("low")) & (F.col("n") <= F.col("high"))).select("lang", "phrase", "n")
        for m in range(2, longest + 1):
            level = materialize(_extensions(runs, coded, materialize(level, "phrase-prefixes"), m, least, salt), "phrase-grown")
            grown.append(level)
            if level.isEmpty():
                break
        ends = words.select("lang", F.col("phrase").alias("end"), F.col("n").alias("last"))
        opens = words.select("lang", F.col("phrase").alias("begin"), F.col("n").alias("first"))
        found = reduce(DataFrame.unionByName, grown)
        ripe = found.withColumn("begin", F.substring_index("phrase", " ", 1)).withColumn("end", F.substring_index("phrase", " ", -1))
        ripe = ripe.join(ends, ["lang", "end"]).join(opens, ["lang", "begin"]).join(limits, "lang").join(F.broadcast(total), "lang")
        larger = F.greatest("first", "last")  # every phrase is scored in the wave that expands both its ends
        ripe = ripe.filter((larger > F.col("low")) & (larger <= F.col("high"))).select("lang", "phrase", F.col("n").alias("a"), F.col("total").alias("n"))
        ripe = materialize(ripe, "phrase-ripe")
        short = ripe.withColumn("w", _words(F.col("phrase")))
        suffixes = short.select("lang", F.explode(F.transform(F.sequence(F.lit(2), F.size("w")), lambda k: F.array_join(F.slice("w", k, F.size("w")), " "))).alias("phrase"))
        parts = materialize(suffixes.filter(F.instr("phrase", " ") > 0).distinct(), "phrase-parts")
        extended = ripe.filter(F.size(_words(F.col("phrase"))) < longest).select("lang", "phrase")
        known.append(_around(runs, coded, extended, parts, longest, least, salt))
        counts = reduce(DataFrame.unionByName, [words, found, *known]).distinct()
        done.append(materialize(_scored(ripe, counts, share), "phrase-scored"))
        order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
        ranked = reduce(DataFrame.unionByName, done).withColumn("rank", F.row_number().over(order))
        worst = {r["lang"]: r["score"] for r in ranked.filter(F.col("rank") == top).select("lang", "score").collect()}  # a row per language
        unsettled = {}
        for x in reach:
            n, most = about[x]
            if goal[x] < most and not (x in worst and worst[x] > 1000 * n // (goal[x] + 1)):
                unsettled[x] = goal[x]
                # the score can only rise: words beyond this have bounds below it
                goal[x] = min(most, 1000 * n // worst[x]) if x in worst and worst[x] else most
        reach = unsettled
    if not done:
        return spark.createDataFrame([], "lang string, rank int, phrase string, a long, l long, r long, n long, score long")
    best = ranked.filter(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    return materialize(best, "phrase-best")
