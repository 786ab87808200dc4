"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import functools
import sys
import types
import uuid
from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from homestats.session import ensure_checkpoint_dir, release, scratch_path, shuffles_removed

#: Fixed value: a word is a maximal run of characters outside these (ASCII white space).
SPACE_CHARS = "\x20\x09\x0a\x0b\x0c\x0d"
WORD = r"[^\x20\x09-\x0D]+"

#: Texts of one Arrow batch are worked on in slices of about this many bytes.
SLICE_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends there.

    The written table outlives lost executors, and what a plan reads twice is
    computed once. The shuffle files of the job go when it ends.
    """
    return materialize_parts([df], name)


def materialize_parts(parts: Iterable[DataFrame], name: str) -> DataFrame:
    """The union of ``parts`` (of one schema) written to the shared folder by a job each, one after the other."""
    path = None
    for df in parts:
        spark, schema = df.sparkSession, df.schema
        path = path or scratch_path(spark, name)
        with shuffles_removed(spark):
            df.write.mode("append").parquet(path)
    out = spark.read.schema(schema).parquet(path)
    out._scratch = path  # for ``release``
    return out


def fresh(name: str) -> str:
    """A column name that no caller's column has."""
    return f"__{name}_{uuid.uuid4().hex[:8]}"


def draw(seed: int, *cols: Column) -> Column:
    """Uniform in [0, 1) from an MD5 of the seed and columns: 52 bits, the same on every engine."""
    parts = [F.coalesce(c.cast("string"), F.lit("\\N")) for c in cols]
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), *parts).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def count_words(text: Column) -> Column:
    """Number of words of a text (null: 0), inside the JVM."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def worker_state() -> dict:
    """A dictionary that lives as long as the Python worker, across tasks.

    Code shipped by value gets new module globals for each task, so vocabularies
    and caches are kept here.
    """
    name = "llm_worker_state"
    return sys.modules.setdefault(name, types.ModuleType(name)).__dict__


def cached(key, make: Callable):
    """``make()`` once per Python worker."""
    state = worker_state()
    if key not in state:
        state[key] = make()
    return state[key]


def release_memory() -> None:
    """Give memory that Arrow and the C library hold back for later to the system: a worker may stay idle for long."""
    pa.default_memory_pool().release_unused()
    trim = cached("malloc_trim", lambda: getattr(ctypes.CDLL(None), "malloc_trim", None))
    if trim is not None:
        trim(0)


def tidy(work: Callable) -> Callable:
    """A generator function of a task that ends with ``release_memory``, when its own values are gone."""

    @functools.wraps(work)
    def run(batches):
        yield from work(batches)
        release_memory()

    return run


def text_slices(texts: pa.Array, most: int = SLICE_BYTES):
    """Consecutive slices ``(from, to)`` of about ``most`` bytes of text; a longer text is a slice alone."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends, start, n = np.cumsum(sizes), 0, len(sizes)
    while start < n:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield start, stop
        start = stop


def word_codes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """``(bounds, codes, words)``: text i has the words ``words[codes[bounds[i]:bounds[i + 1]]]``.

    Null texts have no words. Words are runs of characters outside ASCII white space.
    """
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    lists = pc.ascii_split_whitespace(texts)
    bounds = lists.offsets.to_numpy().astype(np.int64)
    encoded = lists.values[bounds[0] : bounds[-1]].dictionary_encode()
    bounds = bounds - bounds[0]
    codes, words = encoded.indices.to_numpy(zero_copy_only=False), encoded.dictionary
    empty = pc.index(words, "").as_py()
    if empty >= 0:  # white space at a text's start or end leaves an empty piece
        keep = codes != empty
        bounds = np.concatenate(([0], np.cumsum(keep)))[bounds]
        codes = codes[keep]
    return bounds, codes, words


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers (the finalizer of splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def word_hashes(words: pa.Array) -> np.ndarray:
    """A 64-bit hash per word."""
    from xxhash import xxh64_intdigest

    return np.fromiter((xxh64_intdigest(w) for w in words.to_pylist()), np.uint64, len(words))


def shingle_hashes(hashes: np.ndarray, bounds: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """``(shingles, bounds)`` of runs of ``width`` words; a text of 1 to ``width - 1`` words is one shingle."""
    n = len(hashes)
    sizes = np.diff(bounds)
    out_sizes = np.where(sizes >= width, sizes - width + 1, (sizes > 0).astype(np.int64))
    out_bounds = np.concatenate(([0], np.cumsum(out_sizes)))
    total = int(out_bounds[-1])
    if not total:
        return np.empty(0, np.uint64), out_bounds
    starts = np.repeat(bounds[:-1] - out_bounds[:-1], out_sizes) + np.arange(total)
    ends = np.repeat(bounds[1:], out_sizes)
    acc = np.full(total, width, np.uint64)
    for i in range(width):
        at = starts + i
        inside = at < ends
        part = np.where(inside, hashes[np.minimum(at, n - 1)], np.uint64(i + 1))
        acc = mix64(acc * np.uint64(0x9E3779B97F4A7C15) + part)
    return acc, out_bounds


__all__ = [
    "SLICE_BYTES",
    "SPACE_CHARS",
    "WORD",
    "cached",
    "count_words",
    "draw",
    "ensure_checkpoint_dir",
    "fresh",
    "materialize",
    "materialize_parts",
    "mix64",
    "release",
    "release_memory",
    "scratch_path",
    "shingle_hashes",
    "table",
    "text_slices",
    "tidy",
    "word_codes",
    "word_hashes",
    "worker_state",
]
