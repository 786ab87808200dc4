"""Token ids in Arrow stream files of equal-length sequences.

Documents are put in order of their ids by a range shuffle; each task encodes its
range and writes files as it goes. A file ``*.sequences.arrow`` is an Arrow stream whose
batches hold ``ids`` and ``mask`` (a bit each), fixed-size lists of one length without nulls, so
all batches but the last take the same number of bytes: a reader finds any sequence of a
memory-mapped file by arithmetic and gets views of the map, no copies. Beside it,
``*.documents.arrow`` has a row per document with its place in the file. The documents
of a file follow each other without a gap; only a file's last sequence is padded. The
manifest, a table that Spark writes last, lists the files of the accepted task attempts in order.
"""

from __future__ import annotations

import json
import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from homestats.llm.common import cached, text_slices, tidy
from homestats.llm.packing import WordEncoder, without_marks

#: Sequences of a batch, and ids after which a task begins a new file (at a document's end).
BATCH_SEQUENCES = 64
FILE_IDS = 1 << 26
MANIFEST = "_manifest"
#: White space of any kind at a piece's end, or an empty piece: what follows is not parted from it.
SPACES = r"\s\x{0b}\x{1c}-\x{1f}\x{85}\p{Z}"
OPEN_END = rf"^$|[{SPACES}]$"
#: A unit of several lines, without other white space than a line end between two lines.
LINES = rf"^ ?[^{SPACES}]+(\n[^{SPACES}]+)+$"
#: Parts of units whose ids a Python worker remembers; when there are more, only those of the texts at hand are kept.
REMEMBERED_UNITS = 500_000
#: Texts are encoded in slices of about this many bytes.
ENCODE_BYTES = 16 << 20


# ---- encoding ----


class PieceEncoder(WordEncoder):
    """Token ids of texts under a byte-level tokenizer, each distinct part of a unit given to it once.

    Byte-level pre-tokenization always parts a text before white space that follows
    a visible character, so a text's ids are those of its units: pieces between such spaces, with the
    space before them. Single line ends between visible characters part units, and so do closing marks
    after letters. Tokenizers of another make get whole texts.
    """

    between = mark = "\n"
    joinable = rf"^ ?[^<{SPACES}]+$"

    def __init__(self, path: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        made = json.loads(self.tokenizer.to_str())
        parts = made["pre_tokenizer"] or {}
        simple = parts.get("type") == "ByteLevel" and parts.get("use_regex", True) and not parts["add_prefix_space"] and not made["normalizer"]
        plain = all(not (t["lstrip"] or t["rstrip"] or t["single_word"] or re.search(r"\s", t["content"])) for t in made["added_tokens"])
        self.by_units = bool(simple and plain)
        self.direct = self.by_units and self._foresee([" a", " The", "straightforward", " zzQxv", "don", " Émíñß", "àÿÞ"])
        self._forget()

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]  # without offsets

    def _most(self) -> int:
        return REMEMBERED_UNITS

    def _folded(self, words: pa.Array) -> pa.Array:
        return words

    def _words(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
        """``(bounds, codes, units)``: text i has the units ``units[codes[bounds[i]:bounds[i + 1]]]``."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        if not self.by_units:
            return np.arange(len(texts) + 1), np.arange(len(texts)), texts
        lists = pc.split_pattern(texts, " ")
        bounds = lists.offsets.to_numpy().astype(np.int64)
        encoded = lists.values[bounds[0] : bounds[-1]].dictionary_encode()
        bounds = bounds - bounds[0]
        codes, pieces = encoded.indices.to_numpy(zero_copy_only=False).astype(np.int64), encoded.dictionary
        first = np.zeros(len(codes), bool)
        first[bounds[:-1]] = True  # every text has a piece, if an empty one
        is_open = pc.match_substring_regex(pieces, OPEN_END).to_numpy(zero_copy_only=False)
        glued = np.concatenate(([False], is_open[codes[:-1]])) & ~first
        starts = np.flatnonzero(~glued)
        sizes = np.diff(np.append(starts, len(codes)))
        # a piece after a space, one without, or several
        n = len(pieces)
        key = codes[starts] + n * first[starts]
        joined: dict[str, int] = {}
        for i in np.flatnonzero(sizes > 1).tolist():
            a = starts[i]
            text = " ".join(pieces.take(pa.array(codes[a : a + sizes[i]])).to_pylist())
            key[i] = 2 * n + joined.setdefault(text if first[a] else " " + text, len(joined))
        seen = np.zeros(2 * n + len(joined), bool)
        seen[key] = True
        spaced = pc.binary_join_element_wise(pa.scalar("", pieces.type), pieces, pa.scalar(" ", pieces.type))
        units = pa.concat_arrays([spaced, pieces, pa.array(list(joined), pieces.type)])
        return np.searchsorted(starts, bounds), (np.cumsum(seen) - 1)[key], units.take(pa.array(np.flatnonzero(seen)))

    def _parts(self, words: pa.Array) -> tuple[np.ndarray, pa.Array]:
        if not self.direct:
            return super()._parts(words)
        lines = np.flatnonzero(pc.match_substring_regex(words, LINES).to_numpy(zero_copy_only=False))
        lists = pc.split_pattern(words.take(pa.array(lines)), "\n")
        ends = lists.offsets.to_numpy().astype(np.int64)
        n, sizes = len(words), np.ones(len(words), np.int64)
        sizes[lines] = 2 * np.diff(ends) - 1
        bounds = np.concatenate(([0], np.cumsum(sizes)))
        which = np.full(int(bounds[-1]), n)  # a line end, unless told otherwise
        alone = np.delete(np.arange(n), lines)
        which[bounds[alone]] = alone
        owner = np.repeat(np.arange(len(lines)), np.diff(ends))
        nth = np.arange(int(ends[-1])) - ends[owner]
        which[bounds[lines[owner]] + 2 * nth] = n + 1 + np.arange(len(owner))
        every = pa.concat_arrays([words, pa.array(["\n"], words.type), lists.values])
        part_bounds, parts = without_marks(every.take(pa.array(which)))
        return part_bounds[bounds], parts

    def encode(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """``(bounds, ids)``; each text's ids end with ``end_id``."""
        found = super().encode(texts, end_id)
        if not self.by_units:
            self._forget()
        return found


# ---- files ----


def file_system(path: str):
    """The file system of a path or URI, and the path in it."""
    from pyarrow import fs

    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    if path.startswith("/"):
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(path)


def sequence_schema(length: int, id_type: str, per_batch: int) -> pa.Schema:
    """Schema of a sequence file; its metadata has what a reader needs to find a sequence."""
    return pa.schema(
        [pa.field(n, pa.list_(pa.field("item", pa.type_for_alias(t), nullable=False), length), nullable=False) for n, t in (("ids", id_type), ("mask", "bool"))],
        {"sequence_length": str(length), "sequences_per_batch": str(per_batch)},
    )


class SequenceWriter:
    """Writes a stream of ids as sequences of one length; the mask is 1 at ids and 0 at the padding after the last one."""

    def __init__(self, sink, length: int, id_type: str, per_batch: int = BATCH_SEQUENCES, pad_id: int = 0):
        self.schema = sequence_schema(length, id_type, per_batch)
        self.length, self.dtype, self.room, self.pad_id = length, np.dtype(id_type), length * per_batch, pad_id
        self.out = pa.ipc.new_stream(sink, self.schema)
        self.held: list[np.ndarray] = []
        self.n_held = self.n_ids = self.n_sequences = 0

    def add(self, ids: np.ndarray) -> None:
        self.n_ids += len(ids)
        while len(ids):
            part = ids[: self.room - self.n_held]
            self.held.append(part.astype(self.dtype))
            self.n_held += len(part)
            ids = ids[len(part) :]
            if self.n_held == self.room:
                self._flush()

    def _flush(self) -> None:
        flat = np.concatenate(self.held)
        mask = np.ones(len(flat), bool)
        if rest := -len(flat) % self.length:
            flat = np.concatenate([flat, np.full(rest, self.pad_id, self.dtype)])
            mask = np.concatenate([mask, np.zeros(rest, bool)])
        columns = [pa.FixedSizeListArray.from_arrays(pa.array(x), type=f.type) for x, f in zip((flat, mask), self.schema, strict=True)]
        self.out.write_batch(pa.RecordBatch.from_arrays(columns, schema=self.schema))
        self.n_sequences += len(flat) // self.length
        self.held, self.n_held = [], 0

    def close(self) -> None:
        if self.n_held:
            self._flush()
        self.out.close()


class SequenceFile:
    """Random access to a sequence file: ``file[i]`` is ``(ids, mask)``, a numpy array and an Arrow one of a bit per id.

    Both are views of the memory map of a local file. Only the file's schema, its first and
    last batches' headers and the batches asked for are read.
    """

    def __init__(self, path: str):
        system, place = file_system(path)
        self.source = pa.memory_map(place) if system.type_name == "local" else system.open_input_file(place)
        self.schema = pa.ipc.read_schema(pa.ipc.read_message(self.source))
        about = self.schema.metadata
        self.length, self.per_batch = int(about[b"sequence_length"]), int(about[b"sequences_per_batch"])
        self.start = self.source.tell()
        self.at, self.batch = -1, None
        end = self.source.size() - 8  # of the last batch: the end mark follows
        if end <= self.start:
            self.step, self.n = 1, 0
            return
        pa.ipc.read_message(self.source)
        self.step = self.source.tell() - self.start
        last = (end - self.start - 1) // self.step
        self.n = last * self.per_batch + self._batch(last).num_rows

    def _batch(self, number: int) -> pa.RecordBatch:
        if number != self.at:
            self.source.seek(self.start + number * self.step)
            self.at, self.batch = number, pa.ipc.read_record_batch(pa.ipc.read_message(self.source), self.schema)
        return self.batch

    def __len__(self) -> int:
        return self.n

    def __getitem__(self, i: int) -> tuple[np.ndarray, pa.BooleanArray]:
        if not 0 <= i < self.n:
            raise IndexError(i)
        batch, at = self._batch(i // self.per_batch), i % self.per_batch * self.length
        ids, mask = (batch.column(c).values.slice(at, self.length) for c in range(2))
        return ids.to_numpy(), mask

    def runs(self, start: int, n: int) -> Iterator[np.ndarray]:
        """The ``n`` ids from place ``start`` of the file on, as views, one per batch."""
        room = self.per_batch * self.length
        while n > 0:
            at = start % room
            some = min(n, room - at)
            yield self._batch(start // room).column(0).values.slice(at, some).to_numpy()
            start, n = start + some, n - some


# ---- Spark ----

_MANIFEST = T.StructType(
    [T.StructField("part", T.IntegerType()), T.StructField("number", T.IntegerType()), T.StructField("file", T.StringType())]
    + [T.StructField(x, T.LongType()) for x in ("n_documents", "n_ids", "n_sequences")]
)
_FILES = pa.schema([("part", pa.int32()), ("number", pa.int32()), ("file", pa.string())] + [(x, pa.int64()) for x in ("n_documents", "n_ids", "n_sequences")])


def write_sequences(
    docs: DataFrame, path: str, tokenizer_path: str, length: int = 2048, end_id: int = 2,
    doc_id: str = "doc_id", text: str = "text", file_ids: int = FILE_IDS, per_batch: int = BATCH_SEQUENCES,
) -> None:
    """Encode all documents and write them in ascending order of ids to sequence files in the new folder ``path``.

    A document's ids end with ``end_id``, so a null or empty text has one id. Special strings in
    a text are what the tokenizer takes them for. Documents without an id come first; those
    of equal ids are in order of their texts' hashes, so their order is the same in each run. Ids are kept
    in 16 bits where the vocabulary allows it, else in 32. Other columns are ignored, whatever their
    names. An empty table gives a manifest without files. Files of failed task attempts stay unlisted.
    """
    system, root = file_system(path)
    system.create_dir(root, recursive=True)
    key_type = docs.select(doc_id).schema[0].dataType
    rows = docs.select(F.col(doc_id).cast(key_type).alias("doc_id"), F.col(text).cast("string").alias("text"))
    rows = rows.withColumn("digest", F.xxhash64("text")).withColumn("row", F.monotonically_increasing_id())
    # rows of one id may be many: they are dealt over several ranges by hash, equal ones by their place
    ordered = rows.repartitionByRange("doc_id", "digest", "row").sortWithinPartitions("doc_id", "digest", "row").select("doc_id", "text")

    @tidy
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = cached(("units", tokenizer_path), lambda: PieceEncoder(tokenizer_path))
        id_type = "uint16" if max(encoder.tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else "uint32"
        system, root = file_system(path)
        part, attempt, number, listed = TaskContext.get().partitionId(), uuid.uuid4().hex, 0, []
        out = sink = None
        held: list[tuple[pa.Array, np.ndarray, np.ndarray]] = []

        def close() -> None:
            nonlocal out, sink, number
            out.close()
            sink.close()
            columns = [pa.concat_arrays([h[0] for h in held])] + [pa.array(np.concatenate([h[i] for h in held]), pa.int64()) for i in (1, 2)]
            table = pa.table(columns, names=["doc_id", "start", "n_tokens"])
            with system.open_output_stream(f"{root}/{name}.documents.arrow", compression=None) as f, pa.ipc.new_stream(f, table.schema) as writer:
                writer.write_table(table, max_chunksize=1 << 16)
            listed.append((part, number, name, table.num_rows, out.n_ids, out.n_sequences))
            held.clear()
            out, number = None, number + 1

        for batch in batches:
            keys, texts = batch.column(0), batch.column(1)
            for a, b in text_slices(texts, ENCODE_BYTES):
                bounds, ids = encoder.encode(texts[a:b], end_id)
                i = 0
                while i < b - a:
                    if out is None:
                        name = f"part-{part:06d}-{number:04d}-{attempt}"
                        sink = system.open_output_stream(f"{root}/{name}.sequences.arrow", compression=None)
                        out = SequenceWriter(sink, length, id_type, per_batch, end_id)
                    # documents up to the one that fills the file
                    j = min(b - a, int(np.searchsorted(bounds, bounds[i] + file_ids - out.n_ids)))
                    j = max(j, i + 1)
                    held.append((keys[a + i : a + j], out.n_ids + bounds[i:j] - bounds[i], np.diff(bounds[i : j + 1])))
                    out.add(ids[bounds[i] : bounds[j]])
                    i = j
                    if out.n_ids >= file_ids:
                        close()
        if out is not None:
            close()
        yield pa.RecordBatch.from_pylist([dict(zip(_FILES.names, row, strict=True)) for row in listed], _FILES)

    ordered.mapInArrow(write, _MANIFEST).write.parquet(f"{path}/{MANIFEST}")


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """A row per file, with the numbers of ids and sequences in the files before it.

    The running sums see one row per file, never one per document.
    """
    files = spark.read.schema(_MANIFEST).parquet(f"{path}/{MANIFEST}")
    before = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)
    sums = [F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_before") for c in ("n_ids", "n_sequences")]
    listed = files.select("*", *sums)
    return listed.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))


def read_documents(spark: SparkSession, path: str, id_type: T.DataType | None = None) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of every document of a folder, from its files.

    ``start`` is the number of ids of all documents before it. The checksum is that of the ids
    as little-endian unsigned 32-bit integers, read from the sequences.
    """
    schema = T.StructType([T.StructField("doc_id", id_type or T.LongType()), *[T.StructField(x, T.LongType()) for x in ("start", "n_tokens", "ids_crc32")]])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = file_system(path)
        for batch in batches:
            for name, base in zip(batch.column("file").to_pylist(), batch.column("n_ids_before").to_pylist(), strict=True):
                ids = SequenceFile(f"{path}/{name}.sequences.arrow")
                with system.open_input_stream(f"{root}/{name}.documents.arrow", compression=None) as f, pa.ipc.open_stream(f) as stream:
                    for rows in stream:
                        starts, sizes = (rows.column(c).to_numpy() for c in (1, 2))
                        sums = np.zeros(len(starts), np.int64)
                        for i, (s, n) in enumerate(zip(starts.tolist(), sizes.tolist(), strict=True)):
                            crc = 0
                            for run in ids.runs(s, n):
                                crc = zlib.crc32(run.astype("<u4"), crc)
                            sums[i] = crc
                        yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(starts + base), rows.column(2), pa.array(sums)], names=schema.names)

    return manifest(spark, path).mapInArrow(read, schema)


def read_sequences(spark: SparkSession, path: str) -> DataFrame:
    """``(sequence_id, ids, mask)`` of every sequence of a folder, in numbers of the files' order."""
    schema = "sequence_id long, ids array<int>, mask array<boolean>"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, base in zip(batch.column("file").to_pylist(), batch.column("n_sequences_before").to_pylist(), strict=True):
                file = SequenceFile(f"{path}/{name}.sequences.arrow")
                for first in range(0, len(file), file.per_batch):
                    some = file._batch(first // file.per_batch)
                    number = pa.array(np.arange(base + first, base + first + some.num_rows))
                    ids, mask = (some.column(c).cast(pa.list_(t)) for c, t in ((0, pa.int32()), (1, pa.bool_())))
                    yield pa.RecordBatch.from_arrays([number, ids, mask], names=["sequence_id", "ids", "mask"])

    return manifest(spark, path).mapInArrow(read, schema)
