"""WARC archives as a Python data source.

``spark.read.format("warc")`` plans partitions from file sizes, takes over
predicates on record headers, parses a record's headers first and passes over the
blocks of records that a predicate rejects or whose payload isn't asked for.
``df.write.format("warc")`` writes one archive per task; archives appear in the
folder when the whole job has succeeded.
"""

from __future__ import annotations

import base64
import gzip
import io
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource, DataSourceArrowWriter, DataSourceReader, EqualNullSafe, EqualTo, GreaterThan, GreaterThanOrEqual, In,
    InputPartition, IsNotNull, IsNull, LessThan, LessThanOrEqual, Not, StringContains, StringEndsWith, StringStartsWith,
    WriterCommitMessage,
)

#: Columns that come from a record's WARC headers; predicates on them are pushed down.
HEADER_FIELDS = {
    "record_type": "warc-type", "record_id": "warc-record-id", "refers_to": "warc-refers-to", "target_uri": "warc-target-uri",
    "date": "warc-date", "content_type": "content-type", "payload_digest": "warc-payload-digest",
}
SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in HEADER_FIELDS]
    + [T.StructField("payload_bytes", T.LongType()), T.StructField("payload", T.BinaryType())]
)
_ARROW = pa.schema([(c, pa.string()) for c in HEADER_FIELDS] + [("payload_bytes", pa.int64()), ("payload", pa.binary())])

VERSION = b"WARC/1.1\r\n"
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = "application/http; msgtype=response"

SPLIT_BYTES = 64 << 20
BATCH_BYTES = 16 << 20


def _file_system(path: str):
    """The file system of a path or URI, and the path in it."""
    from pyarrow import fs

    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    if path.startswith("/"):
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(path)


# ---- records ----


def _field(name: str, value: str | None) -> str:
    return "" if value is None else f"{name}: {value.replace(chr(13), '%0D').replace(chr(10), '%0A')}\r\n"


def record_bytes(kind: str, fields: dict[str, str | None], head: bytes, payload: bytes) -> bytes:
    """One WARC record; its block is ``head`` (the HTTP headers) and the payload."""
    lines = "".join(_field(k, v) for k, v in {"WARC-Type": kind, **fields, "Content-Length": str(len(head) + len(payload))}.items())
    return b"".join((VERSION, lines.encode(), b"\r\n", head, payload, b"\r\n\r\n"))


def http_head(payload_bytes: int) -> bytes:
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {payload_bytes}\r\n\r\n".encode()


def _read_headers(stream) -> dict[str, str] | None:
    """Headers of the next record by lower-case name, or None at the end."""
    line = stream.readline()
    while line in (b"\r\n", b"\n"):
        line = stream.readline()
    if not line:
        return None
    if not line.startswith(b"WARC/"):
        raise ValueError(f"not a WARC record: {line[:40]!r}")
    fields: dict[str, str] = {}
    while (line := stream.readline()) not in (b"\r\n", b"\n", b""):
        name, _, value = line.decode("utf-8", "replace").partition(":")
        fields[name.strip().lower()] = value.strip()
    return fields


def _pass_over(stream, size: int, seekable: bool) -> None:
    if seekable:
        stream.seek(size, io.SEEK_CUR)
        return
    while size > 0 and (got := len(stream.read(min(size, 1 << 20)))):
        size -= got


def holds(f, row: dict) -> bool:
    """Whether a pushed-down predicate holds for a record's header fields."""
    if isinstance(f, Not):
        child = f.child
        # a comparison with a missing value is unknown, and so is its negation
        return (isinstance(child, (IsNull, IsNotNull, EqualNullSafe)) or row[child.attribute[0]] is not None) and not holds(child, row)
    value = row[f.attribute[0]]
    if isinstance(f, IsNull):
        return value is None
    if isinstance(f, IsNotNull):
        return value is not None
    if isinstance(f, EqualNullSafe):
        return value == f.value
    if value is None or getattr(f, "value", "") is None:
        return False
    if isinstance(f, EqualTo):
        return value == f.value
    if isinstance(f, In):
        return value in f.value
    if isinstance(f, StringStartsWith):
        return value.startswith(f.value)
    if isinstance(f, StringEndsWith):
        return value.endswith(f.value)
    if isinstance(f, StringContains):
        return f.value in value
    a, b = value.encode(), f.value.encode()  # as Spark compares strings
    return a > b if isinstance(f, GreaterThan) else a >= b if isinstance(f, GreaterThanOrEqual) else a < b if isinstance(f, LessThan) else a <= b


def _pushable(f) -> bool:
    if isinstance(f, Not):
        return _pushable(f.child)
    kinds = (EqualNullSafe, EqualTo, GreaterThan, GreaterThanOrEqual, In, IsNotNull, IsNull, LessThan, LessThanOrEqual, StringContains, StringEndsWith, StringStartsWith)
    if not isinstance(f, kinds) or len(f.attribute) != 1 or f.attribute[0] not in HEADER_FIELDS:
        return False
    return not (isinstance(f, In) and None in f.value)


def read_records(stream, filters: list, want_payload: bool, seekable: bool) -> Iterator[dict]:
    """Records of an open archive that hold all ``filters``."""
    while (fields := _read_headers(stream)) is not None:
        size = int(fields.get("content-length", "0"))
        row = {c: fields.get(h) for c, h in HEADER_FIELDS.items()}
        if row["payload_digest"]:
            row["payload_digest"] = row["payload_digest"].rpartition(":")[2]
        if not all(holds(f, row) for f in filters):
            _pass_over(stream, size, seekable)
            continue
        length, payload = size, None
        if (row["content_type"] or "").startswith("application/http"):
            # the block's own headers tell the payload's size, of a revisit too, whose payload is elsewhere
            while size and (line := stream.readline(size)):
                size -= len(line)
                if line in (b"\r\n", b"\n"):
                    break
                name, _, value = line.partition(b":")
                if name.strip().lower() == b"content-length":
                    length = int(value)
        if want_payload and row["record_type"] != "revisit":
            payload = stream.read(size)
        else:
            _pass_over(stream, size, seekable)
        yield row | {"payload_bytes": length, "payload": payload}


# ---- the data source ----


@dataclass
class FileGroup(InputPartition):
    files: tuple[str, ...]


class WarcReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.want_payload = str(options.get("payload", "true")).lower() == "true"
        self.split_bytes = int(options.get("splitbytes", options.get("splitBytes", SPLIT_BYTES)))
        self.filters: list = []

    def pushFilters(self, filters: list):  # noqa: N802 - the name is Spark's
        for f in filters:
            if _pushable(f):
                self.filters.append(f)
            else:
                yield f

    def partitions(self) -> list[FileGroup]:
        """Files, largest first, grouped up to ``splitBytes``; a larger file is a partition alone.

        Names that begin with ``_`` or ``.`` are not archives.
        """
        from pyarrow import fs

        system, root = _file_system(self.path)
        listed = system.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True))
        files = [f for f in listed if f.is_file and not any(p[:1] in "_." for p in f.path[len(root) :].strip("/").split("/"))]
        groups: list[FileGroup] = []
        names: list[str] = []
        room = self.split_bytes
        for f in sorted(files, key=lambda f: (-f.size, f.path)):
            if names and f.size > room:
                groups.append(FileGroup(tuple(names)))
                names, room = [], self.split_bytes
            names.append(f.path)
            room -= f.size
        return [*groups, FileGroup(tuple(names))]

    def read(self, partition: FileGroup) -> Iterator[pa.RecordBatch]:
        system, _ = _file_system(self.path)
        rows, held = [], 0
        for path in partition.files:
            with system.open_input_file(path) as raw:
                zipped = path.endswith(".gz")
                stream = gzip.GzipFile(fileobj=raw) if zipped else io.BufferedReader(raw, 1 << 18)
                for row in read_records(stream, self.filters, self.want_payload, not zipped):
                    rows.append(row)
                    held += 500 + len(row["payload"] or b"")
                    if held >= BATCH_BYTES:
                        yield pa.RecordBatch.from_pylist(rows, _ARROW)
                        rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, _ARROW)


@dataclass
class Written(WriterCommitMessage):
    path: str | None


class WarcWriter(DataSourceArrowWriter):
    """Writes rows ``(record_type, record_id, refers_to, target_uri, payload_sha1, payload_bytes, payload)``.

    ``payload_sha1`` is hexadecimal; a revisit's payload is null, its size and digest those of the
    record it refers to. Each attempt of a task has a file of its own in a folder ``_temporary-...``; only those
    of the attempts that Spark accepts are moved to the folder.
    """

    def __init__(self, options: dict, overwrite: bool):
        self.path, self.date = options["path"], options.get("date", "1970-01-01T00:00:00Z")
        self.zipped = options.get("compression", "none") == "gzip"
        self.job, self.overwrite = uuid.uuid4().hex, overwrite

    def _record(self, row: dict) -> bytes:
        digest = base64.b32encode(bytes.fromhex(row["payload_sha1"])).decode()
        revisit = row["record_type"] == "revisit"
        fields = {
            "WARC-Record-ID": row["record_id"], "WARC-Date": self.date, "WARC-Target-URI": row["target_uri"],
            "WARC-Payload-Digest": f"sha1:{digest}", "WARC-Refers-To": row["refers_to"] if revisit else None,
            "WARC-Profile": IDENTICAL if revisit else None, "Content-Type": HTTP,
        }
        return record_bytes(row["record_type"], fields, http_head(row["payload_bytes"]), row["payload"] or b"")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        system, root = _file_system(self.path)
        folder = f"{root}/_temporary-{self.job}"
        path, out = f"{folder}/{uuid.uuid4().hex}.warc{'.gz' if self.zipped else ''}", None
        pack = gzip.compress if self.zipped else bytes
        for batch in iterator:
            for i in range(batch.num_rows):
                if out is None:
                    system.create_dir(folder, recursive=True)
                    out = system.open_output_stream(path, compression=None)  # records are gzip members one by one
                    about = {"WARC-Record-ID": f"<urn:uuid:{uuid.uuid4()}>", "WARC-Date": self.date, "Content-Type": "application/warc-fields"}
                    out.write(pack(record_bytes("warcinfo", about, b"", b"format: WARC File Format 1.1\r\n")))
                row = {n: batch.column(k)[i].as_py() for k, n in enumerate(batch.schema.names)}
                out.write(pack(self._record(row)))
        if out is None:
            return Written(None)
        out.close()
        return Written(path)

    def commit(self, messages: list[Written | None]) -> None:
        system, root = _file_system(self.path)
        if self.overwrite:
            from pyarrow import fs

            for f in system.get_file_info(fs.FileSelector(root, allow_not_found=True)):
                if f.is_file:
                    system.delete_file(f.path)
        system.create_dir(root, recursive=True)
        for i, m in enumerate(messages):
            if m is not None and m.path:
                ending = m.path.rpartition("/")[2].partition(".")[2]
                system.move(m.path, f"{root}/part-{i:05d}-{self.job}.{ending}")
        self._clean(system, root)

    def abort(self, messages: list[Written | None]) -> None:
        self._clean(*_file_system(self.path))

    def _clean(self, system, root: str) -> None:
        from pyarrow import fs

        if system.get_file_info(f"{root}/_temporary-{self.job}").type == fs.FileType.Directory:
            system.delete_dir(f"{root}/_temporary-{self.job}")


class WarcDataSource(DataSource):
    """Format ``warc``. Options of reads: ``payload`` (false: payloads are passed over and null), ``splitBytes``."""

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> T.StructType:
        return SCHEMA

    def reader(self, schema: T.StructType) -> WarcReader:
        return WarcReader(dict(self.options))

    def writer(self, schema: T.StructType, overwrite: bool) -> WarcWriter:
        return WarcWriter(dict(self.options), overwrite)


def register(spark: SparkSession) -> None:
    """Make format ``warc`` known to the session and let it take predicates."""
    spark.dataSource.register(WarcDataSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


# ---- pages as archives ----


def _urn(page: F.Column) -> F.Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page.cast("string"), F.lit("none")), F.lit(">"))


def page_records(pages: DataFrame, min_bytes: int = 0, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Rows for the writer: of pages with equal payloads, the one with the largest id is the response.

    The others are revisits that refer to it. Payloads of under ``min_bytes`` bytes are responses all.
    A null page is empty. Rows without an id rank below all others; repeated rows of the largest id
    are responses all, and so are equal payloads without any id. Other columns are ignored, whatever their
    names; an empty table gives no records.
    """
    payload = F.coalesce(F.col(html), F.lit("")).cast("binary")
    rows = pages.select(
        F.col(page_id).alias("page"), F.col(url).cast("string").alias("target_uri"), payload.alias("whole"),
        F.sha1(payload).alias("payload_sha1"), F.octet_length(payload).cast("long").alias("payload_bytes"),
    )
    # narrow: no payload is moved to find equal ones
    groups = rows.groupBy("payload_sha1").agg(F.max("page").alias("kept"), F.count(F.lit(1)).alias("n"))
    repeated = groups.filter(F.col("n") > 1).select("payload_sha1", "kept")
    joined = rows.join(repeated, "payload_sha1", "left")
    revisit = (F.col("payload_bytes") >= min_bytes) & F.col("kept").isNotNull() & ~F.col("page").eqNullSafe(F.col("kept"))
    return joined.select(
        F.when(revisit, "revisit").otherwise("response").alias("record_type"), _urn(F.col("page")).alias("record_id"),
        F.when(revisit, _urn(F.col("kept"))).alias("refers_to"), "target_uri", "payload_sha1", "payload_bytes",
        F.when(~revisit, F.col("whole")).alias("payload"),
    )


def write_pages(pages: DataFrame, path: str, min_bytes: int = 0, compression: str = "gzip", **columns: str) -> None:
    """Write a record per page to archives in the folder ``path``, each record a gzip member unless ``compression`` is ``none``."""
    register(pages.sparkSession)
    page_records(pages, min_bytes, **columns).write.format("warc").option("compression", compression).mode("append").save(path)


def read_pages(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """Page records of the archives in ``path``; records of other types are passed over."""
    register(spark)
    records = spark.read.format("warc").option("payload", str(payload).lower()).load(path)
    number = lambda c: F.nullif(F.regexp_extract(c, "^<urn:page:(.*)>$", 1), F.lit("none")).try_cast("long")
    return records.filter(F.col("record_type").isin("response", "revisit")).select(
        number("record_id").alias("page_id"), "target_uri", "payload_bytes", "payload_digest", "record_type",
        number("refers_to").alias("refers_to"), "payload",
    )
