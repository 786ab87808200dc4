"""File-level scans of an export folder: listing, classification, per-file
overview and header consistency. Each is one distributed scan; no file is
opened by driver code."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from homestats.functions.coerce import round_half_even

from homestats.functions import fields as FD
from homestats.sources.records import split_states
from homestats.sources.tables import BOMS

_FILES_SCHEMA = "path string, name string, source string, length long"


def source_name(path):
    """The monthly source a file stands for: its name without extension (and ``.gz``), or — for a
    Spark part file — the folder holding it (e.g. ``source=ExportSold202401``)."""
    name = F.substring_index(path, "/", -1)
    parent = F.substring_index(F.substring_index(path, "/", -2), "/", 1)
    return F.when(name.startswith("part-"), parent).otherwise(F.regexp_replace(name, r"\.[^.]*(\.gz)?$", ""))


def list_sources(spark: SparkSession, path: str, pattern: str = FD.CSV_FILES, recursive: bool = False, modified: bool = False) -> DataFrame:
    """``(path, name, source, length)`` of matching files, on request with their times of
    modification in microseconds (``modified``).

    File contents are never read."""
    try:
        df = (
            spark.read.format("binaryFile")
            .option("pathGlobFilter", pattern)
            .option("recursiveFileLookup", str(bool(recursive)).lower())
            .load(path)
        )
    except Exception as exc:  # noqa: BLE001 - missing or empty folder
        if "PATH_NOT_FOUND" in str(exc) or "does not exist" in str(exc) or "UNABLE_TO_INFER" in str(exc):
            return spark.createDataFrame([], _FILES_SCHEMA + (", modified long" if modified else ""))
        raise
    return df.select(
        "path", F.element_at(F.split("path", "/"), -1).alias("name"), source_name(F.col("path")).alias("source"), "length",
        *([F.unix_micros("modificationTime").alias("modified")] if modified else []),
    )


def classify_sources(files: DataFrame, rules: Sequence[tuple[str, str]] = FD.SOURCE_CLASSES, on: str = "source") -> DataFrame:
    """One row per (file, class): a file may fall in several classes, or in ``other``.

    Matching is a substring test on the source name (``on``)."""
    hits = F.filter(
        F.array(*[F.when(F.col(on).contains(sub), F.lit(label)) for sub, label in rules]),
        lambda x: x.isNotNull(),
    )
    return files.select(
        "path", "name", "source",
        F.explode(F.when(F.size(hits) > 0, hits).otherwise(F.array(F.lit("other")))).alias("class"),
    )


def _lines(spark: SparkSession, path, pattern: str, recursive: bool, encoding: str) -> DataFrame:
    """Physical lines of every file, decoded, with the split they came from and a row id.

    Lines are split at newline bytes, so any ASCII-compatible encoding does. Files
    are read in splits, never as one in-memory row per file.
    """
    reader = spark.read.option("pathGlobFilter", pattern).option("recursiveFileLookup", str(bool(recursive)).lower())
    return reader.text(path).select(
        F.col("_metadata.file_path").alias("path"), F.decode(F.col("value").cast("binary"), encoding).alias("value"),
        F.col("_metadata.file_block_start").alias("_start"), F.monotonically_increasing_id().alias("_seq"),
    )


# Fixed value: a CSV cell, quoted (quotes inside doubled) or plain, and what ends it.
_CELL = r'("(?:[^"]|"")*"|[^,]*)(?:,|$)'


def _clean_header(line):
    """Cells of a header line: quoted names may hold commas and doubled quotes."""
    for b in BOMS:
        line = F.regexp_replace(line, "^" + b, "")
    # a closing comma keeps the last cell's end apart from the empty match after it
    cells = F.regexp_extract_all(F.concat(F.rtrim(line, F.lit("\r")), F.lit(",")), F.lit(_CELL), 1)
    cells = F.slice(cells, F.lit(1), F.size(cells) - 1)
    quoted = lambda c: F.replace(F.substring(c, F.lit(2), F.length(c) - 2), F.lit('""'), F.lit('"'))
    return F.transform(cells, lambda c: F.trim(F.when(c.rlike('(?s)^".*"$'), quoted(c)).otherwise(c)))


#: Bytes of a file that are read at a time until its first record ends.
HEAD_BYTES = 1 << 16


def _arrow_opens(path: str) -> bool:
    """Whether Arrow's file systems reach a store (Spark may read from others, too)."""
    from pyarrow import fs

    if path.startswith("file:"):
        return True
    try:
        system, place = fs.FileSystem.from_uri(path)
        return system.get_file_info(place).type == fs.FileType.File
    except Exception:  # noqa: BLE001 - an unknown scheme, or a missing client library
        return False


def _first_records(files: DataFrame, head_bytes: int) -> DataFrame:
    """``(path, line)``: the bytes of every file's first record; a task opens its files and reads no further."""
    import pyarrow as pa

    def read(batches):  # a closure: executors need no copy of this package
        from pyarrow import fs

        for batch in batches:
            out = []
            for path in batch.column(0).to_pylist():
                local = path.startswith("file:")
                system, place = (fs.LocalFileSystem(), "/" + path[5:].lstrip("/")) if local else fs.FileSystem.from_uri(path)
                held, end, at, quoted = b"", -1, 0, False
                with system.open_input_stream(place, buffer_size=None) as f:
                    while end < 0 and (more := f.read(head_bytes)):
                        held += more
                        # a line break between an odd and an even quote is part of the record
                        while end < 0 and (stop := held.find(b"\n", at)) >= 0:
                            quoted ^= held.count(b'"', at, stop) % 2 == 1
                            end, at = (-1 if quoted else stop), stop + 1
                        if end < 0:
                            quoted ^= held.count(b'"', at) % 2 == 1
                            at = len(held)
                out.append(held if end < 0 else held[:end])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=["path", "line"])

    # paths are few and short, and opening a file takes its time: they are dealt over all tasks
    n = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return files.select("path").repartition(n).mapInArrow(read, "path string, line binary")


def file_headers(spark: SparkSession, path, pattern: str = FD.CSV_FILES, recursive: bool = False, encoding: str = "UTF-8",
                 head_bytes: int = HEAD_BYTES) -> DataFrame:
    """``(path, header)``: the first record of every file as column names; an empty file has none.

    Files are opened by the tasks and read up to the first record's end, whatever their
    size; a quoted name may hold line breaks. In a store that only Spark's readers open, the
    first lines come from a scan: the lowest row id within the split starting at byte 0.
    """
    files = list_sources(spark, path, pattern, recursive)
    some = files.select("path").first()
    if some is not None and not _arrow_opens(some["path"]):
        lines = _lines(spark, path, pattern, recursive, encoding)
        first = lines.where(F.col("_start") == 0).groupBy("path").agg(F.min_by("value", "_seq").alias("line"))
    else:
        found = _first_records(files, head_bytes).filter(F.octet_length("line") > 0)
        first = found.select("path", F.decode("line", encoding).alias("line"))
    return first.select("path", _clean_header(F.col("line")).alias("header"))


def file_overview(spark: SparkSession, path: str, pattern: str = FD.CSV_FILES, recursive: bool = False,
                  encoding: str = "UTF-8", rules: Sequence[tuple[str, str]] = FD.SOURCE_CLASSES, on: str = "source",
                  multi_line: bool = True) -> DataFrame:
    """Per file and class: size in MB, physical data lines (lines - 1, as a line
    count reports them), parsed records (quoted newlines and blank lines handled),
    column count; plus one ``TOTAL`` row per class (a rollup).

    Lines and records come from one scan of the files' splits, many tasks a file, and headers from
    the files' first bytes. Without ``multi_line`` every line that isn't blank is a record."""
    listed = list_sources(spark, path, pattern, recursive)
    files = classify_sources(listed, rules, on)
    heads = file_headers(spark, path, pattern, recursive, encoding).select("path", F.size("header").alias("columns"))
    splits = split_states(spark, path, pattern, recursive, multi_line)
    # of the records of a file that has any, the first is its header
    lines = splits.groupBy("path").agg(F.sum("lines").alias("lines"), F.greatest(F.sum("records") - 1, F.lit(0)).alias("parsed"))
    lines = lines.join(heads, "path", "left")
    per = files.join(listed.select("path", "length"), "path").join(lines, "path", "left")
    per = per.select(
        "class", "path", "source", F.col("length").alias("bytes"),
        (F.coalesce(F.col("lines"), F.lit(0)) - 1).alias("rows"),
        F.coalesce(F.col("parsed"), F.lit(0)).alias("parsed_rows"), "columns",
    )
    # per file plus one TOTAL line per class (rollup); grouping sets keep a single pass
    return per.rollup("class", "path").agg(
        F.first("source").alias("source"), F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows"),
        F.sum("parsed_rows").alias("parsed_rows"), F.max("columns").alias("columns"),
    ).where(F.col("class").isNotNull()).select(
        "class", "path",
        F.when(F.col("path").isNull(), F.lit("TOTAL")).otherwise(F.col("source")).alias("source"),
        round_half_even(F.col("bytes") / (1024 * 1024), 1).alias("size_mb"), "rows", "parsed_rows",
        F.when(F.col("path").isNotNull(), F.col("columns")).alias("columns"),
    )


def header_consistency(spark: SparkSession, path: str, pattern: str = FD.CSV_FILES, recursive: bool = False,
                       encoding: str = "UTF-8", rules: Sequence[tuple[str, str]] = FD.SOURCE_CLASSES, on: str = "source",
                       unit: str = "path") -> DataFrame:
    """Per class: distinct column *sets*, files per set, the set's first file, extra /
    missing columns versus the set of the class's first file (by path).

    Files are counted, not listed: a row stays small however many files share a set. With
    ``unit="source"`` the part files of an export's folder count once."""
    heads = file_headers(spark, path, pattern, recursive, encoding)
    files = classify_sources(list_sources(spark, path, pattern, recursive), rules, on)
    per = files.join(heads, "path").select("class", "path", "source", F.array_sort(F.array_distinct("header")).alias("cols"))
    sets = per.groupBy("class", "cols").agg(_units(unit).alias("n_files"), F.min("path").alias("first_file"))
    base = sets.groupBy("class").agg(F.min_by("cols", "first_file").alias("_base"))
    return sets.join(base, "class").select(
        "class", F.size("cols").alias("n_columns"), "n_files", "first_file",
        F.array_except("cols", "_base").alias("extra"), F.array_except("_base", "cols").alias("missing"),
        (F.col("cols") == F.col("_base")).alias("is_base"),
    )


def _units(unit: str):
    """Number of files, or of the sources that they belong to."""
    if unit not in ("path", "source"):
        raise ValueError("unit must be path or source")
    return F.count(F.lit(1)) if unit == "path" else F.count_distinct(unit)


def source_check(spark: SparkSession, path: str, pattern: str = FD.CSV_FILES, recursive: bool = False, unit: str = "path") -> DataFrame:
    """One row: files found (or, with ``unit="source"``, exports) and total size; FAIL when nothing matches."""
    files = list_sources(spark, path, pattern, recursive)
    return files.agg(
        _units(unit).alias("files"),
        round_half_even(F.coalesce(F.sum("length"), F.lit(0)) / (1024 * 1024), 3).alias("size_mb"),
    ).select(F.lit(path).alias("path"), "files", "size_mb",
             F.when(F.col("files") > 0, "PASS").otherwise("FAIL").alias("status"))
