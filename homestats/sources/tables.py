"""Reading and writing tables: typed CSV reads that survive header drift, union
by name, and the writers for datasets and run summaries."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from homestats.functions import fields as FD
from homestats.session import shuffles_removed

# Byte-order marks as they appear in a first header cell
# (UTF-8 decoded, and UTF-8 bytes decoded as Latin-1).
BOMS = ["﻿", "ï»¿"]


def union_by_name(dfs: Sequence[DataFrame]) -> DataFrame:
    """Union aligning columns by name; columns missing on one side become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def _strip_bom(name: str) -> str:
    for b in BOMS:
        if name.startswith(b):
            return name[len(b):]
    return name


def normalise_nulls(df: DataFrame, tokens: Sequence[str] = FD.NULL_TOKENS) -> DataFrame:
    """Text cells equal to a null token (after trimming) become null."""
    toks = [t for t in tokens if t != ""]
    conv = {}
    for f in df.schema.fields:
        if f.dataType.simpleString() == "string":
            c = F.col(f"`{f.name}`")
            conv[f.name] = F.when(F.trim(c).isin("", *toks), F.lit(None)).otherwise(c)  # each cell is trimmed once
    return df.withColumns(conv) if conv else df


def csv_reader(spark: SparkSession, encoding: str, multi_line: bool):
    """A text-typed CSV reader with a header; quotes inside a quoted cell are doubled (``"a ""b"" c"``)."""
    return (
        spark.read.option("header", True)
        .option("multiLine", multi_line)
        .option("encoding", encoding)
        .option("quote", '"').option("escape", '"')
        .option("inferSchema", False)
        .option("mode", "PERMISSIVE")
    )


def read_csv_group(spark: SparkSession, paths: Sequence[str], encoding: str = "UTF-8", multi_line: bool = True,
                   whole_files: bool = False) -> DataFrame:
    """All-text read of files sharing one header; the source file name is kept.

    With ``multi_line`` a file's splits are many tasks, and records cut by them are put together
    (``records.csv_records``); with ``whole_files``, too, Spark's reader takes each file as one task.
    """
    from homestats.sources.records import csv_records, record_text

    records = csv_records(spark, paths) if multi_line and not whole_files else None
    if records is None:
        df = csv_reader(spark, encoding, multi_line).csv(list(paths))
        df = df.toDF(*[_strip_bom(c) for c in df.columns])
        return df.withColumns({"source_file": F.col("_metadata.file_name"), "source_path": F.col("_metadata.file_path")})
    names = [_strip_bom(c) for c in csv_reader(spark, encoding, True).csv(paths[0]).columns]
    # cells are parsed under names of their own: headers may repeat names or hold any character
    schema = ", ".join(f"c{i} string" for i in range(len(names)))
    options = {"multiLine": "true", "quote": '"', "escape": '"', "mode": "PERMISSIVE"}
    text = record_text(F.col("record"), encoding)
    cells = records.where(~F.col("header")).select("path", F.from_csv(text, F.lit(schema), options).alias("cells"))
    path = F.col("path")
    return cells.select(
        *[F.col(f"cells.c{i}").alias(n) for i, n in enumerate(names)],
        F.element_at(F.split(path, "/"), -1).alias("source_file"), path.alias("source_path"),
    )


def read_table(
    spark: SparkSession,
    path: str | Sequence[str],
    pattern: str = FD.CSV_FILES,
    recursive: bool = False,
    encoding: str = "UTF-8",
    null_tokens: Sequence[str] = FD.NULL_TOKENS,
    multi_line: bool = True,
    whole_files: bool = False,
) -> DataFrame:
    """Read a folder (or a list of files) of CSV exports as one text table.

    Files are grouped by their *ordered* header, each group is read on its own and
    the groups are unioned by name: a positional multi-file read would scramble
    reordered headers. One job reads the headers (first bytes only); its result, a path per file, is
    what Spark's own reader keeps on the driver as well.

    ``multi_line`` (default): a quoted line break stays inside its record. A file is read by as many tasks as
    it has splits, after a scan that finds which of them begin inside a quoted cell; with ``whole_files`` a file
    is one task of Spark's own reader (for encodings that aren't ASCII-compatible). With ``False`` files
    are split by line, for exports known to hold no quoted line break; the choice is the
    caller's and never follows from a file's size.
    """
    from homestats.sources.files import file_headers

    groups: dict[tuple, list[str]] = {}
    # sorted here: a distributed sort would open every file once more, to find its ranges
    for r in sorted(file_headers(spark, path, pattern, recursive, encoding).collect()):
        groups.setdefault(tuple(r["header"]), []).append(r["path"])
    if not groups:
        return spark.createDataFrame([], "source_file string")
    parts = [read_csv_group(spark, paths, encoding, multi_line, whole_files) for paths in groups.values()]
    return normalise_nulls(union_by_name(parts), null_tokens)


def write_table(df: DataFrame, path: str, fmt: str = "csv", mode: str = "overwrite", partition_by: Sequence[str] = (),
                compression: str | None = None, most_rows: int | None = None) -> str:
    """Write a dataset (CSV with header, quotes doubled, or Parquet); returns the path.

    ``compression`` names one of Spark's codecs; CSV is plain text without it. A gzipped file is read by one
    task, so each should be of moderate size: ``most_rows`` limits the rows of a file.

    ``overwrite`` publishes in stages: the new data set is written aside, and only when it is whole does
    it take the old one's place by renames. A write that fails leaves the old data set as it was.
    """
    if fmt not in ("csv", "parquet"):
        raise ValueError(f"unsupported format {fmt!r}")
    staged = f"{path.rstrip('/')}.staged-{uuid.uuid4().hex}" if mode == "overwrite" else path
    w = df.write.mode("error" if mode == "overwrite" else mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if compression:
        w = w.option("compression", compression)
    if most_rows:
        w = w.option("maxRecordsPerFile", most_rows)
    try:
        with shuffles_removed(df.sparkSession):
            if fmt == "csv":
                w.option("header", True).option("quote", '"').option("escape", '"').csv(staged)
            else:
                w.parquet(staged)
    except Exception:
        if staged != path:
            _discard(df.sparkSession, staged)
        raise
    if staged != path:
        _publish(df.sparkSession, staged, path)
    return path


def _hadoop(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def _discard(spark: SparkSession, path: str) -> None:
    system, place = _hadoop(spark, path)
    system.delete(place, True)


def _publish(spark: SparkSession, staged: str, path: str) -> None:
    """Let a staged folder take the place of ``path``; the old one is deleted last, and put back if the switch fails."""
    system, place = _hadoop(spark, path)
    _, new = _hadoop(spark, staged)
    old = None
    if system.exists(place):
        _, old = _hadoop(spark, f"{path.rstrip('/')}.old-{uuid.uuid4().hex}")
        if not system.rename(place, old):
            raise OSError(f"{path} could not be moved aside; the new data set is at {staged}")
    if not system.rename(new, place):
        if old is not None:
            system.rename(old, place)
        raise OSError(f"{staged} could not be moved to {path}")
    if old is not None:
        system.delete(old, True)
    spark.catalog.refreshByPath(path)


def write_summary(summary: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Write a one-row nested summary as JSON (a single small file)."""
    summary.coalesce(1).write.mode(mode).json(path)
    return path


def read_summary(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """Read a summary written by ``write_summary`` (schema optional)."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)
