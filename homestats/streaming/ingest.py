"""Monthly export files arrive one month at a time; this job picks up each new
file once, types and flags its rows, and appends them to a Parquet table.

Everything applied here is row-local (date parsing, date-order flags, numeric
rule flags, the composite flag, geographic flags), so the query is stateless:
no watermark or state store is needed and each micro-batch is independent.
Column pruning by null share needs the whole table and stays a batch step
(``clean.drop_high_null``). Progress lives in the checkpoint folder, so a
restarted or partially failed run neither loses nor repeats files.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from homestats.functions import fields as FD
from homestats.operators.clean import any_flag, date_flag_columns, geo_flag_columns, parse_dates, rule_columns
from homestats.operators.profile import filter_category
from homestats.sources.tables import read_table


def flag_stream(
    df: DataFrame,
    date_fields: Sequence[str] = FD.SOLD_DATE_FIELDS,
    rules: Sequence[tuple] = FD.SOLD_FLAG_RULES,
    date_flags: bool = True,
    residential_only: bool = True,
) -> DataFrame:
    """The row-local part of cleaning, usable on a batch or a streaming DataFrame."""
    if residential_only:
        df = filter_category(df)
    out = parse_dates(df, date_fields)
    dflags: list[str] = []
    if date_flags:
        cols = date_flag_columns(out)
        out = out.withColumns(cols)
        dflags = list(cols)
    ncols = rule_columns(out, rules)
    out = out.withColumns(ncols)
    out = any_flag(out, list(ncols) + dflags)
    return out.withColumns(geo_flag_columns(out))


def ingest_once(
    spark: SparkSession,
    source_dir: str,
    columns: Sequence[str],
    sink_dir: str,
    checkpoint_dir: str,
    pattern: str = FD.CSV_FILES,
    max_files_per_trigger: int = 1000,
    encoding: str = "UTF-8",
    null_tokens: Sequence[str] = FD.NULL_TOKENS,
    multi_line: bool = True,
    **flag_kw,
) -> None:
    """Process every file not yet seen under ``source_dir``, then stop (``availableNow``).

    The stream carries the new files' paths only (contents aren't read by it). Each
    micro-batch reads its files as ``read_table`` does: by their own headers, aligned
    by name, with the given encoding, byte-order marks and null tokens handled. Of a
    file's columns the declared ``columns`` are kept, absent ones are null. A batch is
    written to its own ``batch_id=`` folder and overwrites it when it is run again, so a
    restart neither loses nor repeats rows. A batch admits ``max_files_per_trigger`` files at most,
    so neither the paths that reach the driver nor a batch grow with the folder.
    """
    reader = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length long, content binary")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
    )
    reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        paths = [r["path"] for r in batch.toLocalIterator()]  # new file names, bounded by max_files_per_trigger
        if not paths:
            return
        rows = read_table(batch.sparkSession, paths, "*", False, encoding, null_tokens, multi_line)
        aligned = rows.select(
            *[F.col(f"`{c}`") if c in rows.columns else F.lit(None).cast("string").alias(c) for c in columns], "source_file"
        )
        flag_stream(aligned, **flag_kw).write.mode("overwrite").parquet(f"{sink_dir}/batch_id={batch_id}")

    query = (
        reader.load(source_dir).select("path")
        .writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint_dir)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
