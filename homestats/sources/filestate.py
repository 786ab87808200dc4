"""Per-file profiles of a growing folder, kept as mergeable state.

A folder of monthly exports grows by a file or a few a month. Instead of profiling all of it
again, ``update_states`` reads only files that are new or changed and appends a row of state per
file: counts, ranges, months, null counts and sketches. What is told of a source or of the whole
dataset is merged from these rows (``source_profile``, ``source_critical``, ``dataset_profile``) and
equals the profile of the whole folder read at once; distinct keys and quantiles over all files
are estimates from the merged sketches (``dataset_estimates``).

States are Parquet rows appended by one job per batch of files, so a failed batch leaves no state
behind and is read again. A file is known by path, length and time of modification: a changed
one gets a new state that takes the old one's place, and one that is gone no longer counts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from homestats.functions import fields as FD
from homestats.functions.coerce import as_date, as_number, has, month_key, pct
from homestats.session import shuffles_removed
from homestats.sources.files import file_headers, list_sources, source_name
from homestats.sources.tables import _hadoop, read_table

_SCHEMA = (
    "path string, length long, modified long, updated timestamp, columns array<string>, rows long, valid_dates long, "
    "min_date date, max_date date, months array<string>, nulls map<string,long>, keys binary, numbers map<string,binary>"
)
# read_table adds the file's name and path to a table's columns
_ADDED = ["source_file", "source_path"]


def states(spark: SparkSession, state_dir: str) -> DataFrame:
    """All states written so far, the last one of each path (changed files have several)."""
    system, place = _hadoop(spark, state_dir)
    if not system.exists(place):
        return spark.createDataFrame([], _SCHEMA)
    every = spark.read.schema(_SCHEMA).parquet(state_dir)
    last = every.groupBy("path").agg(F.max_by(F.struct(*every.columns), F.struct("updated", "modified", "length")).alias("s"))
    return last.select("s.*")


def present_states(spark: SparkSession, folder: str, state_dir: str, pattern: str = FD.CSV_FILES, recursive: bool = False) -> DataFrame:
    """The states of files that the folder holds now, unchanged since they were read."""
    files = list_sources(spark, folder, pattern, recursive, modified=True)
    return states(spark, state_dir).join(files.select("path", "length", "modified"), ["path", "length", "modified"], "left_semi")


def _state_of(t: DataFrame, date_col: str, fields: Sequence[str], key: str, numeric: Sequence[str]) -> DataFrame:
    """A state per ``source_path`` of the table; one grouped aggregate with map-side partial sums."""
    d = as_date(t, date_col)
    held = [c for c in fields if has(t, c)]
    counts = F.map_from_arrays(
        F.array(*[F.lit(c) for c in held]).cast("array<string>"),
        F.array(*[F.count_if(F.col(c).isNull()) for c in held]).cast("array<bigint>"),
    )
    values = [c for c in numeric if has(t, c)]
    sketches = F.map_from_arrays(
        F.array(*[F.lit(c) for c in values]).cast("array<string>"),
        F.array(*[F.kll_sketch_agg_double(as_number(t, c)) for c in values]).cast("array<binary>"),
    )
    keys = F.hll_sketch_agg(F.col(key).cast("string")) if has(t, key) else F.lit(None).cast("binary")
    return t.groupBy(F.col("source_path").alias("path")).agg(
        F.count(F.lit(1)).alias("rows"), F.count(d).alias("valid_dates"), F.min(d).alias("min_date"), F.max(d).alias("max_date"),
        F.collect_set(month_key(d)).alias("months"), counts.alias("nulls"), keys.alias("keys"), sketches.alias("numbers"),
    )


def update_states(
    spark: SparkSession,
    folder: str,
    state_dir: str,
    date_col: str,
    fields: Sequence[str] = FD.FILE_CRITICAL_FIELDS,
    key: str = FD.KEY_COLUMN,
    numeric: Sequence[str] = (),
    pattern: str = FD.CSV_FILES,
    recursive: bool = False,
    encoding: str = "UTF-8",
    max_files: int = 1000,
) -> int:
    """Read new and changed files of a folder and append their states; the number of files read.

    A call takes up to ``max_files`` files, in order of path (their paths reach the driver, as in
    ``read_table``); call again until it returns 0. ``fields`` are those whose nulls
    are counted, ``numeric`` those sketched for quantiles. All updates of a folder should name the same.
    """
    files = list_sources(spark, folder, pattern, recursive, modified=True).select("path", "length", "modified")
    todo = files.join(states(spark, state_dir), ["path", "length", "modified"], "left_anti").orderBy("path").limit(max_files).collect()
    if not todo:
        return 0
    paths = [r["path"] for r in todo]
    batch = F.broadcast(spark.createDataFrame(todo, files.schema))
    found = _state_of(read_table(spark, paths, encoding=encoding), date_col, fields, key, numeric)
    heads = file_headers(spark, paths, "*", encoding=encoding).select("path", F.col("header").alias("columns"))
    # a file without records has a state, too
    whole = batch.join(heads, "path", "left").join(found, "path", "left").withColumns({
        "updated": F.current_timestamp(), "columns": F.coalesce("columns", F.array().cast("array<string>")),
        "rows": F.coalesce("rows", F.lit(0)), "valid_dates": F.coalesce("valid_dates", F.lit(0)),
    })
    schema = spark.createDataFrame([], _SCHEMA).schema
    with shuffles_removed(spark):
        whole.select(*[F.col(f.name).cast(f.dataType) for f in schema]).coalesce(1).write.mode("append").parquet(state_dir)
    return len(todo)


def _by_source(kept: DataFrame, fields: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Merged counts per source, and those of ``fields`` that any file has (a small job finds them).

    In a file without a column that others have, all rows lack it.
    """
    names = {r[0] for r in kept.select(F.explode("columns")).distinct().where(F.col("col").isin(list(fields))).collect()}
    held = [c for c in fields if c in names]
    nulls = [
        F.sum(F.when(F.array_contains("columns", c), F.col("nulls")[c]).otherwise(F.col("rows"))).alias(f"_n{i}") for i, c in enumerate(held)
    ]
    merged = kept.where("rows > 0").groupBy(source_name(F.col("path")).alias("source")).agg(
        F.sum("rows").alias("rows"), F.sum("valid_dates").alias("valid_dates"),
        F.min("min_date").alias("min_date"), F.max("max_date").alias("max_date"), *nulls,
    )
    return merged, held


def _shares(held: Sequence[str]) -> list:
    return [F.try_divide(F.col(f"_n{i}") * F.lit(100.0), F.col("rows").cast("double")) for i in range(len(held))]


def source_profile(kept: DataFrame, fields: Sequence[str] = FD.FILE_CRITICAL_FIELDS, limit_pct: float = FD.CRITICAL_NULL_PCT) -> DataFrame:
    """``validate.per_source_profile`` from states: a row per source, with the same columns."""
    merged, held = _by_source(kept, fields)
    over = sum((F.when(s > limit_pct, 1).otherwise(0) for s in _shares(held)), F.lit(0))
    return merged.select("source", "rows", "valid_dates", "min_date", "max_date", over.alias("high_null_fields"))


def source_critical(kept: DataFrame, fields: Sequence[str] = FD.FILE_CRITICAL_FIELDS, limit_pct: float = FD.CRITICAL_NULL_PCT) -> DataFrame:
    """``validate.per_source_critical`` from states: ``(source, field, null_pct)`` over the limit."""
    merged, held = _by_source(kept, fields)
    if not held:
        return merged.select("source", F.lit("").alias("field"), F.lit(0.0).alias("null_pct")).limit(0)
    each = [
        F.struct(F.lit(c).alias("field"), s.alias("raw"), pct(F.col(f"_n{i}"), F.col("rows")).alias("null_pct"))
        for i, (c, s) in enumerate(zip(held, _shares(held), strict=True))
    ]
    return merged.select("source", F.inline(F.array(*each))).where(F.col("raw") > limit_pct).select("source", "field", "null_pct")


def dataset_profile(kept: DataFrame) -> DataFrame:
    """``validate.dataset_summary`` from states: one row of totals over all files."""
    some = kept.select("rows", "min_date", "max_date", source_name(F.col("path")).alias("source"), "months", "columns")
    columns = some.select(F.explode("columns").alias("c")).agg(F.count_distinct("c") + len(_ADDED)).scalar()
    months = some.select(F.explode("months").alias("m")).agg(F.count_distinct("m")).scalar()
    return some.agg(
        F.count_distinct(F.when(F.col("rows") > 0, F.col("source"))).alias("sources"),
        F.coalesce(F.sum("rows"), F.lit(0)).cast("long").alias("rows"), F.max(columns).cast("int").alias("columns"),
        F.min("min_date").alias("min_date"), F.max("max_date").alias("max_date"), F.max(months).alias("months"),
    )


def dataset_estimates(kept: DataFrame, probs: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """``(field, p, estimate)`` over all files: quantiles from merged sketches, and ``distinct`` keys (``p`` is null).

    Sketches merge in partial aggregates of bounded size. They are estimates; exact figures are what
    ``profile`` and ``quantiles`` give.
    """
    each = kept.select(F.explode("numbers").alias("field", "sketch")).where("sketch IS NOT NULL")
    merged = each.groupBy("field").agg(F.kll_merge_agg_double("sketch").alias("sketch")).where(F.kll_sketch_get_n_double("sketch") > 0)
    points = F.array(*[
        F.struct(F.lit(float(p)).alias("p"), F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))).alias("estimate")) for p in probs
    ])
    quantiles = merged.select("field", F.inline(points))
    distinct = kept.agg(F.hll_sketch_estimate(F.hll_union_agg("keys")).cast("double").alias("estimate"))
    return quantiles.unionByName(distinct.select(F.lit("distinct keys").alias("field"), F.lit(None).cast("double").alias("p"), "estimate"))
