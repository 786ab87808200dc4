"""File-side registered queries.

They need files, so each first exports the derived sold and / or listed relation
as monthly CSV folders, one file per month (dealt by source before writing, so the
files don't depend on the number of tasks), under the shared checkpoint folder, and
then runs the file operator on that export. Results name sources, not run paths.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from homestats.functions import fields as FD
from homestats.functions.coerce import as_number
from homestats.operators.clean import clean_listed, clean_sold, cleaning_summary, geo_stats
from homestats.operators.profile import value_or_mark
from homestats.plans.catalog import register
from homestats.plans.relations import Relations
from homestats.plans.sqlkit import D, DSTR, GEO_FLAGS_SQL, LISTED_COLUMNS, LISTED_FLAGS_SQL, N, PCT, SOLD_COLUMNS, SOLD_FLAGS_SQL, sql
from homestats.session import scratch_path, stored
from homestats.sources import files as FI
from homestats.sources import tables as TB

# Flags produced by the streaming ingest (date + numeric + composite + geo).
_STREAM_FLAGS = list(SOLD_FLAGS_SQL) + ["any_invalid_flag"] + list(GEO_FLAGS_SQL)

_PREFIX = {"sold": "ExportSold", "listed": "ExportListing"}
_CLASS = {"sold": "Sold", "listed": "Listing"}
EXPORT_ROWS = 400_000


def export_monthly(r: Relations, which=("sold", "listed")) -> str:
    """Write the relations as monthly CSV exports, a folder each, named like ``ExportSold199601``.

    Rows are dealt by month (``Relations.by_month``); adaptive execution splits a month beyond the advisory
    partition size over several tasks, each of which writes files of its own, so no month is one task's work. What is
    told per export is therefore grouped by folder. Files are gzipped, as they are most of what these queries
    keep on disk, and a file's rows lie in the order of their keys, which gzip packs better. A file holds at most ``EXPORT_ROWS``
    rows, so none is too much for a task that reads it."""
    root = scratch_path(r.spark, "exports")
    for name in which:
        month = F.regexp_replace(F.substring("ListingContractDate", 1, 7), "-", "")
        with r.by_month(name) as parts:
            for i, part in enumerate(parts):
                rows = part.withColumn("source", F.concat(F.lit(_PREFIX[name]), month)).sortWithinPartitions("source", "ListingKey")
                TB.write_table(rows, f"{root}/{name}", "csv", "append" if i else "overwrite", ["source"], "gzip", EXPORT_ROWS)
    return root


def _source_sql(name: str) -> str:
    return f"'{_PREFIX[name]}' || replace(substr(ListingContractDate, 1, 7), '-', '')"


def _plain_name(c):
    """``source=ExportSold199601`` (the folder of a part file) as ``ExportSold199601``."""
    return F.regexp_replace(c, "^source=", "")


_BOTH = " UNION ALL ".join(f"SELECT '{_CLASS[n]}' AS class, {_source_sql(n)} AS source FROM {n}" for n in _PREFIX)


@register("source_files", sql(f"SELECT source, count(DISTINCT source) AS files FROM ({_BOTH}) t GROUP BY source"))
def q_source_files(r: Relations) -> DataFrame:
    """Exports found per source, however many files hold one."""
    listed = FI.list_sources(r.spark, export_monthly(r), recursive=True).select("source").distinct()
    return listed.groupBy(_plain_name(F.col("source")).alias("source")).agg(F.count(F.lit(1)).alias("files"))


@register("source_classes", sql(f"SELECT DISTINCT source, class FROM ({_BOTH}) t"))
def q_source_classes(r: Relations) -> DataFrame:
    classes = FI.classify_sources(FI.list_sources(r.spark, export_monthly(r), recursive=True))
    return classes.select(_plain_name(F.col("source")).alias("source"), "class").distinct()


_COLUMNS = f"CASE class WHEN 'Sold' THEN {len(SOLD_COLUMNS)} ELSE {len(LISTED_COLUMNS)} END"


@register("file_overview", sql(f"""
SELECT class, source, count(*) AS rows, count(*) AS parsed_rows, CAST(max({_COLUMNS}) AS INTEGER) AS columns FROM ({_BOTH}) t GROUP BY class, source
UNION ALL SELECT class, 'TOTAL', count(*), count(*), CAST(NULL AS INTEGER) FROM ({_BOTH}) u GROUP BY class"""))
def q_file_overview(r: Relations) -> DataFrame:
    """Lines, parsed records and columns per export, and per class in all (sizes in bytes depend on the writer)."""
    out = FI.file_overview(r.spark, export_monthly(r), recursive=True)
    return out.groupBy("class", _plain_name(F.col("source")).alias("source")).agg(
        F.sum("rows").alias("rows"), F.sum("parsed_rows").alias("parsed_rows"), F.max("columns").cast("int").alias("columns"))


@register("header_consistency", sql(f"""
SELECT class, CAST(max({_COLUMNS}) AS INTEGER) AS n_columns, count(DISTINCT source) AS n_files, 0 AS n_extra, 0 AS n_missing, true AS is_base
FROM ({_BOTH}) t GROUP BY class"""))
def q_header_consistency(r: Relations) -> DataFrame:
    out = FI.header_consistency(r.spark, export_monthly(r), recursive=True, unit="source")
    return out.select("class", "n_columns", "n_files", F.size("extra").alias("n_extra"), F.size("missing").alias("n_missing"), "is_base")


@register("source_check", sql(f"SELECT count(DISTINCT source) AS files, 'PASS' AS status FROM ({_BOTH}) t"))
def q_source_check(r: Relations) -> DataFrame:
    return FI.source_check(r.spark, export_monthly(r), recursive=True, unit="source").select("files", "status")


_READ_TEXT = ["PropertyType", "City", "CountyOrParish", "PostalCode", "UnparsedAddress", "CloseDate", "BusinessType"]
_READ_NUMBERS = ["ListingKey", "ClosePrice", "ListPrice", "LivingArea", "Latitude"]


@register("read_table", sql(f"""
SELECT {_source_sql('sold')} AS source, {', '.join(_READ_TEXT)}, {', '.join(f'{N(c)} AS {c}' for c in _READ_NUMBERS)} FROM sold"""))
def q_read_table(r: Relations) -> DataFrame:
    """All monthly sold files read as one table (numbers coerced, so that engines' number texts don't matter)."""
    t = TB.read_table(r.spark, f"{export_monthly(r, ['sold'])}/sold", recursive=True)
    source = _plain_name(FI.source_name(F.col("source_path")))
    return t.select(source.alias("source"), *_READ_TEXT, *[as_number(t, c).alias(c) for c in _READ_NUMBERS])


_ROUNDTRIP = ["ListingKey", "City", "CloseDate", "any_invalid_flag", "geo_null_flag"]


@register("write_roundtrip", sql(" UNION ALL ".join(
    f"SELECT '{fmt}' AS fmt, CAST(ListingKey AS VARCHAR) AS ListingKey, City, {DSTR('CloseDate')} AS CloseDate, "
    f"CAST(any_invalid_flag AS VARCHAR) AS any_invalid_flag, CAST(geo_null_flag AS VARCHAR) AS geo_null_flag FROM clean_s"
    for fmt in ("csv", "parquet"))))
def q_write_roundtrip(r: Relations) -> DataFrame:
    """The cleaned table written as CSV and as Parquet and read back."""
    back = []
    # the joined table is written once; column pruning and both writers read it
    data = clean_sold(stored(r.sold_e, "enriched")).data
    for fmt in ("csv", "parquet"):
        path = TB.write_table(data, scratch_path(r.spark, "roundtrip"), fmt)
        rows = TB.read_table(r.spark, path) if fmt == "csv" else r.spark.read.schema(data.schema).parquet(path)
        back.append(rows.select(F.lit(fmt).alias("fmt"), *[F.col(c).cast("string").alias(c) for c in _ROUNDTRIP]))
    return TB.union_by_name(back)


def _flat_summary(summary: DataFrame) -> DataFrame:
    """``(dataset, metric, value)`` of the numbers in a nested cleaning summary."""
    counts = ["raw_rows", "raw_cols", "clean_rows", "clean_cols", "cols_dropped", "any_invalid_flag", *list(SOLD_FLAGS_SQL)[:3]]
    rows = []
    for name in ("sold", "listed"):
        inner = [f.name for f in summary.schema[name].dataType.fields]
        rows += [(name, c, F.col(f"{name}.{c}")) for c in counts if c in inner]
        parsed = F.col(f"{name}.date_parse_results")
        kinds = summary.schema[name].dataType["date_parse_results"].dataType
        fields = list(SOLD_DATES if name == "sold" else LISTED_DATES)
        get = (lambda f, k: F.try_element_at(parsed, F.lit(f))[k]) if kinds.typeName() == "map" else (lambda f, k: parsed[f][k])
        rows += [(name, f"{f}.{k}", get(f, k)) for f in fields for k in ("before_null", "after_null")]
    entries = [
        F.struct(F.lit(d).alias("dataset"), F.lit(m).alias("metric"), v.cast("long").alias("value")) for d, m, v in rows
    ]
    return summary.select(F.inline(F.array(*entries)))


SOLD_DATES = ["ListingContractDate", "CloseDate", "StatusChangeTimestamp", "ModificationTimestamp"]
LISTED_DATES = ["ListingContractDate", "ExpirationDate"]


def _summary_sql() -> str:
    def part(name: str, raw_cols: int, dropped: int, flags: int, dates: list[str]) -> list[str]:
        raw, clean = ("sold_e", "clean_s") if name == "sold" else ("listed_e", "clean_l")
        one = {
            "raw_rows": f"SELECT count(*) FROM {raw}", "raw_cols": f"SELECT {raw_cols}", "clean_rows": f"SELECT count(*) FROM {clean}",
            "clean_cols": f"SELECT {raw_cols - dropped + flags}", "cols_dropped": f"SELECT {dropped}",
            "any_invalid_flag": f"SELECT sum(any_invalid_flag) FROM {clean}",
        }
        if name == "sold":
            one |= {f: f"SELECT sum({f}) FROM {clean}" for f in list(SOLD_FLAGS_SQL)[:3]}
        for f in dates:
            one |= {f"{f}.before_null": f"SELECT count(*) - count({f}) FROM {raw}", f"{f}.after_null": f"SELECT count(*) - count({f}) FROM {clean}"}
        return [f"SELECT '{name}' AS dataset, '{m}' AS metric, CAST(({q}) AS BIGINT) AS value" for m, q in one.items()]

    sold = part("sold", len(SOLD_COLUMNS) + 2, 2, len(SOLD_FLAGS_SQL) + 1 + len(GEO_FLAGS_SQL), SOLD_DATES)
    listed = part("listed", len(LISTED_COLUMNS) + 2, 1, len(LISTED_FLAGS_SQL) + 1 + len(GEO_FLAGS_SQL), LISTED_DATES)
    return sql("\nUNION ALL ".join(sold + listed))


_COORDINATES = ["Latitude", "Longitude"]
#: The columns whose values the summary uses; of the others it counts nulls.
_SUMMARISED = {
    "sold": [*FD.SOLD_DATE_FIELDS, *[c for _, *pair in FD.DATE_ORDER_FLAGS for c in pair], *[rule[0] for rule in FD.SOLD_FLAG_RULES], *_COORDINATES],
    "listed": [*FD.LISTED_DATE_FIELDS, *[rule[0] for rule in FD.LISTED_FLAG_RULES], *_COORDINATES],
}


def _run_summary(r: Relations) -> DataFrame:
    """The nested summary of cleaning both tables; each is joined once and written narrow, and all aggregates read that."""
    sold = clean_sold(stored(value_or_mark(r.sold_e, _SUMMARISED["sold"]), "summarised"))
    listed = clean_listed(stored(value_or_mark(r.listed_e, _SUMMARISED["listed"]), "summarised"))
    return cleaning_summary(sold, listed, geo_stats(sold, listed))


@register("cleaning_summary", _summary_sql())
def q_cleaning_summary(r: Relations) -> DataFrame:
    """The run summary's numbers, one per row."""
    return _flat_summary(_run_summary(r))


@register("summary_roundtrip", _summary_sql())
def q_summary_roundtrip(r: Relations) -> DataFrame:
    """The run summary written as JSON and read back with its schema."""
    summary = _run_summary(r)
    path = TB.write_summary(summary, scratch_path(r.spark, "summary"))
    return _flat_summary(TB.read_summary(r.spark, path, summary.schema))


_LOG_RULES = {
    "SOLD": [
        ("ClosePrice", "ClosePrice <= 0", "<= 0"), ("ClosePrice", "ClosePrice > $50M", "> 50000000"), ("ListPrice", "ListPrice <= 0", "<= 0"),
        ("OriginalListPrice", "OriginalListPrice <= 0", "<= 0"), ("OriginalListPrice", "OriginalListPrice > $50M", "> 50000000"),
        ("LivingArea", "LivingArea <= 0", "<= 0"), ("DaysOnMarket", "DaysOnMarket < 0", "< 0"),
    ],
    "LISTED": [("ListPrice", "ListPrice <= 0", "<= 0"), ("ListPrice", "ListPrice > $50M", "> 50000000"), ("LivingArea", "LivingArea <= 0", "<= 0")],
}


def _rule_log_sql() -> str:
    return sql("\nUNION ALL ".join(
        f"SELECT '{name}' AS dataset, '{c}' AS \"column\", '{label}' AS rule, count(*) FILTER (WHERE {N(c)} {test}) AS flagged FROM {table}"
        for name, table in (("SOLD", "sold_e"), ("LISTED", "listed_e")) for c, label, test in _LOG_RULES[name]))


@register("rule_log_roundtrip", _rule_log_sql())
def q_rule_log_roundtrip(r: Relations) -> DataFrame:
    """The numeric rule log of both datasets written as CSV and read back."""
    log = r.clean_sold.flag_log.unionByName(r.clean_listed.flag_log)
    back = TB.read_table(r.spark, TB.write_table(log, scratch_path(r.spark, "rule-log"), "csv"))
    return back.select("dataset", "column", "rule", F.col("flagged").cast("long").alias("flagged"))


@register("stream_flags_sold", sql(f"SELECT ListingKey, {', '.join(_STREAM_FLAGS)} FROM clean_s"))
def q_stream_flags_sold(r: Relations) -> DataFrame:
    """Monthly sold exports ingested incrementally (Structured Streaming, availableNow),
    flagged row by row, then read back from the streaming sink."""
    from homestats.streaming.ingest import ingest_once

    root = export_monthly(r, ["sold"])
    sink, ckpt = scratch_path(r.spark, "stream-sink"), scratch_path(r.spark, "stream-ckpt")
    ingest_once(r.spark, f"{root}/sold", SOLD_COLUMNS, sink, ckpt)
    out = r.spark.read.parquet(sink)
    return out.select(F.col("ListingKey").cast("long").alias("ListingKey"), *_STREAM_FLAGS)


_FILE_FIELDS = {"sold": ["PropertyType", "City", "PostalCode", "CountyOrParish", "UnparsedAddress"], "listed": ["PropertyType", "City", "CountyOrParish"]}
_FILE_DATE = {"sold": "CloseDate", "listed": "ListingContractDate"}


def _profile_sql(name: str) -> str:
    d = D(_FILE_DATE[name])
    over = " + ".join(
        f"(CASE WHEN CAST(count(*) - count({c}) AS DOUBLE) * 100.0E0 / count(*) > 5.0 THEN 1 ELSE 0 END)" for c in _FILE_FIELDS[name]
    )
    return f"""SELECT '{_CLASS[name]}' AS class, {_source_sql(name)} AS source, count(*) AS rows, count({d}) AS valid_dates,
       {DSTR(f'min({d})')} AS min_date, {DSTR(f'max({d})')} AS max_date, {over} AS high_null_fields FROM {name} GROUP BY 2"""


def _by_file(r: Relations, name: str, root: str) -> DataFrame:
    """The monthly files of a class as one table with their ``source``."""
    t = TB.read_table(r.spark, f"{root}/{name}", recursive=True)
    return t.withColumn("source", _plain_name(FI.source_name(F.col("source_path"))))


@register("per_file_profile", sql("\nUNION ALL ".join(_profile_sql(n) for n in _PREFIX)))
def q_per_file_profile(r: Relations) -> DataFrame:
    """Per-file profile of the monthly exports of both classes: a row per file, whatever the number of tasks."""
    from homestats.operators.validate import per_source_profile

    root = export_monthly(r)
    return TB.union_by_name([
        per_source_profile(_by_file(r, n, root), "source", _FILE_DATE[n]).select(F.lit(_CLASS[n]).alias("class"), "*") for n in _PREFIX
    ])


def _critical_sql(name: str) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{_CLASS[name]}' AS class, {_source_sql(name)} AS source, '{c}' AS field, {PCT(f'count(*) - count({c})', 'count(*)')} AS null_pct "
        f"FROM {name} GROUP BY 2 HAVING CAST(count(*) - count({c}) AS DOUBLE) * 100.0E0 / count(*) > 5.0" for c in _FILE_FIELDS[name]
    )


@register("per_file_critical", sql("\nUNION ALL ".join(_critical_sql(n) for n in _PREFIX)))
def q_per_file_critical(r: Relations) -> DataFrame:
    """The critical fields of each file that exceed the null limit, by name and share."""
    from homestats.operators.validate import per_source_critical

    root = export_monthly(r)
    return TB.union_by_name([
        per_source_critical(_by_file(r, n, root), "source").select(F.lit(_CLASS[n]).alias("class"), "*") for n in _PREFIX
    ])


def _updated(r: Relations, name: str, root: str) -> DataFrame:
    """States of a class's exports, read in batches: the first months, then what came later."""
    from homestats.sources import filestate as FS

    folder, at = f"{root}/{name}", scratch_path(r.spark, "file-states")
    half = -(-FI.list_sources(r.spark, folder, recursive=True).count() // 2)
    while FS.update_states(r.spark, folder, at, _FILE_DATE[name], _FILE_FIELDS[name], recursive=True, max_files=max(half, 1)):
        pass
    return FS.present_states(r.spark, folder, at, recursive=True).withColumn("path", F.regexp_replace("path", "/source=", "/"))


@register("file_state_profile", sql("\nUNION ALL ".join(_profile_sql(n) for n in _PREFIX)))
def q_file_state_profile(r: Relations) -> DataFrame:
    """The per-file profile merged from states that were kept per file and updated in two batches."""
    from homestats.sources.filestate import source_profile

    root = export_monthly(r)
    return TB.union_by_name([
        source_profile(_updated(r, n, root), _FILE_FIELDS[n]).select(F.lit(_CLASS[n]).alias("class"), "*") for n in _PREFIX
    ])


@register("file_state_critical", sql("\nUNION ALL ".join(_critical_sql(n) for n in _PREFIX)))
def q_file_state_critical(r: Relations) -> DataFrame:
    """The critical fields over the null limit per file, from states updated in two batches."""
    from homestats.sources.filestate import source_critical

    root = export_monthly(r)
    return TB.union_by_name([
        source_critical(_updated(r, n, root), _FILE_FIELDS[n]).select(F.lit(_CLASS[n]).alias("class"), "*") for n in _PREFIX
    ])
