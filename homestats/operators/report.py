"""Report metrics as result tables (the numbers behind a cleaning report)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


from homestats.functions import fields as FD
from homestats.functions.coerce import as_number, pct
from homestats.operators.clean import Cleaned, geo_counts, geo_nulls
from homestats.operators.profile import _rule_predicate


def _totals(c: Cleaned) -> DataFrame:
    """One row of a cleaning run from one aggregate pass over the cleaned rows:
    raw / clean shape, composite and date-flag sums, rows with any date flag.

    Cleaning never drops rows, yet raw rows are counted on the raw input
    (by the pruning job) rather than assumed.
    """
    date_sums = {f: F.sum(F.col(f)).cast("long") for f in FD.DATE_ORDER_FLAG_NAMES if f in c.date_flags}
    if c.date_flags:
        any_date = F.greatest(*[F.col(f) for f in c.date_flags]) if len(c.date_flags) > 1 else F.col(c.date_flags[0])
        with_date = F.sum(any_date).cast("long")
    else:
        with_date = F.lit(0).cast("long")
    agg = c.data.agg(
        F.count(F.lit(1)).alias("clean_rows"),
        F.sum("any_invalid_flag").cast("long").alias("any_invalid_flag"),
        with_date.alias("rows_with_date_flag"),
        *[e.alias(f) for f, e in date_sums.items()],
    )
    raw_rows = F.lit(c.raw_rows).cast("long")
    return agg.select(
        F.lit(c.dataset).alias("dataset"), raw_rows.alias("raw_rows"),
        F.lit(len(c.raw.columns)).cast("long").alias("raw_cols"),
        F.lit(len(c.data.columns)).cast("long").alias("clean_cols"),
        F.lit(len(c.dropped_names)).cast("long").alias("cols_dropped"), "*",
    )


def totals(sold: Cleaned, listed: Cleaned) -> DataFrame:
    """Two rows (one per dataset) of cleaning-run totals; absent date flags are null."""
    return _totals(sold).unionByName(_totals(listed), allowMissingColumns=True)


# The scorecard's metrics (dataset, total column), in display order.
SCORECARD = [
    ("SOLD", "raw_rows"), ("LISTED", "raw_rows"),
    ("SOLD", "cols_dropped"), ("LISTED", "cols_dropped"),
    ("SOLD", "listing_after_close_flag"), ("SOLD", "purchase_after_close_flag"), ("SOLD", "negative_timeline_flag"),
    ("SOLD", "any_invalid_flag"), ("LISTED", "any_invalid_flag"),
    ("SOLD", "clean_cols"), ("LISTED", "clean_cols"),
]


def scorecard(sold: Cleaned, listed: Cleaned) -> DataFrame:
    """``(metric, value)``: the headline numbers of a cleaning run."""
    t = totals(sold, listed)
    cols = sorted({col for _d, col in SCORECARD if col in t.columns})
    entries = F.array(*[F.struct(F.lit(col).alias("_m"), F.col(col).cast("long").alias("value")) for col in cols])
    wanted = F.array(*[F.lit(f"{d.lower()}_{col}") for d, col in SCORECARD])
    longf = t.select(F.lower("dataset").alias("_d"), F.inline(entries))
    return longf.select(F.concat_ws("_", "_d", "_m").alias("metric"), "value").where(
        F.array_contains(wanted, F.col("metric")))


def flag_rates(sold: Cleaned, listed: Cleaned) -> DataFrame:
    """``(dataset, flag, flagged, total, pct, bar_pct)``; pct is 0 when total is 0."""
    t = totals(sold, listed)
    flags = ["any_invalid_flag"] + [f for f in FD.DATE_ORDER_FLAG_NAMES if f in t.columns]
    entries = F.array(*[F.struct(F.lit(f).alias("flag"), F.col(f).alias("flagged")) for f in flags])
    out = t.select("dataset", F.col("clean_rows").alias("total"), F.inline(entries)).where(
        F.col("flagged").isNotNull())
    p = F.coalesce(pct(F.col("flagged"), F.col("total")), F.lit(0.0))
    return out.select("dataset", "flag", "flagged", "total", p.alias("pct")).withColumn(
        "bar_pct", F.least(F.col("pct"), F.lit(100.0)))


def before_after(sold: Cleaned, listed: Cleaned) -> DataFrame:
    """``(dataset, measure, before, after, delta)`` for rows and columns."""
    t = totals(sold, listed)
    entries = F.array(
        F.struct(F.lit("rows").alias("measure"), F.col("raw_rows").alias("before"), F.col("clean_rows").alias("after")),
        F.struct(F.lit("columns").alias("measure"), F.col("raw_cols").alias("before"), F.col("clean_cols").alias("after")),
    )
    return t.select("dataset", F.inline(entries)).withColumn("delta", F.col("after") - F.col("before"))


def rule_rates(sold: Cleaned, listed: Cleaned) -> DataFrame:
    """Per-rule flagged rows and their share of the dataset's rows (one pass per dataset)."""
    out = []
    for c in (sold, listed):
        present = [r for r in c.rules if r[0] in c.data.columns]
        agg = c.data.agg(F.count(F.lit(1)).alias("_rows"), *[
            F.count_if(_rule_predicate(as_number(c.data, col), k, b)).alias(f"_r{i}")
            for i, (col, _l, k, b) in enumerate(present)])
        entries = F.array(*[F.struct(F.lit(col).alias("column"), F.lit(label).alias("rule"),
                                     F.col(f"_r{i}").alias("flagged"))
                            for i, (col, label, _k, _b) in enumerate(present)])
        out.append(agg.select(F.lit(c.dataset).alias("dataset"), "_rows", F.inline(entries)).select(
            "dataset", "column", "rule", "flagged",
            F.coalesce(pct(F.col("flagged"), F.col("_rows")), F.lit(0.0)).alias("pct")))
    return out[0].unionByName(out[1])


def geo_coverage(sold: Cleaned, listed: Cleaned, fields=FD.GEO_COVERAGE_FIELDS) -> DataFrame:
    """Null coverage of location columns with status Good (<5%), Partial (<20%), Sparse."""
    parts = [geo_nulls(c.data, c.dataset, fields) for c in (sold, listed)]
    out = parts[0].unionByName(parts[1])
    status = (
        F.when(F.col("null_pct") < FD.COVERAGE_GOOD_PCT, "Good")
        .when(F.col("null_pct") < FD.COVERAGE_PARTIAL_PCT, "Partial")
        .otherwise("Sparse")
    )
    return out.withColumn("status", status)


def geo_validity(sold: Cleaned, listed: Cleaned) -> DataFrame:
    """``(dataset, check, n, pct, status)``: coordinate checks, None when 0 else Flagged."""
    parts = []
    for c in (sold, listed):
        g = geo_counts(c.data, c.dataset, with_rows=True)
        entries = F.array(*[F.struct(F.lit(k).alias("check"), F.col(k).alias("n"))
                            for k in ("null_geo", "zero_lat", "zero_lon", "pos_lon")])
        parts.append(g.select("dataset", "rows", F.inline(entries)).select(
            "dataset", "check", "n", F.coalesce(pct(F.col("n"), F.col("rows")), F.lit(0.0)).alias("pct")))
    out = parts[0].unionByName(parts[1])
    return out.withColumn("status", F.when(F.col("n") == 0, "None").otherwise("Flagged"))


def date_consistency(sold: Cleaned) -> DataFrame:
    """Date-flag hits (sum over flags) and distinct flagged rows; consistent rows use the latter."""
    t = _totals(sold)
    flags = sold.date_flags
    hits = sum([F.col(f) for f in flags[1:]], F.col(flags[0])) if flags else F.lit(0)
    consistent = F.col("clean_rows") - F.col("rows_with_date_flag")
    return t.select(
        hits.cast("long").alias("date_flag_hits"),
        F.col("rows_with_date_flag"),
        consistent.alias("consistent_rows"),
        pct(consistent, F.col("clean_rows")).alias("consistent_pct"),
        *[pct(F.col(f), F.col("clean_rows")).alias(f"{f}_pct") for f in flags],
    )


# Meanings of the flags that no rule list defines.
GEO_MEANINGS = {
    "geo_null_flag": "1 if Latitude or Longitude is null",
    "geo_sentinel_flag": "1 if Latitude = 0 or Longitude = 0",
    "geo_invalid_flag": "1 if Longitude > 0",
    "any_invalid_flag": "1 if any numeric or date flag is 1",
}


def flag_meanings(c: Cleaned) -> dict[str, str]:
    """Each flag of a cleaning run and what its rules say, in the dataset's own terms."""
    said = {name: f"1 if {earlier} > {later}" for name, earlier, later in FD.DATE_ORDER_FLAGS}
    for column, label, _kind, _bound in c.rules:
        flag = f"{column}_invalid_flag"
        said[flag] = f"{said[flag]} OR {label}" if flag in said else f"1 if {label}"
    said |= GEO_MEANINGS
    return {f: m for f, m in said.items() if f in c.data.columns}


def flag_dictionary(sold: Cleaned, listed: Cleaned) -> DataFrame:
    """``(dataset, flag, meaning, flagged)``: each dataset's flags, what sets them and how many rows they hit."""
    parts = []
    for c in (sold, listed):
        said = flag_meanings(c)
        agg = c.data.agg(*[F.sum(F.col(f)).cast("long").alias(f) for f in said])
        entries = F.array(*[F.struct(F.lit(f).alias("flag"), F.lit(m).alias("meaning"), F.col(f).alias("flagged")) for f, m in said.items()])
        parts.append(agg.select(F.lit(c.dataset).alias("dataset"), F.inline(entries)))
    return parts[0].unionByName(parts[1])


def output_catalogue(outputs: dict[str, DataFrame]) -> DataFrame:
    """``(output, rows, columns)`` of the tables a run writes (one count per table)."""
    parts = [df.agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit(name).alias("output"), "rows", F.lit(len(df.columns)).alias("columns"))
        for name, df in outputs.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
