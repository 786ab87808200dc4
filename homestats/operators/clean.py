"""Cleaning: prune near-empty columns, parse dates, add quality flags.

No row is ever removed here; every rule adds a 0/1 column. All flags are
narrow projections, so the whole pipeline runs in one stage per partition.
The only action is the one-row null-fraction aggregate that decides which
columns to keep (the output schema depends on the data).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from homestats.functions.coerce import round_half_even
from pyspark.sql import types as T

from homestats.functions import fields as FD
from homestats.functions.coerce import as_date, as_number, as_timestamp, flag, has
from homestats.operators.profile import _rule_predicate


# -- column pruning ----------------------------------------------------------

def null_fractions(df: DataFrame) -> dict[str, float]:
    """Null fraction per column from one aggregate (collects one row: a number per column)."""
    return _null_fractions(df)[0]


def _null_fractions(df: DataFrame) -> tuple[dict[str, float], int]:
    """The fractions and the number of rows: one job."""
    cols = df.columns
    row = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count(F.col(f"`{c}`")).alias(f"_c{i}") for i, c in enumerate(cols)],
    ).first()
    rows = row["_rows"]
    return {c: ((rows - row[f"_c{i}"]) / rows if rows else 0.0) for i, c in enumerate(cols)}, rows


def drop_high_null(df: DataFrame, threshold: float = FD.HIGH_NULL_FRACTION) -> tuple[DataFrame, DataFrame]:
    """``(kept, dropped)``: ``df`` without columns whose null fraction exceeds
    ``threshold`` (column order kept), and ``(column_name, null_pct)`` of the dropped ones.

    Which columns remain depends on the data, so this runs a job: one aggregate."""
    kept, dropped_df, _names, _rows = _drop_high_null(df, threshold)
    return kept, dropped_df


def _drop_high_null(df: DataFrame, threshold: float):
    fr, rows = _null_fractions(df)
    dropped = [c for c in df.columns if fr[c] > threshold]
    kept = df.select(*[F.col(f"`{c}`") for c in df.columns if c not in dropped])
    # a handful of literals: built as a one-row plan, no RDD or job behind it
    entries = F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(fr[c] * 100.0).alias("null_pct"))
                        for c in dropped]).cast("array<struct<column_name:string,null_pct:double>>")
    dropped_df = df.sparkSession.range(1).select(F.inline(entries)).select(
        "column_name", round_half_even(F.col("null_pct"), 2).alias("null_pct"))
    return kept, dropped_df, dropped, rows


# -- dates -------------------------------------------------------------------

def _parser(name: str):
    return as_timestamp if name in FD.TIMESTAMP_FIELDS else as_date


def parse_dates(df: DataFrame, fields: Sequence[str], formats: Sequence[str] = ()) -> DataFrame:
    """Present date fields parsed in place (timestamps keep their time of day); ``formats`` besides ISO text."""
    present = [f for f in fields if has(df, f)]
    return df.withColumns({f: _parser(f)(df, f, formats) for f in present})


def date_parse_report(df: DataFrame, fields: Sequence[str], formats: Sequence[str] = ()) -> DataFrame:
    """``(column_name, before_null, after_null, new_nulls)`` of parsing ``fields`` (one pass)."""
    present = [f for f in fields if has(df, f)]
    if not present:
        return df.sparkSession.createDataFrame(
            [], "column_name string, before_null long, after_null long, new_nulls long")
    agg = df.agg(*[
        e for i, f in enumerate(present) for e in (
            F.count_if(F.col(f).isNull()).alias(f"_b{i}"),
            F.count_if(_parser(f)(df, f, formats).isNull()).alias(f"_a{i}"),
        )
    ])
    entries = F.array(*[
        F.struct(F.lit(f).alias("column_name"), F.col(f"_b{i}").alias("before_null"), F.col(f"_a{i}").alias("after_null"))
        for i, f in enumerate(present)
    ])
    return agg.select(F.inline(entries)).withColumn("new_nulls", F.col("after_null") - F.col("before_null"))


def date_flag_columns(df: DataFrame, rules: Sequence[tuple[str, str, str]] = FD.DATE_ORDER_FLAGS) -> dict[str, Column]:
    """Flag expressions ``earlier > later`` (parsed); absent columns give 0."""
    out = {}
    for name, earlier, later in rules:
        if has(df, earlier) and has(df, later):
            out[name] = flag(as_date(df, earlier) > as_date(df, later))
        else:
            out[name] = F.lit(0)
    return out


def add_date_flags(df: DataFrame, rules: Sequence[tuple[str, str, str]] = FD.DATE_ORDER_FLAGS) -> DataFrame:
    return df.withColumns(date_flag_columns(df, rules))


# -- numeric rules -------------------------------------------------------------

def rule_columns(df: DataFrame, rules: Sequence[tuple], combine: str = "any") -> dict[str, Column]:
    """``<col>_invalid_flag`` per ruled, present column.

    ``combine='any'`` ORs a column's rules (the documented intent);
    ``combine='last'`` keeps only the last rule per column (each rule
    overwriting the previous flag, as the original script's code does).
    """
    if combine not in ("any", "last"):
        raise ValueError("combine must be 'any' or 'last'")
    preds: dict[str, list[Column]] = {}
    for col, _label, kind, bound in rules:
        if has(df, col):
            preds.setdefault(col, []).append(_rule_predicate(as_number(df, col), kind, bound))
    out = {}
    for col, ps in preds.items():
        if combine == "last":
            out[f"{col}_invalid_flag"] = flag(ps[-1])
        else:
            out[f"{col}_invalid_flag"] = F.greatest(*[flag(p) for p in ps]) if len(ps) > 1 else flag(ps[0])
    return out


def flag_invalid(df: DataFrame, rules: Sequence[tuple], combine: str = "any") -> DataFrame:
    return df.withColumns(rule_columns(df, rules, combine))


def flag_log(df: DataFrame, rules: Sequence[tuple], dataset: str) -> DataFrame:
    """``(dataset, column, rule, flagged)``: rows hit by each rule, one pass."""
    present = [r for r in rules if has(df, r[0])]
    if not present:
        return df.sparkSession.createDataFrame([], "dataset string, column string, rule string, flagged long")
    agg = df.agg(*[
        F.count_if(_rule_predicate(as_number(df, c), kind, bound)).alias(f"_r{i}")
        for i, (c, _l, kind, bound) in enumerate(present)
    ])
    entries = F.array(*[
        F.struct(F.lit(dataset).alias("dataset"), F.lit(c).alias("column"), F.lit(label).alias("rule"),
                 F.col(f"_r{i}").alias("flagged"))
        for i, (c, label, _k, _b) in enumerate(present)
    ])
    return agg.select(F.inline(entries))


def any_flag(df: DataFrame, flag_cols: Sequence[str], name: str = "any_invalid_flag") -> DataFrame:
    """Row-wise max of the flag columns; one column is itself, none is 0."""
    cols = [F.col(c) for c in flag_cols if has(df, c)]
    if not cols:
        expr = F.lit(0)
    elif len(cols) == 1:
        expr = cols[0].cast("int")
    else:
        expr = F.greatest(*cols).cast("int")
    return df.withColumn(name, expr)


# -- geography -----------------------------------------------------------------

def geo_nulls(df: DataFrame, dataset: str, fields: Sequence[str] = FD.GEO_AUDIT_FIELDS) -> DataFrame:
    """``(dataset, column_name, null_count, null_pct)`` for present location columns."""
    present = [f for f in fields if has(df, f)]
    if not present:
        return df.sparkSession.createDataFrame(
            [], "dataset string, column_name string, null_count long, null_pct double")
    agg = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count(F.col(f)).alias(f"_c{i}") for i, f in enumerate(present)])
    entries = F.array(*[F.struct(F.lit(f).alias("column_name"), F.col(f"_c{i}").alias("non_null"))
                        for i, f in enumerate(present)])
    nulls = F.col("_rows") - F.col("non_null")
    return agg.select("_rows", F.inline(entries)).select(
        F.lit(dataset).alias("dataset"), "column_name", nulls.alias("null_count"),
        round_half_even(F.try_divide(nulls * F.lit(100.0), F.col("_rows").cast("double")), 2).alias("null_pct"),
    )


def geo_counts(df: DataFrame, dataset: str, with_rows: bool = False) -> DataFrame:
    """One row: null lat-or-lon, lat == 0, lon == 0, lon > 0 (absent columns count 0)."""
    lat, lon = as_number(df, "Latitude"), as_number(df, "Longitude")
    rows = [F.count(F.lit(1)).alias("rows")] if with_rows else []
    if not (has(df, "Latitude") and has(df, "Longitude")):
        zero = F.lit(0).cast("long")
        return df.agg(*rows, zero.alias("null_geo"), zero.alias("zero_lat"), zero.alias("zero_lon"),
                      zero.alias("pos_lon")).select(F.lit(dataset).alias("dataset"), "*")
    return df.agg(
        *rows,
        F.count_if(lat.isNull() | lon.isNull()).alias("null_geo"),
        F.count_if(lat == 0).alias("zero_lat"),
        F.count_if(lon == 0).alias("zero_lon"),
        F.count_if(lon > 0).alias("pos_lon"),
    ).select(F.lit(dataset).alias("dataset"), "*")


def geo_flag_columns(df: DataFrame) -> dict[str, Column]:
    """Null / sentinel-zero / positive-longitude flags; null when a coordinate column is absent."""
    if not (has(df, "Latitude") and has(df, "Longitude")):
        missing = F.lit(None).cast("int")
        return {"geo_null_flag": missing, "geo_sentinel_flag": missing, "geo_invalid_flag": missing}
    lat, lon = as_number(df, "Latitude"), as_number(df, "Longitude")
    return {
        "geo_null_flag": flag(lat.isNull() | lon.isNull()),
        "geo_sentinel_flag": flag((lat == 0) | (lon == 0)),
        "geo_invalid_flag": flag(lon > 0),
    }


def geo_flags(df: DataFrame) -> DataFrame:
    return df.withColumns(geo_flag_columns(df))


# -- whole pipeline --------------------------------------------------------------

@dataclass
class Cleaned:
    """Result of a cleaning run: the flagged table plus its audit tables."""

    dataset: str
    raw: DataFrame
    data: DataFrame
    dropped: DataFrame
    parse_report: DataFrame
    flag_log: DataFrame
    numeric_flags: list[str]
    date_flags: list[str]
    dropped_names: list[str]
    rules: list
    #: rows of ``raw``, counted by the pruning job
    raw_rows: int


SOLD_PROFILE = dict(dataset="SOLD", date_fields=FD.SOLD_DATE_FIELDS, rules=FD.SOLD_FLAG_RULES, date_flags=True)
LISTED_PROFILE = dict(dataset="LISTED", date_fields=FD.LISTED_DATE_FIELDS, rules=FD.LISTED_FLAG_RULES, date_flags=False)


def clean(
    df: DataFrame,
    dataset: str,
    date_fields: Sequence[str],
    rules: Sequence[tuple],
    date_flags: bool,
    threshold: float = FD.HIGH_NULL_FRACTION,
    combine: str = "any",
    formats: Sequence[str] = (),
) -> Cleaned:
    """prune -> parse dates -> date flags -> numeric flags -> any flag -> geo flags.

    One job runs here, the pruning's null counts (see ``drop_high_null``); it counts
    the raw rows as well. All else is lazy.
    """
    kept, dropped, dropped_names, raw_rows = _drop_high_null(df, threshold)
    report = date_parse_report(kept, date_fields, formats)
    out = parse_dates(kept, date_fields, formats)
    dflags: list[str] = []
    if date_flags:
        cols = date_flag_columns(out)
        out = out.withColumns(cols)
        dflags = list(cols)
    ncols = rule_columns(out, rules, combine)
    out = out.withColumns(ncols)
    out = any_flag(out, list(ncols) + dflags)
    out = out.withColumns(geo_flag_columns(out))
    return Cleaned(dataset, df, out, dropped, report, flag_log(kept, rules, dataset), list(ncols), dflags,
                   dropped_names, list(rules), raw_rows)


def clean_sold(df: DataFrame, **kw) -> Cleaned:
    return clean(df, **{**SOLD_PROFILE, **kw})


def clean_listed(df: DataFrame, **kw) -> Cleaned:
    return clean(df, **{**LISTED_PROFILE, **kw})


FLAG_COLUMNS_ORDER = ["geo_null_flag", "geo_sentinel_flag", "geo_invalid_flag", "any_invalid_flag"]


def flag_view(c: Cleaned, key: str = FD.KEY_COLUMN) -> DataFrame:
    """Key plus every flag column of a cleaning run."""
    cols = [key] + c.date_flags + c.numeric_flags + FLAG_COLUMNS_ORDER
    return c.data.select(*[x for x in cols if has(c.data, x)])


def export_dates(df: DataFrame, fmt: str = "yyyy-MM-dd") -> DataFrame:
    """Date and timestamp columns rendered as ``fmt`` text for CSV export."""
    conv = {
        f.name: F.date_format(F.col(f"`{f.name}`"), fmt)
        for f in df.schema.fields
        if isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType))
    }
    return df.withColumns(conv) if conv else df


def geo_stats(sold: Cleaned, listed: Cleaned) -> DataFrame:
    """One row: per dataset, location-column null pct and coordinate counts (two aggregates)."""
    counts = geo_counts(sold.data, sold.dataset).unionByName(geo_counts(listed.data, listed.dataset))
    nulls = geo_nulls(sold.data, sold.dataset).unionByName(geo_nulls(listed.data, listed.dataset))
    by_ds = nulls.groupBy("dataset").agg(
        F.map_from_entries(F.collect_list(F.struct("column_name", "null_pct"))).alias("null_pct"))
    rows = counts.join(by_ds, "dataset")  # two one-row-per-dataset tables
    return rows.agg(F.map_from_entries(F.collect_list(F.struct(
        F.lower("dataset"), F.struct("null_pct", "null_geo", "zero_lat", "zero_lon", "pos_lon")))).alias("by_dataset"))


def cleaning_summary(sold: Cleaned, listed: Cleaned, geo: DataFrame | None = None) -> DataFrame:
    """One nested row: per dataset raw/clean shape, dropped columns, flag totals,
    date-parse results; plus the geographic statistics.

    Built from aggregates only (one per dataset), then written with ``write_summary``.
    """
    def part(c: Cleaned) -> DataFrame:
        sums = [F.sum(F.col(f)).cast("long").alias(f) for f in c.date_flags]
        agg = c.data.agg(F.count(F.lit(1)).alias("clean_rows"),
                         F.sum("any_invalid_flag").cast("long").alias("any_invalid_flag"), *sums)
        raw_rows = F.lit(c.raw_rows).cast("long")
        dropped = F.array(*[F.lit(n) for n in c.dropped_names]).cast("array<string>")
        parse = c.parse_report.agg(F.map_from_entries(F.collect_list(F.struct(
            "column_name", F.struct("before_null", "after_null"))))).scalar()
        fields = [
            raw_rows.alias("raw_rows"),
            F.lit(len(c.raw.columns)).alias("raw_cols"),
            F.col("clean_rows"),
            F.lit(len(c.data.columns)).alias("clean_cols"),
            F.lit(len(c.dropped_names)).alias("cols_dropped"),
            dropped.alias("dropped_col_names"),
            F.col("any_invalid_flag"),
            *[F.col(f) for f in c.date_flags],
            parse.alias("date_parse_results"),
        ]
        return agg.select(F.struct(*fields).alias(c.dataset.lower()))

    s, l = part(sold), part(listed)
    out = s.select(s[sold.dataset.lower()], l.select(listed.dataset.lower()).scalar().alias(listed.dataset.lower()))
    if geo is not None:
        out = out.select("*", geo.select(F.struct(*geo.columns)).scalar().alias("geo_stats"))
    return out

