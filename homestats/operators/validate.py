"""Dataset validation: duplicate keys, the nine-check validation table, per-source
profile and dataset totals. Each check is an aggregate; the validation table is
their union in one schema ``(check, field, status, value)``."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from homestats.functions import fields as FD
from homestats.functions.coerce import as_date, as_number, has, month_key, pct, round4
from homestats.operators.calendar import monthly_summary
from homestats.operators.profile import _rule_predicate, numeric_long, value_or_mark
from homestats.operators.quantiles import quantile_columns
from homestats.session import scratch_path, stored


def duplicate_check(df: DataFrame, key: str = FD.KEY_COLUMN) -> DataFrame:
    """total, unique (non-null distinct), duplicates = total - unique, null keys, status."""
    if not has(df, key):
        return df.sparkSession.createDataFrame(
            [(0, 0, 0, 0, "SKIPPED")], "total long, unique long, duplicates long, null_keys long, status string")
    agg = df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_distinct(F.col(key)).alias("unique"),
        F.count_if(F.col(key).isNull()).alias("null_keys"),
    )
    return agg.select(
        "total", "unique", (F.col("total") - F.col("unique")).alias("duplicates"), "null_keys",
        F.when(F.col("total") == F.col("unique"), "PASS").otherwise("WARNING").alias("status"),
    )


def _month_list(start: str, end: str) -> list[str]:
    """Every ``yyyy-MM`` from ``start`` to ``end`` (a calendar literal, bounded by the range)."""
    (sy, sm), (ey, em) = ((int(x) for x in v.split("-")) for v in (start, end))
    out = []
    y, m = sy, sm
    while (y, m) <= (ey, em):
        out.append(f"{y:04d}-{m:02d}")
        y, m = (y + 1, 1) if m == 12 else (y, m + 1)
    return out


def _check(name: str, field, status, value, detail=None):
    return F.struct(
        F.lit(name).alias("check"),
        F.lit(field).cast("string").alias("field"),
        (F.lit(status) if isinstance(status, str) else status).alias("status"),
        value.cast("double").alias("value"),
        (F.lit(None) if detail is None else detail).cast("string").alias("detail"),
    )


def _rows(df: DataFrame, *structs) -> DataFrame:
    """Check rows made of each row of a (small) table."""
    return df.select(F.inline(F.array(*structs)))


def _source_checks(files: DataFrame) -> DataFrame:
    """Check 1: files found and their size, from a source listing (``list_sources``)."""
    found = files.agg(F.count(F.lit(1)).alias("n"), F.sum("length").alias("bytes"))
    status = F.when(F.col("n") > 0, "PASS").otherwise("FAIL")
    return _rows(found, _check("source_files", None, status, F.col("n")), _check("source_bytes", None, "INFO", F.col("bytes")))


def _frequencies(df: DataFrame, date_col: str, key: str, cols: list[str]) -> DataFrame:
    """``(kind, value, n, d)`` from one scan, written: rows per month, per value of each of ``cols``, and in all.

    Of keys only their number of rows and of distinct values (``d``) is kept. Nulls aren't counted. Values
    of a kind meet in their own rows of the shuffle, summed in each task before, so no kind is one task's.
    """
    kinds = [("rows", F.lit(""))]
    if has(df, date_col):
        kinds.append(("month", month_key(as_date(df, date_col))))
    if has(df, key):
        kinds.append(("key", F.col(key)))
    kinds += [(f"value:{c}", F.col(c)) for c in cols]
    each = F.array(*[F.struct(F.lit(kind).alias("kind"), v.cast("string").alias("value")) for kind, v in kinds])
    counts = df.select(F.inline(each)).where("value IS NOT NULL").groupBy("kind", "value").agg(F.count(F.lit(1)).alias("n"))
    value = F.when(F.col("kind") != "key", F.col("value")).alias("value")
    counts = counts.groupBy("kind", value).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("d"))
    path = scratch_path(df.sparkSession, "frequencies")
    counts.write.parquet(path)
    return df.sparkSession.read.schema(counts.schema).parquet(path)


def _monthly_checks(months: DataFrame, date_col: str) -> DataFrame:
    """Check 5: rows per month, their total, mean, and the months with fewest and most rows."""
    each = months.select(F.inline(F.array(_check("month_rows", None, "INFO", F.col("n"), F.col("year_month")))))
    m = monthly_summary(months).where(F.col("months") > 0)
    summary = _rows(
        m, _check("month_total", date_col, "INFO", F.col("total")), _check("month_mean", date_col, "INFO", F.col("mean")),
        _check("month_min", date_col, "INFO", F.col("min_n"), F.col("min_month")),
        _check("month_max", date_col, "INFO", F.col("max_n"), F.col("max_month")),
    )
    return each.withColumn("field", F.lit(date_col)).unionByName(summary)


def _quantile_checks(df: DataFrame) -> DataFrame:
    """Check 7: quartiles of each key numeric field that has values, a row per quartile.

    Ranged, which reads its input once; selection between bounds would read it twice."""
    named = {"p25": 0.25, "median": 0.5, "p75": 0.75}
    wide = quantile_columns(numeric_long(df, FD.STATS_FIELDS), "v", named, ["field"], method="distributed")
    return _rows(wide, *[_check(f"numeric_{n}", F.col("field"), "INFO", round4(F.col(n))) for n in named])


def _count_checks(name: str, counts: DataFrame, col: str, total) -> DataFrame:
    """Counts of a column's values and their share of all rows; the value is the detail."""
    share = pct(F.col("n"), total)
    return _rows(counts, _check(name, col, "INFO", F.col("n"), F.col("value")), _check(f"{name}_pct", col, "INFO", share, F.col("value")))


def stored_input(df: DataFrame, date_col: str) -> DataFrame:
    """What ``validate_dataset`` needs of ``df`` (with its default fields), written once: the values that checks use, null marks of
    the other columns. Its three reads then don't derive ``df`` again. One job runs here."""
    valued = [FD.PROPERTY_TYPE_COLUMN, date_col, FD.KEY_COLUMN, "PropertySubType", "City", "CountyOrParish",
              *[r[0] for r in FD.OUTLIER_RULES], *FD.STATS_FIELDS]
    return stored(value_or_mark(df, valued), "validated")


def validate_dataset(
    df: DataFrame,
    date_col: str,
    key: str = FD.KEY_COLUMN,
    category_col: str = FD.PROPERTY_TYPE_COLUMN,
    category: str = FD.RESIDENTIAL,
    start: str = "2024-01",
    end: str = "2026-02",
    expected_end: str = "2026-03",
    critical=FD.CRITICAL_FIELDS,
    rules=FD.OUTLIER_RULES,
    limit_pct: float = FD.CRITICAL_NULL_PCT,
    threshold: float = FD.HIGH_NULL_FRACTION,
    files: DataFrame | None = None,
    subtype_col: str = "PropertySubType",
    top_cols=("City", "CountyOrParish"),
    k: int = FD.TOP_K,
) -> DataFrame:
    """All nine checks of a combined dataset as rows ``(check, field, status, value, detail)``.

    1 source files (from ``files``, a listing of them, if given), 2 category, 3 date
    coverage, 4 duplicate keys, 5 monthly rows, 6 nulls and critical fields, 7 numeric
    statistics and outliers, 8 subtype breakdown, 9 top values of ``top_cols``. ``detail``
    is what a check's number is about: a month, a category value, a date, a null count.

    The input is read three times, whatever its checks (see ``stored_input`` for one that is dear to derive). One aggregate computes every counter (row and column
    counts, category mismatches, date range, the set of months present — at most one entry per
    calendar month —, per-column non-null counts, numeric ranges and means, outlier hits); the
    check rows are unpacked from that single row. One table of frequencies holds months,
    subtypes, top values and the number of distinct keys. The quartiles have a pass of their own. The
    frequencies and the quartiles' chunks are written when this is called.
    """
    cols = df.columns
    d = F.col("_v_date")
    aggs = [F.count(F.lit(1)).alias("_rows")]
    aggs += [F.count(F.col(f"`{c}`")).alias(f"_nn{i}") for i, c in enumerate(cols)]
    if has(df, category_col):
        aggs.append(F.count_if(~F.col(category_col).eqNullSafe(F.lit(category))).alias("_other"))
    if has(df, date_col):
        aggs += [F.count(d).alias("_valid"), F.min(d).alias("_first"), F.max(d).alias("_last"),
                 F.collect_set(month_key(d)).alias("_months")]
    present_rules = [r for r in rules if has(df, r[0])]
    # each number and date is parsed once, below the aggregate
    parsed = {f: f"_v_{i}" for i, f in enumerate(dict.fromkeys([*[r[0] for r in present_rules], *FD.STATS_FIELDS])) if has(df, f)}
    aggs += [F.count_if(_rule_predicate(F.col(parsed[f]), k, b)).alias(f"_o{i}")
             for i, (f, _l, k, b) in enumerate(present_rules)]
    numeric = [f for f in FD.STATS_FIELDS if has(df, f)]
    for i, f in enumerate(numeric):
        v = F.col(parsed[f])
        aggs += [F.count(v).alias(f"_s{i}_count"), F.min(v).alias(f"_s{i}_min"), F.max(v).alias(f"_s{i}_max"),
                 F.avg(v).alias(f"_s{i}_mean"), F.stddev_samp(v).alias(f"_s{i}_std")]
    numbers = {name: as_number(df, f) for f, name in parsed.items()}
    one = df.withColumns(numbers | ({"_v_date": as_date(df, date_col)} if has(df, date_col) else {})).agg(*aggs)
    counted = list(dict.fromkeys(c for c in (subtype_col, *top_cols) if has(df, c)))
    freq = _frequencies(df, date_col, key, counted)
    if has(df, key):
        keys = freq.where("kind = 'key'").agg(F.coalesce(F.sum("d"), F.lit(0)))
        one = one.withColumn("_uniq", keys.scalar())

    rows = F.col("_rows")
    checks = [_check("rows", None, "INFO", rows), _check("columns", None, "INFO", F.lit(len(cols)))]
    if has(df, category_col):
        checks.append(_check("category", category_col,
                             F.when(F.col("_other") == 0, "PASS").otherwise("FAIL"), F.col("_other")))
    else:
        checks.append(_check("category", category_col, "FAIL", F.lit(None)))
    if has(df, date_col):
        sy, sm = (int(x) for x in start.split("-"))
        ey, em = (int(x) for x in end.split("-"))
        first, last = F.col("_first"), F.col("_last")
        start_ok = F.coalesce((F.year(first) == sy) & (F.month(first) == sm), F.lit(False))
        end_ok = F.coalesce((F.year(last) == ey) & (F.month(last) >= em), F.lit(False))
        expected = F.array(*[F.lit(m) for m in _month_list(start, expected_end)])
        gaps = F.size(F.array_except(expected, F.col("_months")))
        checks += [
            _check("date_valid", date_col, "INFO", F.col("_valid")),
            _check("date_invalid", date_col, "INFO", rows - F.col("_valid")),
            _check("date_start", date_col, F.when(start_ok, "PASS").otherwise("WARNING"),
                   F.year(first) * 100 + F.month(first), F.date_format(first, "yyyy-MM-dd")),
            _check("date_end", date_col, F.when(end_ok, "PASS").otherwise("WARNING"),
                   F.year(last) * 100 + F.month(last), F.date_format(last, "yyyy-MM-dd")),
            _check("missing_months", date_col, F.when(gaps == 0, "PASS").otherwise("WARNING"), gaps),
        ]
    else:
        checks.append(_check("date_valid", date_col, "FAIL", F.lit(None)))
    if has(df, key):
        checks.append(_check("duplicates", key, F.when(rows == F.col("_uniq"), "PASS").otherwise("WARNING"),
                             rows - F.col("_uniq")))
    nulls = [rows - F.col(f"_nn{i}") for i in range(len(cols))]
    frac = [F.try_divide(n.cast("double"), rows.cast("double")) for n in nulls]
    high = sum((F.when(f > threshold, 1).otherwise(0) for f in frac), F.lit(0))
    complete = sum((F.when(n == 0, 1).otherwise(0) for n in nulls), F.lit(0))
    checks += [_check("high_null_columns", None, "INFO", high), _check("complete_columns", None, "INFO", complete)]
    for c in critical:
        if has(df, c):
            n = nulls[cols.index(c)]
            raw = F.try_divide(n * F.lit(100.0), rows.cast("double"))
            checks.append(_check("critical_null", c, F.when(raw < limit_pct, "PASS").otherwise("WARNING"),
                                 pct(n, rows, 4), n))
    for i, (_f, label, _k, _b) in enumerate(present_rules):
        o = F.col(f"_o{i}")
        checks.append(_check("outlier", label, F.when(o == 0, "PASS").otherwise("WARNING"), o))
    stats = []
    for i, f in enumerate(numeric):
        of = [_check("numeric_count", f, "INFO", F.col(f"_s{i}_count")), _check("numeric_min", f, "INFO", F.col(f"_s{i}_min")),
              _check("numeric_max", f, "INFO", F.col(f"_s{i}_max")), _check("numeric_mean", f, "INFO", round4(F.col(f"_s{i}_mean"))),
              _check("numeric_std", f, "INFO", round4(F.col(f"_s{i}_std")))]
        # a field without values has no statistics
        stats.append(F.slice(F.array(*of), F.lit(1), F.when(F.col(f"_s{i}_count") > 0, len(of)).otherwise(0)))
    parts = [one.select(F.inline(F.concat(F.array(*checks), *stats))), _quantile_checks(df)]
    if files is not None:
        parts.append(_source_checks(files))
    if has(df, date_col):
        months = freq.where("kind = 'month'").select(F.col("value").alias("year_month"), "n")
        parts.append(_monthly_checks(months, date_col))
    total = freq.where("kind = 'rows'").agg(F.sum("n")).scalar()
    if has(df, subtype_col):
        parts.append(_count_checks("subtype", freq.where(F.col("kind") == f"value:{subtype_col}"), subtype_col, total))
    for c in top_cols:
        if has(df, c):
            top = freq.where(F.col("kind") == f"value:{c}").orderBy(F.col("n").desc(), F.col("value")).limit(k)
            parts.append(_count_checks("top", top, c, total))
    return reduce(DataFrame.unionByName, parts)


def per_source_profile(
    df: DataFrame, source_col: str, date_col: str, critical=FD.FILE_CRITICAL_FIELDS, limit_pct: float = FD.CRITICAL_NULL_PCT
) -> DataFrame:
    """One row per source: rows, valid dates, date range, critical fields over the null limit.

    One grouped aggregate over all sources (not a loop over files).
    """
    d = as_date(df, date_col)
    present = [c for c in critical if has(df, c)]
    over = [
        F.when(F.try_divide(F.count_if(F.col(c).isNull()) * F.lit(100.0), F.count(F.lit(1)).cast("double")) > limit_pct, 1)
        .otherwise(0)
        for c in present
    ]
    n_over = sum(over[1:], over[0]) if over else F.lit(0)
    return df.groupBy(source_col).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count(d).alias("valid_dates"),
        F.min(d).alias("min_date"),
        F.max(d).alias("max_date"),
        n_over.alias("high_null_fields"),
    )


def per_source_critical(
    df: DataFrame, source_col: str, critical=FD.FILE_CRITICAL_FIELDS, limit_pct: float = FD.CRITICAL_NULL_PCT
) -> DataFrame:
    """``(source, field, null_pct)`` of the present critical fields over the null limit, per source."""
    present = [c for c in critical if has(df, c)]
    if not present:
        return df.select(source_col, F.lit("").alias("field"), F.lit(0.0).alias("null_pct")).limit(0)
    n = F.count(F.lit(1))
    share = [F.try_divide(F.count_if(F.col(c).isNull()) * F.lit(100.0), n.cast("double")) for c in present]
    counted = df.groupBy(source_col).agg(*[
        F.struct(F.lit(c).alias("field"), x.alias("raw"), pct(F.count_if(F.col(c).isNull()), n).alias("null_pct")).alias(f"_f{i}")
        for i, (c, x) in enumerate(zip(present, share, strict=True))
    ])
    long = counted.select(source_col, F.inline(F.array(*[F.col(f"_f{i}") for i in range(len(present))])))
    return long.where(F.col("raw") > limit_pct).select(source_col, "field", "null_pct")


def per_source_type_mix(df: DataFrame, source_col: str, col: str = FD.PROPERTY_TYPE_COLUMN) -> DataFrame:
    """Per source: value counts of ``col`` (nulls left out) with pct of the source's rows.

    Both aggregates are grouped (map-side combined); the per-source totals table
    has one row per source file, and the join runs between the two small
    aggregated tables, never on row-level data.
    """
    if not has(df, col):
        return df.sparkSession.createDataFrame([], f"{source_col} string, value string, n long, pct double")
    totals = df.groupBy(source_col).agg(F.count(F.lit(1)).alias("_rows"))
    counts = (
        df.where(F.col(col).isNotNull())
        .groupBy(source_col, F.col(col).alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    totals = totals.withColumnRenamed(source_col, "_source")  # a null source is a source
    joined = counts.join(totals, F.col(source_col).eqNullSafe(F.col("_source")))
    return joined.select(source_col, "value", "n", pct(F.col("n"), F.col("_rows")).alias("pct"))


def dataset_summary(df: DataFrame, source_col: str, date_col: str) -> DataFrame:
    """One row: sources, rows, columns, date range and distinct months of the union."""
    d = as_date(df, date_col)
    # one row per source and month first: the distinct counts then run over that small table
    small = df.groupBy(F.col(source_col).alias("_source"), month_key(d).alias("_month")).agg(
        F.count(F.lit(1)).alias("_n"), F.min(d).alias("_first"), F.max(d).alias("_last"))
    return small.agg(
        F.count_distinct("_source").alias("sources"),
        F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("rows"),
        F.lit(len(df.columns)).alias("columns"),
        F.min("_first").alias("min_date"),
        F.max("_last").alias("max_date"),
        F.count_distinct("_month").alias("months"),
    )
