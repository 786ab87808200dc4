"""Column profiles: value counts, null profiles, numeric statistics, outliers.

Every profile is one aggregate job over the data (one pass computing all
columns' counters), reshaped into long form with ``inline`` — never one job
per column. Statistics with quantiles need several passes; they run over a narrow table
of the numbers that is written first, so the input is derived once. Denominators that are dataset totals come from scalar
subqueries, so no window runs over an unpartitioned frame.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from homestats.functions import fields as FD
from homestats.functions.coerce import as_number, has, pct, round4
from homestats.operators.quantiles import quantile_columns
from homestats.session import stored


def row_count(df: DataFrame) -> Column:
    """Total rows of ``df`` as a scalar-subquery column."""
    return df.agg(F.count(F.lit(1))).scalar()


def _long(pairs: list[tuple[str, Column]], name_col: str, value_col: str) -> Column:
    """``inline`` expression turning (label, column) pairs into rows."""
    return F.inline(F.array(*[F.struct(F.lit(n).alias(name_col), c.alias(value_col)) for n, c in pairs]))


# -- categories -------------------------------------------------------------

def filter_category(df: DataFrame, col: str = FD.PROPERTY_TYPE_COLUMN, value: str = FD.RESIDENTIAL) -> DataFrame:
    """Rows where ``col`` equals ``value`` (nulls never match)."""
    if not has(df, col):
        return df.limit(0)
    return df.where(F.col(col) == F.lit(value))


def filter_audit(df: DataFrame, col: str = FD.PROPERTY_TYPE_COLUMN, value: str = FD.RESIDENTIAL) -> DataFrame:
    """One row: rows before / after the category filter and rows dropped."""
    keep = F.col(col) == F.lit(value) if has(df, col) else F.lit(False)
    return df.agg(
        F.count(F.lit(1)).alias("rows_before"), F.count_if(keep).alias("rows_after")
    ).withColumn("rows_dropped", F.col("rows_before") - F.col("rows_after"))


def value_counts(df: DataFrame, col: str, dropna: bool = True) -> DataFrame:
    """``(value, n, pct)``; pct is over **all** rows, nulls included."""
    if not has(df, col):
        return df.sparkSession.createDataFrame([], "value string, n long, pct double")
    counts = df.groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    if dropna:
        counts = counts.where(F.col("value").isNotNull())
    return counts.select("value", "n", pct(F.col("n"), row_count(df)).alias("pct"))


def top_k(df: DataFrame, col: str, k: int = FD.TOP_K) -> DataFrame:
    """The ``k`` most frequent non-null values; ties by value ascending."""
    return value_counts(df, col).orderBy(F.col("n").desc(), F.col("value").asc()).limit(k)


def check_category(df: DataFrame, col: str = FD.PROPERTY_TYPE_COLUMN, value: str = FD.RESIDENTIAL) -> DataFrame:
    """Every distinct value with its count and PASS iff all rows equal ``value``."""
    if not has(df, col):
        return df.sparkSession.createDataFrame([(None, 0, "FAIL")], "value string, n long, status string")
    all_match = df.agg(F.count_if(F.col(col).eqNullSafe(F.lit(value))) == F.count(F.lit(1))).scalar()
    counts = df.groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    return counts.select("value", "n", F.when(all_match, "PASS").otherwise("FAIL").alias("status"))


# -- nulls ------------------------------------------------------------------

def null_profile(df: DataFrame, decimals: int = 2, threshold: float = FD.HIGH_NULL_FRACTION) -> DataFrame:
    """``(column_name, position, null_count, null_pct, drop_candidate)`` for every column.

    ``drop_candidate`` tests the unrounded fraction against ``threshold``;
    ``null_pct`` is the rounded display value.
    """
    cols = df.columns
    agg = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count(F.col(f"`{c}`")).alias(f"_c{i}") for i, c in enumerate(cols)],
    )
    entries = F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.lit(i).alias("position"), F.col(f"_c{i}").alias("non_null"))
        for i, c in enumerate(cols)
    ])
    longf = agg.select("_rows", F.inline(entries))
    nulls = F.col("_rows") - F.col("non_null")
    return longf.select(
        "column_name",
        "position",
        nulls.alias("null_count"),
        pct(nulls, F.col("_rows"), decimals).alias("null_pct"),
        (F.try_divide(nulls.cast("double"), F.col("_rows").cast("double")) > F.lit(threshold)).alias("drop_candidate"),
    )


def high_null_columns(df: DataFrame, decimals: int = 2, threshold: float = FD.HIGH_NULL_FRACTION) -> DataFrame:
    """Columns whose null fraction exceeds ``threshold`` (drop candidates)."""
    return (
        null_profile(df, decimals, threshold)
        .where("drop_candidate")
        .select("column_name", "null_count", "null_pct")
    )


def complete_columns(df: DataFrame) -> DataFrame:
    """One row: columns with no null at all, and the column total."""
    return null_profile(df).agg(
        F.count_if(F.col("null_count") == 0).alias("complete_columns"),
        F.count(F.lit(1)).alias("total_columns"),
    )


def critical_nulls(df: DataFrame, fields: Sequence[str] = FD.CRITICAL_FIELDS, limit_pct: float = FD.CRITICAL_NULL_PCT) -> DataFrame:
    """Null count / pct of each present critical field; PASS iff pct < limit."""
    present = [f for f in fields if has(df, f)]
    if not present:
        return df.sparkSession.createDataFrame([], "field string, null_count long, null_pct double, status string")
    prof = null_profile(df.select(*present), decimals=4)
    raw_pct = F.try_divide(F.col("null_count") * F.lit(100.0), row_count(df).cast("double"))
    return prof.select(
        F.col("column_name").alias("field"),
        "null_count",
        "null_pct",
        F.when(raw_pct < F.lit(limit_pct), "PASS").otherwise("WARNING").alias("status"),
    )


# -- numbers ----------------------------------------------------------------

def numeric_long(df: DataFrame, fields: Sequence[str], extra: Sequence[str] = ()) -> DataFrame:
    """Unpivot present numeric fields to ``(*extra, field, v)`` with coercion."""
    present = [f for f in fields if has(df, f)]
    if not present:
        # same schema, no rows (extra columns kept for the caller's grouping)
        return df.select(*extra, F.lit(None).cast("string").alias("field"), F.lit(None).cast("double").alias("v")) \
            .where(F.lit(False))
    return df.select(*extra, _long([(f, as_number(df, f)) for f in present], "field", "v"))


def stored_numbers(df: DataFrame, fields: Sequence[str], extra: Sequence[str] = ()) -> DataFrame:
    """``numeric_long`` of a narrow table of the present fields' numbers that is written first, for callers that read it several times.

    What ``df`` is derived from, joins and all, is computed once, whatever the number of reads. One job runs here."""
    present = [f for f in fields if has(df, f)]
    if not present:
        return numeric_long(df, fields, extra)
    numbers = stored(df.select(*extra, *[as_number(df, f).alias(f"_n{i}") for i, f in enumerate(present)]), "numbers")
    return numbers.select(*extra, _long([(f, F.col(f"_n{i}")) for i, f in enumerate(present)], "field", "v"))


def value_or_mark(df: DataFrame, valued: Sequence[str]) -> DataFrame:
    """``df`` with all its columns; those not in ``valued`` only tell (by null or true) whether they hold a value.

    Enough for counts of nulls, and narrow when it is stored."""
    marks = {c: F.when(F.col(f"`{c}`").isNotNull(), F.lit(True)) for c in df.columns if c not in valued}
    return df.withColumns(marks) if marks else df


def _stats(longf: DataFrame, named_q: dict[str, float], by: Sequence[str], with_nulls: bool) -> DataFrame:
    by = list(by)
    plain = [
        F.count("v").alias("count"),
        F.min("v").alias("min"),
        F.max("v").alias("max"),
        round4(F.avg("v")).alias("mean"),
        round4(F.stddev_samp("v")).alias("std"),
    ]
    if with_nulls:
        plain.append((F.count(F.lit(1)) - F.count("v")).alias("null"))
    base = longf.groupBy(*by).agg(*plain).where(F.col("count") > 0)
    q = quantile_columns(longf, "v", named_q, by)
    q = q.select(*by, *[round4(F.col(n)).alias(n) for n in named_q])
    return base.join(q, by, "inner")


def numeric_stats(df: DataFrame, fields: Sequence[str] = FD.STATS_FIELDS) -> DataFrame:
    """count, min, p25, median, p75, max, mean, std per present, non-empty field."""
    longf = stored_numbers(df, fields)
    out = _stats(longf, {"p25": 0.25, "median": 0.5, "p75": 0.75}, ["field"], False)
    return out.select("field", "count", "min", "p25", "median", "p75", "max", "mean", "std")


def numeric_distribution(df: DataFrame, fields: Sequence[str] = FD.DISTRIBUTION_FIELDS) -> DataFrame:
    """count, null, min, p5, p25, median, mean, p75, p95, max, std per field."""
    longf = stored_numbers(df, fields)
    named = {"p5": 0.05, "p25": 0.25, "median": 0.5, "p75": 0.75, "p95": 0.95}
    out = _stats(longf, named, ["field"], True)
    return out.select("field", "count", "null", "min", "p5", "p25", "median", "mean", "p75", "p95", "max", "std")


def compact_stats(df: DataFrame, source_col: str, fields: Sequence[str] = FD.COMPACT_FIELDS) -> DataFrame:
    """Per source and field: min, median, max and null count (fields with values)."""
    longf = stored_numbers(df, fields, extra=[source_col])
    by = [source_col, "field"]
    base = longf.groupBy(*by).agg(
        F.min("v").alias("min"), F.max("v").alias("max"),
        (F.count(F.lit(1)) - F.count("v")).alias("nulls"), F.count("v").alias("_n"),
    ).where(F.col("_n") > 0)
    med = quantile_columns(longf, "v", {"median": 0.5}, by)
    med = med.withColumnsRenamed({source_col: "_source", "field": "_field"})  # a null source is a source
    same = F.col(source_col).eqNullSafe(F.col("_source")) & (F.col("field") == F.col("_field"))
    return base.join(med, same, "inner").select(*by, "min", round4(F.col("median")).alias("median"), "max", "nulls")


def _rule_predicate(v: Column, kind: str, bound: float) -> Column:
    if kind == "le":
        return v <= F.lit(bound)
    if kind == "lt":
        return v < F.lit(bound)
    if kind == "gt":
        return v > F.lit(bound)
    if kind == "ge":
        return v >= F.lit(bound)
    raise ValueError(f"unknown rule kind {kind!r}")


def outlier_counts(df: DataFrame, rules: Sequence[tuple] = FD.OUTLIER_RULES) -> DataFrame:
    """``(field, rule, n)`` for each rule whose field is present, in one pass."""
    present = [r for r in rules if has(df, r[0])]
    if not present:
        return df.sparkSession.createDataFrame([], "field string, rule string, n long")
    agg = df.agg(*[
        F.count_if(_rule_predicate(as_number(df, f), kind, bound)).alias(f"_r{i}")
        for i, (f, _label, kind, bound) in enumerate(present)
    ])
    entries = F.array(*[
        F.struct(F.lit(f).alias("field"), F.lit(label).alias("rule"), F.col(f"_r{i}").alias("n"))
        for i, (f, label, _k, _b) in enumerate(present)
    ])
    return agg.select(F.inline(entries))


def schema_overview(df: DataFrame) -> DataFrame:
    """``(data_type, n_columns, rows, columns)``: columns per type plus the shape.

    The schema is metadata already on the driver; only ``rows`` runs a job.
    """
    spark = df.sparkSession
    types = [(f.dataType.simpleString(),) for f in df.schema.fields]
    tdf = spark.createDataFrame(types, "data_type string") if types else spark.createDataFrame([], "data_type string")
    return tdf.groupBy("data_type").agg(F.count(F.lit(1)).alias("n_columns")).select(
        "data_type", "n_columns", row_count(df).alias("rows"), F.lit(len(df.columns)).alias("columns")
    )


def preview(df: DataFrame, cols: Sequence[str], n: int = 5, order_by: Sequence[str] | None = None) -> DataFrame:
    """First ``n`` rows of the present columns, in an explicit order (top-k, not a full sort)."""
    present = [c for c in cols if has(df, c)]
    order = [c for c in (order_by or present) if c in present]
    return df.select(*present).orderBy(*[F.col(c).asc_nulls_last() for c in order]).limit(n)
