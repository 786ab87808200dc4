"""Mortgage-rate series: cleaning, weekly->monthly means, the left join onto a
dataset by month key, and the join's audit.

The monthly table holds at most one row per calendar month (it is grouped on
the ``yyyy-MM`` key), so its size is bounded by the calendar, not by the data:
it is safe to broadcast, and the large side is never shuffled by the join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from homestats.functions.coerce import round_half_even

from homestats.functions import fields as FD
from homestats.functions.coerce import as_date, as_number, month_key


def rates_clean(raw: DataFrame, date_col: str = FD.RATE_DATE_SOURCE, value_col: str = FD.RATE_VALUE_SOURCE) -> DataFrame:
    """``(date, rate_30yr_fixed)``: parsed date, numeric rate, rows without a rate dropped."""
    return raw.select(
        as_date(raw, date_col).alias("date"), as_number(raw, value_col).alias(FD.RATE_COLUMN)
    ).dropna(subset=[FD.RATE_COLUMN])


def rates_monthly(rates: DataFrame) -> DataFrame:
    """``(year_month, rate_30yr_fixed)``: monthly mean, half-even rounded to 4 decimals."""
    return (
        rates.where(F.col("date").isNotNull())
        .groupBy(month_key(F.col("date")).alias(FD.MONTH_COLUMN))
        .agg(round_half_even(F.avg(FD.RATE_COLUMN), 4).alias(FD.RATE_COLUMN))
    )


def rates_coverage(rates: DataFrame) -> DataFrame:
    """One row: observations, first / last date, lowest / highest rate."""
    return rates.agg(
        F.count(F.lit(1)).alias("n"),
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
        F.min(FD.RATE_COLUMN).alias("min_rate"),
        F.max(FD.RATE_COLUMN).alias("max_rate"),
    )


def rates_recent(monthly: DataFrame, n: int = 6) -> DataFrame:
    """The ``n`` most recent months (a top-k, not a full sort)."""
    return monthly.orderBy(F.col(FD.MONTH_COLUMN).desc()).limit(n)


def enrich_with_rates(df: DataFrame, monthly: DataFrame, date_col: str) -> DataFrame:
    """Left join of the monthly rate onto ``df`` by the month of ``date_col``.

    Rows with an unparsable date get a null key and a null rate; the row count
    never changes. ``monthly`` is broadcast (one row per month, see module doc).
    """
    keyed = df.withColumn(FD.MONTH_COLUMN, month_key(as_date(df, date_col)))
    return keyed.join(F.broadcast(monthly), FD.MONTH_COLUMN, "left")


def join_audit(before: DataFrame, after: DataFrame, rate_col: str = FD.RATE_COLUMN, key_col: str = FD.MONTH_COLUMN) -> DataFrame:
    """One row: rows before / after, null keys, null rates, PASS iff no null rate."""
    rows_before = before.agg(F.count(F.lit(1))).scalar()
    agg = after.agg(
        F.count(F.lit(1)).alias("rows_after"),
        F.count_if(F.col(key_col).isNull()).alias("null_keys"),
        F.count_if(F.col(rate_col).isNull()).alias("null_rates"),
    )
    return agg.select(
        rows_before.alias("rows_before"),
        "rows_after",
        "null_keys",
        "null_rates",
        (rows_before == F.col("rows_after")).alias("row_count_kept"),
        F.when(F.col("null_rates") == 0, "PASS").otherwise("WARNING").alias("status"),
    )


def unmatched_keys(after: DataFrame, rate_col: str = FD.RATE_COLUMN, key_col: str = FD.MONTH_COLUMN) -> DataFrame:
    """``(year_month, n)``: keyed rows that found no rate (null keys left out)."""
    return (
        after.where(F.col(rate_col).isNull() & F.col(key_col).isNotNull())
        .groupBy(key_col)
        .agg(F.count(F.lit(1)).alias("n"))
    )
