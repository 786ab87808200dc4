"""Month-based checks: monthly counts, their summary, date coverage, gaps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from homestats.functions import fields as FD
from homestats.functions.coerce import as_date, month_key, round4


def month_keys(df: DataFrame, date_col: str, out: str = FD.MONTH_COLUMN) -> DataFrame:
    """``df`` with a ``yyyy-MM`` month key of the parsed date (null when unparsable)."""
    return df.withColumn(out, month_key(as_date(df, date_col)))


def month_key_counts(df: DataFrame, date_col: str) -> DataFrame:
    """Rows per month key, the null key included (how many rows cannot be keyed)."""
    return month_keys(df, date_col).groupBy(FD.MONTH_COLUMN).agg(F.count(F.lit(1)).alias("n"))


def monthly_counts(df: DataFrame, date_col: str, width: int = FD.BAR_WIDTH) -> DataFrame:
    """``(year_month, n, bar)``; unparsable dates are left out; bar = int(n / max * width)."""
    m = (
        df.select(month_key(as_date(df, date_col)).alias("year_month"))
        .where(F.col("year_month").isNotNull())
        .groupBy("year_month")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    peak = m.agg(F.max("n")).scalar()
    return m.select("year_month", "n", F.floor(F.col("n") / peak * F.lit(width)).cast("int").alias("bar"))


def monthly_summary(monthly: DataFrame) -> DataFrame:
    """Total, mean over present months, min / max with the earliest month on ties."""
    return monthly.agg(
        F.sum("n").alias("total"),
        F.count(F.lit(1)).alias("months"),
        round4(F.avg("n")).alias("mean"),
        F.min("n").alias("min_n"),
        F.min_by("year_month", F.struct(F.col("n"), F.col("year_month"))).alias("min_month"),
        F.max("n").alias("max_n"),
        F.min_by("year_month", F.struct(-F.col("n"), F.col("year_month"))).alias("max_month"),
    )


def date_coverage(df: DataFrame, date_col: str, start: str = "2024-01", end: str = "2026-02") -> DataFrame:
    """Valid / invalid dates, earliest / latest, and the start / end checks.

    start: PASS iff the earliest date falls in month ``start``.
    end: PASS iff the latest date is in ``end``'s year at or after its month.
    """
    d = as_date(df, date_col)
    agg = df.agg(
        F.count(d).alias("valid"),
        (F.count(F.lit(1)) - F.count(d)).alias("invalid"),
        F.min(d).alias("earliest"),
        F.max(d).alias("latest"),
    )
    sy, sm = (int(x) for x in start.split("-"))
    ey, em = (int(x) for x in end.split("-"))
    start_ok = (F.year("earliest") == sy) & (F.month("earliest") == sm)
    end_ok = (F.year("latest") == ey) & (F.month("latest") >= em)
    return agg.select(
        "valid", "invalid", "earliest", "latest",
        F.when(F.coalesce(start_ok, F.lit(False)), "PASS").otherwise("WARNING").alias("start_status"),
        F.when(F.coalesce(end_ok, F.lit(False)), "PASS").otherwise("WARNING").alias("end_status"),
    )


def expected_months(spark, start: str, end: str) -> DataFrame:
    """Every ``yyyy-MM`` from ``start`` to ``end`` inclusive (a calendar, bounded by the range)."""
    seq = F.sequence(F.to_date(F.lit(start + "-01")), F.to_date(F.lit(end + "-01")), F.expr("INTERVAL 1 MONTH"))
    return spark.range(1).select(F.explode(seq).alias("m")).select(month_key(F.col("m")).alias("year_month"))


def missing_months(df: DataFrame, date_col: str, start: str = "2024-01", end: str = "2026-03") -> DataFrame:
    """Months of the expected range with no row."""
    present = (
        df.select(month_key(as_date(df, date_col)).alias("year_month"))
        .where(F.col("year_month").isNotNull())
        .distinct()
    )
    return expected_months(df.sparkSession, start, end).join(present, "year_month", "left_anti")

