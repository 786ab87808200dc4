"""Market questions over a sold dataset: prices, days on market, list-price gap."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from homestats.functions import fields as FD
from homestats.functions.coerce import as_date, as_number, flag, has, pct, round4
from homestats.operators.quantiles import quantile_columns
from homestats.session import stored


def close_price_summary(df: DataFrame, col: str = "ClosePrice") -> DataFrame:
    """One row: median and mean of the coerced price (nulls ignored)."""
    v = stored(df.select(as_number(df, col).alias("v")), "numbers")  # read by several passes
    plain = v.agg(F.count("v").alias("n"), round4(F.avg("v")).alias("mean_price"))
    return _one_row_stats(v, {"median_price": 0.5}, plain)


def _one_row_stats(v: DataFrame, named: dict[str, float], plain: DataFrame) -> DataFrame:
    """Attach one-row quantiles to a one-row aggregate through scalar subqueries."""
    q = quantile_columns(v, "v", named)
    cols = [F.col(c) for c in plain.columns]
    cols += [round4(q.select(F.col(name)).scalar()).alias(name) for name in named]
    return plain.select(*cols)


def dom_summary(df: DataFrame, col: str = "DaysOnMarket") -> DataFrame:
    """One row: median, mean, p75, p90 and max days on market."""
    v = stored(df.select(as_number(df, col).alias("v")), "numbers")  # read by several passes
    plain = v.agg(
        F.count("v").alias("n"), round4(F.avg("v")).alias("mean_days"), F.max("v").alias("max_days")
    )
    return _one_row_stats(v, {"median_days": 0.5, "p75_days": 0.75, "p90_days": 0.9}, plain)


def price_vs_list(df: DataFrame, close: str = "ClosePrice", listed: str = "ListPrice") -> DataFrame:
    """Sold above / at / below list price among rows with both prices and list > 0."""
    cp, lp = as_number(df, close), as_number(df, listed)
    both = cp.isNotNull() & lp.isNotNull() & (lp > 0)
    agg = df.agg(
        F.count_if(both & (cp > lp)).alias("above"),
        F.count_if(both & (cp == lp)).alias("at_list"),
        F.count_if(both & (cp < lp)).alias("below"),
        F.count_if(both).alias("base"),
    )
    return agg.select(
        "above", "at_list", "below", "base",
        pct(F.col("above"), F.col("base")).alias("pct_above"),
        pct(F.col("at_list"), F.col("base")).alias("pct_at"),
        pct(F.col("below"), F.col("base")).alias("pct_below"),
    )


def date_order_count(df: DataFrame, earlier: str = "ListingContractDate", later: str = "CloseDate") -> DataFrame:
    """Rows whose ``earlier`` date is after the ``later`` one (both parsed)."""
    if not (has(df, earlier) and has(df, later)):
        return df.sparkSession.range(1).select(F.lit(0).cast("long").alias("n_violations"))
    return df.agg(F.sum(flag(as_date(df, earlier) > as_date(df, later))).cast("long").alias("n_violations"))


def top_groups_by_median(
    df: DataFrame,
    group: str = "CountyOrParish",
    value: str = "ClosePrice",
    min_n: int = FD.MIN_TRANSACTIONS,
    k: int = FD.TOP_K,
    median_col: str = "median_price",
    count_col: str = "transactions",
) -> DataFrame:
    """Top-k groups by exact median value among groups with >= ``min_n`` values.

    Null group keys are dropped (as a pandas ``groupby`` does); ties on the
    median are broken by group name so the result is deterministic.
    """
    v = df.select(F.col(group).alias(group), as_number(df, value).alias("v")).where(F.col(group).isNotNull())
    v = stored(v, "numbers")  # read by several passes
    counts = v.groupBy(group).agg(F.count("v").alias(count_col)).where(F.col(count_col) >= min_n)
    # Medians for every group, then HAVING on the (small, per-group) count table:
    # no join ever touches the row-level side, so a hot group cannot skew one task.
    med = quantile_columns(v, "v", {median_col: 0.5}, [group])
    return (
        counts.join(med, group, "inner")
        .select(group, round4(F.col(median_col)).alias(median_col), F.col(count_col))
        .orderBy(F.col(median_col).desc(), F.col(group).asc())
        .limit(k)
    )
