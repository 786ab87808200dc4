"""Distribution tables: upper clipping, equal-width histogram, boxplot numbers.

These replace the picture-only histogram/boxplot of a plotting step with the
numbers behind them. The clip bound is an exact quantile; bin edges and
fences are one-row aggregates used as scalar subqueries.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from homestats.functions import fields as FD
from homestats.functions.coerce import as_number, has, round4
from homestats.operators.profile import stored_numbers
from homestats.operators.quantiles import exact_quantiles, quantile_columns
from homestats.session import stored


def clip_upper(df: DataFrame, col: str, q: float = FD.CLIP_QUANTILE) -> DataFrame:
    """``df`` with ``col`` coerced and capped at its exact ``q`` quantile.

    The quantile's passes read the column's numbers from a table written first; ``df`` itself is read for
    that table and for the result."""
    v = stored(df.select(as_number(df, col).alias("v")), "numbers")
    bound = quantile_columns(v, "v", {"bound": q}).select("bound").scalar()
    v = as_number(df, col)
    return df.withColumn(col, F.when(v.isNotNull(), F.least(v, bound)))


def _per_field(table: DataFrame, value) -> "Column":
    """One-row scalar subquery: map field -> ``value`` over a per-field table.

    The map holds one entry per declared field (a fixed, tiny bound); looking
    it up replaces a join, so the row-level side is never shuffled or joined.
    """
    return table.agg(F.map_from_entries(F.collect_list(F.struct(F.col("field"), value)))).scalar()


def _marks(longf: DataFrame, probs: Sequence[float], clip_q: float) -> DataFrame:
    """Per field: its cap (the ``clip_q`` quantile) and the quantiles ``probs`` of the capped values.

    One quantile run. Capping keeps the order of values, so a quantile of the
    capped values lies between the two order statistics of the raw ones, capped.
    """
    wanted = sorted({*probs, clip_q})
    q = exact_quantiles(longf, "v", wanted, ["field"], bounds=True).where(F.col("q").isNotNull())
    entries = F.map_from_entries(F.collect_list(F.struct("p", F.struct("q", "lo", "hi", "frac"))))  # len(wanted) entries
    per = q.groupBy("field").agg(entries.alias("at"))
    per = per.withColumn("cap", F.element_at("at", F.lit(float(clip_q)))["q"])

    def capped(p: float):
        at = F.element_at("at", F.lit(float(p)))
        low, high = F.least(at["lo"], F.col("cap")), F.least(at["hi"], F.col("cap"))
        return low + (high - low) * at["frac"]

    return per.select("field", "cap", *[capped(p).alias(f"p{i}") for i, p in enumerate(probs)])


def histograms(df: DataFrame, fields: Sequence[str] = FD.DISTRIBUTION_FIELDS, bins: int = FD.HISTOGRAM_BINS,
               clip_q: float = FD.CLIP_QUANTILE) -> DataFrame:
    """``(field, bin, lower, upper, n)``: equal-width bins over each field's clipped values.

    The last bin is closed on the right; all bins are present, empty ones with 0.
    A constant field is widened by 0.5 on each side. Caps and ends of all fields come from
    one quantile run (the smallest and largest values are its quantiles 0 and 1).
    """
    longf = stored_numbers(df, fields).where(F.col("v").isNotNull())
    ends = _marks(longf, [0.0, 1.0], clip_q)
    same = F.col("p0") == F.col("p1")
    ends = ends.select(
        "field", "cap", (F.col("p0") - F.when(same, 0.5).otherwise(0.0)).alias("lo"), (F.col("p1") + F.when(same, 0.5).otherwise(0.0)).alias("hi")
    )
    by_field = F.element_at(_per_field(ends, F.struct("cap", "lo", "hi")), F.col("field"))
    c = longf.select("field", by_field.alias("e"), "v").select("field", "e", F.least(F.col("v"), F.col("e.cap")).alias("v"))
    lo, hi = F.col("e.lo"), F.col("e.hi")
    idx = F.least(F.floor((F.col("v") - lo) * F.lit(bins) / (hi - lo)), F.lit(bins - 1)).cast("int")
    counts = c.groupBy("field", idx.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    width = (F.col("hi") - F.col("lo")) / F.lit(bins)
    grid = ends.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    return grid.join(counts, ["field", "bin"], "left").select(
        "field", F.col("bin").cast("int").alias("bin"),
        round4(F.col("lo") + F.col("bin") * width).alias("lower"),
        round4(F.col("lo") + (F.col("bin") + 1) * width).alias("upper"),
        F.coalesce(F.col("n"), F.lit(0)).cast("long").alias("n"),
    )


def histogram(df: DataFrame, col: str, bins: int = FD.HISTOGRAM_BINS, clip_q: float = FD.CLIP_QUANTILE) -> DataFrame:
    """``(bin, lower, upper, n)`` of one column; no rows if it is absent or empty (see ``histograms``)."""
    return histograms(df, [col], bins, clip_q).drop("field")


def boxplot_stats(df: DataFrame, fields: Sequence[str] = FD.DISTRIBUTION_FIELDS, clip_q: float = FD.CLIP_QUANTILE) -> DataFrame:
    """Per field, on values clipped at ``clip_q``: quartiles, 1.5*IQR whiskers, outliers.

    Cap and quartiles come from one quantile run; whiskers and outliers from one pass
    over the values."""
    longf = stored_numbers(df, fields).where(F.col("v").isNotNull())
    marks = _marks(longf, [0.25, 0.5, 0.75], clip_q).withColumnsRenamed({"p0": "q1", "p1": "median", "p2": "q3"})
    e = F.element_at(_per_field(marks, F.struct("cap", "q1", "median", "q3")), F.col("field"))
    j = longf.select("field", e.alias("e"), "v").select("field", F.least(F.col("v"), F.col("e.cap")).alias("v"), "e.q1", "e.median", "e.q3")
    iqr = F.col("q3") - F.col("q1")
    low, high = F.col("q1") - 1.5 * iqr, F.col("q3") + 1.5 * iqr
    agg = j.groupBy("field").agg(
        F.first("q1").alias("q1"), F.first("median").alias("median"), F.first("q3").alias("q3"),
        F.min(F.when(F.col("v") >= low, F.col("v"))).alias("whisker_low"),
        F.max(F.when(F.col("v") <= high, F.col("v"))).alias("whisker_high"),
        F.count_if((F.col("v") < low) | (F.col("v") > high)).alias("n_outliers"),
    ).withColumn("iqr", F.col("q3") - F.col("q1"))
    return agg.select(
        "field", round4(F.col("q1")).alias("q1"), round4(F.col("median")).alias("median"),
        round4(F.col("q3")).alias("q3"), round4(F.col("iqr")).alias("iqr"),
        F.coalesce(F.col("whisker_low"), F.col("q1")).alias("whisker_low"),
        F.coalesce(F.col("whisker_high"), F.col("q3")).alias("whisker_high"),
        "n_outliers",
    )
