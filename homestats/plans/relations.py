"""The relations every registered query starts from, built lazily per run."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from homestats.functions import fields as FD
from homestats.operators.clean import Cleaned, clean_listed, clean_sold
from homestats.operators.profile import filter_category
from homestats.operators.rates import enrich_with_rates, rates_clean, rates_monthly
from homestats.session import release
from homestats.sources.testrel import joined_rows, relation, relation_of

#: Rows are dealt by month in up to so many parts, of so many rows at least.
DEALT_PARTS, DEALT_ROWS = 4, 800_000


class Relations:
    """sold / listed / rates derived from the driver tables, and the stages after them."""

    def __init__(self, spark: SparkSession, sf_dir: str, tables: dict[str, DataFrame] | None = None):
        self.spark, self.sf_dir = spark, sf_dir
        self._tables = tables or {}

    @classmethod
    def from_tables(cls, spark: SparkSession, sold: DataFrame, listed: DataFrame, rates: DataFrame) -> "Relations":
        """Start from already materialised sold / listed / rate tables (e.g. a silver layer)."""
        return cls(spark, "", {"sold": sold, "listed": listed, "rates": rates})

    @cached_property
    def sold(self) -> DataFrame:
        if "sold" in self._tables:
            return self._tables["sold"]
        return relation(self.spark, self.sf_dir, "sold")

    @cached_property
    def listed(self) -> DataFrame:
        if "listed" in self._tables:
            return self._tables["listed"]
        return relation(self.spark, self.sf_dir, "listed")

    @contextmanager
    def by_month(self, name: str) -> Iterator[list[DataFrame]]:
        """``sold`` or ``listed`` in parts of whole months, each dealt by the month of the listing date, a hot month over several tasks.

        Only the base columns move; the relation's own are computed where they arrive. Many rows are parted in up to
        ``DEALT_PARTS``, to be written one after the other: only one part's shuffle lies on the disks at a time.
        What is kept on the way goes at the end."""
        if name in self._tables:
            rows = self._tables[name].withColumn("_month", F.substring("ListingContractDate", 1, 7))
            yield [rows.hint("rebalance", F.col("_month")).drop("_month")]
            return
        rows = joined_rows(self.spark, self.sf_dir, name)
        n = max(1, min(DEALT_PARTS, rows.count() // DEALT_ROWS))
        date = F.col("o_orderdate").cast("date")
        months = rows.withColumn("_month", F.year(date) * 12 + F.month(date))
        part = F.coalesce(F.pmod("_month", F.lit(n)), F.lit(0))  # without a date: in the first
        dealt = [months.filter(part == i).hint("rebalance", F.col("_month")).drop("_month") for i in range(n)]
        yield [relation_of(d, name) for d in dealt]
        release(rows)

    @cached_property
    def rates_raw(self) -> DataFrame:
        if "rates" in self._tables:
            return self._tables["rates"]
        return relation(self.spark, self.sf_dir, "rates")

    @cached_property
    def sold_r(self) -> DataFrame:
        return filter_category(self.sold)

    @cached_property
    def listed_r(self) -> DataFrame:
        return filter_category(self.listed)

    @cached_property
    def rates(self) -> DataFrame:
        return rates_clean(self.rates_raw)

    @cached_property
    def monthly(self) -> DataFrame:
        return rates_monthly(self.rates)

    @cached_property
    def sold_e(self) -> DataFrame:
        return enrich_with_rates(self.sold_r, self.monthly, FD.SOLD_DATE_COLUMN)

    @cached_property
    def listed_e(self) -> DataFrame:
        return enrich_with_rates(self.listed_r, self.monthly, FD.LISTED_DATE_COLUMN)

    @cached_property
    def clean_sold(self) -> Cleaned:
        return clean_sold(self.sold_e)

    @cached_property
    def clean_listed(self) -> Cleaned:
        return clean_listed(self.listed_e)

    def sold_by_source(self) -> DataFrame:
        """Raw sold rows tagged with their monthly source (month of the listing date)."""
        return self.sold.withColumn("source", F.substring("ListingContractDate", 1, 7))

    def listed_by_source(self) -> DataFrame:
        """Raw listed rows tagged with their monthly source (month of the listing date)."""
        return self.listed.withColumn("source", F.substring("ListingContractDate", 1, 7))
