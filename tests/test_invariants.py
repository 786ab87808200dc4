"""Invariants on the derived sf0.001 relations and absent-column behaviour."""

import pytest
from pyspark.sql import functions as F

from homestats.functions import fields as FD
from homestats.operators import calendar as CAL
from homestats.operators import clean as CL
from homestats.operators import distribution as DI
from homestats.operators import market as MK
from homestats.operators import profile as PR
from homestats.operators import rates as RT
from homestats.operators import validate as VA
from homestats.plans.relations import Relations

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def rel(spark):
    return Relations(spark, SF)


def test_left_join_keeps_rows(rel):
    assert rel.sold_e.count() == rel.sold_r.count()
    assert rel.listed_e.count() == rel.listed_r.count()


def test_monthly_counts_sum_to_valid_dates(rel):
    total = rel.sold_r.agg(F.count(F.col("CloseDate").try_cast("date"))).first()[0]
    assert CAL.monthly_counts(rel.sold_r, "CloseDate").agg(F.sum("n")).first()[0] == total


def test_any_flag_dominates_members_and_rows_kept(rel):
    c = rel.clean_sold
    assert c.data.count() == rel.sold_e.count()
    members = c.numeric_flags + c.date_flags
    bad = c.data.where(" OR ".join(f"any_invalid_flag < {m}" for m in members)).count()
    assert bad == 0
    nulls = c.data.where(" OR ".join(f"{m} IS NULL" for m in members + ["any_invalid_flag"])).count()
    assert nulls == 0


def test_histogram_counts_sum_to_non_null(rel):
    h = DI.histogram(rel.sold_r, "OriginalListPrice")
    n = rel.sold_r.agg(F.count(F.col("OriginalListPrice"))).first()[0]
    assert h.agg(F.sum("n")).first()[0] == n


def test_unmatched_plus_matched(rel):
    a = RT.join_audit(rel.sold_r, rel.sold_e).first()
    u = RT.unmatched_keys(rel.sold_e).agg(F.sum("n")).first()[0] or 0
    assert a["null_rates"] == u + a["null_keys"]


def test_absent_columns(spark):
    df = spark.createDataFrame([(1, "x")], "a int, b string")
    assert PR.critical_nulls(df).count() == 0
    assert PR.outlier_counts(df).count() == 0
    assert PR.numeric_stats(df).count() == 0
    assert PR.value_counts(df, "nope").count() == 0
    assert PR.check_category(df).first()["status"] == "FAIL"
    assert MK.date_order_count(df).first()[0] == 0
    flags = CL.add_date_flags(df).select(*[n for n, _a, _b in FD.DATE_ORDER_FLAGS]).first()
    assert list(flags) == [0, 0, 0]
    g = CL.geo_flags(df).first()
    assert g["geo_null_flag"] is None  # coordinates absent -> unknown, not 0
    assert CL.geo_counts(df, "X").first()["null_geo"] == 0
    assert VA.duplicate_check(df).first()["status"] == "SKIPPED"
    out = CL.clean_listed(df)
    assert out.data.count() == 1 and out.data.first()["any_invalid_flag"] == 0


def test_absent_columns_more_operators(spark):
    from homestats.operators import features as FE
    from homestats.sources import tables as TB

    df = spark.range(3).selectExpr("CAST(id AS STRING) AS ListingKey")
    assert CAL.monthly_counts(df, "CloseDate").count() == 0
    cov = CAL.date_coverage(df, "CloseDate").first()
    assert (cov["valid"], cov["invalid"], cov["start_status"]) == (0, 3, "WARNING")
    assert CAL.missing_months(df, "CloseDate", "2024-01", "2024-03").count() == 3
    assert DI.histogram(df, "OriginalListPrice").count() == 0
    assert DI.boxplot_stats(df, ["LivingArea"]).count() == 0
    assert PR.numeric_distribution(df).count() == 0
    assert PR.compact_stats(df.withColumn("source", F.lit("x")), "source").count() == 0
    assert MK.top_groups_by_median(df.withColumn("CountyOrParish", F.lit("A"))).count() == 0
    assert MK.price_vs_list(df).first()["base"] == 0
    v = VA.validate_dataset(df, "CloseDate")
    checks = {r["check"]: r["status"] for r in v.collect()}
    assert checks["category"] == "FAIL" and checks["date_valid"] == "FAIL" and checks["duplicates"] == "PASS"
    feats = FE.features_price(FE.features_time(df)).first()
    assert feats["price_per_sqft"] is None and feats["days_to_contract"] is None
    assert RT.rates_clean(df).count() == 0
    monthly = RT.rates_monthly(RT.rates_clean(df))
    enriched = RT.enrich_with_rates(df, monthly, "CloseDate")
    assert enriched.count() == 3 and enriched.where("rate_30yr_fixed IS NOT NULL").count() == 0
    assert TB.union_by_name([df, df.withColumn("extra", F.lit(1))]).columns == ["ListingKey", "extra"]


def test_numeric_rules_combine_modes_share_log(spark, golden):
    any_log = CL.flag_log(golden, FD.SOLD_FLAG_RULES, "SOLD").collect()
    assert {(r["column"], r["rule"]): r["flagged"] for r in any_log} == {
        ("ClosePrice", "ClosePrice <= 0"): 2, ("ClosePrice", "ClosePrice > $50M"): 1,
        ("ListPrice", "ListPrice <= 0"): 1,
    }
