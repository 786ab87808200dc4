"""Golden 10-row table: flags and statistics computed by hand from the source formulas."""

import pytest

from homestats.functions import fields as FD
from homestats.operators import calendar as CAL
from homestats.operators import clean as CL
from homestats.operators import market as MK
from homestats.operators import profile as PR
from homestats.operators import validate as VA


def col(df, name):
    return [r[name] for r in df.orderBy("rid").collect()]


def test_date_flags(golden):
    out = CL.add_date_flags(golden)
    assert col(out, "listing_after_close_flag") == [0, 1, 0, 0, 0, 0, 0, 0, 0, 0]
    assert col(out, "purchase_after_close_flag") == [0, 1, 1, 0, 0, 0, 0, 0, 0, 0]
    assert col(out, "negative_timeline_flag") == [0, 0, 0, 0, 0, 1, 0, 0, 0, 0]


def test_numeric_flags_any_and_last(golden):
    anyf = CL.flag_invalid(golden, FD.SOLD_FLAG_RULES, "any")
    last = CL.flag_invalid(golden, FD.SOLD_FLAG_RULES, "last")
    assert col(anyf, "ClosePrice_invalid_flag") == [0, 1, 1, 0, 0, 0, 0, 1, 0, 0]
    assert col(last, "ClosePrice_invalid_flag") == [0, 0, 1, 0, 0, 0, 0, 0, 0, 0]
    assert col(anyf, "ListPrice_invalid_flag") == [0, 0, 0, 0, 0, 0, 1, 0, 0, 0]
    # absent columns add no flag
    assert "LivingArea_invalid_flag" not in anyf.columns


def test_any_flag_and_geo(golden):
    data = CL.clean_sold(golden).data
    assert col(data, "any_invalid_flag") == [0, 1, 1, 0, 0, 1, 1, 1, 0, 0]
    assert col(data, "geo_null_flag") == [0, 0, 0, 1, 1, 0, 0, 0, 0, 0]
    assert col(data, "geo_sentinel_flag") == [0, 1, 0, 0, 0, 0, 0, 0, 0, 0]
    assert col(data, "geo_invalid_flag") == [0, 0, 1, 0, 0, 0, 0, 0, 0, 0]
    assert data.count() == 10  # cleaning never removes rows


def test_close_price_stats(golden):
    d = PR.numeric_distribution(golden, ["ClosePrice"]).first()
    assert d["count"] == 8 and d["null"] == 2
    assert d["min"] == -1 and d["max"] == 60000000
    assert d["p5"] == pytest.approx(-0.65)
    assert d["p25"] == 75 and d["median"] == 175 and d["p75"] == 325
    assert d["p95"] == pytest.approx(39000140)
    assert d["mean"] == pytest.approx(7500143.625)
    assert d["std"] == pytest.approx(21213145.4028, abs=1e-4)


def test_price_vs_list(golden):
    r = MK.price_vs_list(golden).first()
    assert (r["above"], r["at_list"], r["below"], r["base"]) == (2, 2, 2, 6)


def test_duplicates(golden):
    r = VA.duplicate_check(golden).first()
    assert (r["total"], r["unique"], r["duplicates"], r["null_keys"]) == (10, 7, 3, 2)
    assert r["status"] == "WARNING"


def test_county_medians(golden):
    out = MK.top_groups_by_median(golden, min_n=1, k=10)
    got = {r["CountyOrParish"]: (r["median_price"], r["transactions"]) for r in out.collect()}
    assert got == {"A": (100.0, 3), "B": (175.0, 2), "C": (199.5, 2)}
    assert [r["CountyOrParish"] for r in out.collect()] == ["C", "B", "A"]


def test_monthly_counts_and_gaps(golden):
    m = {r["year_month"]: r["n"] for r in CAL.monthly_counts(golden, "CloseDate").collect()}
    assert m == {"2024-01": 1, "2024-02": 2, "2024-03": 2, "2024-04": 2, "2024-05": 1, "2024-07": 1}
    gaps = [r["year_month"] for r in CAL.missing_months(golden, "CloseDate", "2024-01", "2024-07").collect()]
    assert gaps == ["2024-06"]
    s = CAL.monthly_summary(CAL.monthly_counts(golden, "CloseDate")).first()
    assert (s["total"], s["min_n"], s["min_month"], s["max_n"], s["max_month"]) == (9, 1, "2024-01", 2, "2024-02")
