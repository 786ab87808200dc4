"""Derived features specified for the analysis-ready tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from homestats.functions import fields as FD
from homestats.functions.coerce import as_date, as_number, flag, round4


def features_price(df: DataFrame) -> DataFrame:
    """price_per_sqft, price_ratio, list_price_change (null where a divisor is 0 or missing)."""
    cp, la = as_number(df, "ClosePrice"), as_number(df, "LivingArea")
    olp, lp = as_number(df, "OriginalListPrice"), as_number(df, "ListPrice")
    return df.withColumns({
        "price_per_sqft": round4(F.try_divide(cp, la)),
        "price_ratio": round4(F.try_divide(cp, olp)),
        "list_price_change": round4(F.try_divide(lp - olp, olp)),
    })


def features_time(df: DataFrame) -> DataFrame:
    """days_to_contract = purchase - listing; contract_to_close = close - purchase (days)."""
    ld, pd_, cd = (as_date(df, c) for c in ("ListingContractDate", "PurchaseContractDate", "CloseDate"))
    return df.withColumns({
        "days_to_contract": F.datediff(pd_, ld),
        "contract_to_close": F.datediff(cd, pd_),
    })


def features_calendar(df: DataFrame, date_col: str = "ListingContractDate") -> DataFrame:
    """listing_month, listing_quarter, listing_year of the listing date."""
    d = as_date(df, date_col)
    return df.withColumns({
        "listing_month": F.month(d), "listing_quarter": F.quarter(d), "listing_year": F.year(d),
    })


def geo_bbox(df: DataFrame, lat_range=FD.BBOX_LAT, lon_range=FD.BBOX_LON) -> DataFrame:
    """``geo_outside_bbox_flag``: 1 when a present coordinate pair lies outside the box."""
    lat, lon = as_number(df, "Latitude"), as_number(df, "Longitude")
    inside = lat.between(*lat_range) & lon.between(*lon_range)
    return df.withColumn("geo_outside_bbox_flag", flag(lat.isNotNull() & lon.isNotNull() & ~inside))


def remove_flagged(df: DataFrame, flag_col: str = "any_invalid_flag") -> DataFrame:
    """The hard-removal step: keep rows whose composite flag is 0."""
    return df.where(F.col(flag_col) == 0)
