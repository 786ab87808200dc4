"""Small text helpers for writing the DuckDB oracle SQL (dialect crib)."""

from __future__ import annotations

from homestats.sources.testrel import oracle_cte

# Column lists of the derived relations (their schema is fixed by the derivation SQL).
SOLD_COLUMNS = [
    "ListingKey", "PropertyType", "PropertySubType", "City", "CountyOrParish", "PostalCode",
    "StateOrProvince", "UnparsedAddress", "ClosePrice", "ListPrice", "OriginalListPrice", "LivingArea",
    "LotSizeAcres", "BedroomsTotal", "BathroomsTotalInteger", "YearBuilt", "DaysOnMarket",
    "ListingContractDate", "PurchaseContractDate", "CloseDate", "StatusChangeTimestamp",
    "ModificationTimestamp", "Latitude", "Longitude", "TaxYear", "FireplacesTotal", "BusinessType",
]
LISTED_COLUMNS = [
    "ListingKey", "PropertyType", "CountyOrParish", "City", "ListPrice", "LivingArea",
    "ListingContractDate", "ExpirationDate", "Latitude", "Longitude", "CoveredSpaces",
]


def N(c: str) -> str:
    return f"TRY_CAST({c} AS DOUBLE)"


def D(c: str) -> str:
    return f"TRY_CAST({c} AS DATE)"


def TS(c: str) -> str:
    return f"TRY_CAST({c} AS TIMESTAMP)"


def RND(x: str, d: int) -> str:
    """numpy-style rounding: scale, round half-even, unscale (matches ``round_half_even``)."""
    scale = f"{float(10 ** d)!r}E0" if "e" not in repr(float(10 ** d)) else repr(float(10 ** d))
    return f"(round_even(CAST({x} AS DOUBLE) * {scale}, 0) / {scale} + 0.0E0)"


def R4(x: str) -> str:
    return RND(x, 4)


def PCT(a: str, b: str, d: int = 4) -> str:
    return RND(f"CAST({a} AS DOUBLE) * 100.0E0 / CAST({b} AS DOUBLE)", d)


def FLAG(p: str) -> str:
    return f"CAST(COALESCE({p}, false) AS INTEGER)"


def YM(d: str) -> str:
    return f"strftime({d}, '%Y-%m')"


def DSTR(d: str) -> str:
    return f"CAST({d} AS VARCHAR)"


def TSTR(t: str) -> str:
    return f"strftime({t}, '%Y-%m-%d %H:%M:%S')"


# Shared CTEs: the three relations, the Residential subsets, the rate series,
# the enriched tables and the cleaned tables.
_SOLD_CLEAN_COLS = [c for c in SOLD_COLUMNS if c not in ("TaxYear", "BusinessType")] + ["year_month", "rate_30yr_fixed"]
_LISTED_CLEAN_COLS = [c for c in LISTED_COLUMNS if c != "CoveredSpaces"] + ["year_month", "rate_30yr_fixed"]

_SOLD_DATE = {"ListingContractDate": D, "CloseDate": D, "StatusChangeTimestamp": TS, "ModificationTimestamp": TS}
_LISTED_DATE = {"ListingContractDate": D, "ExpirationDate": D, "StatusChangeTimestamp": TS, "ModificationTimestamp": TS}


def _parsed(cols, parsers):
    return ", ".join(f"{parsers[c](c)} AS {c}" if c in parsers else c for c in cols)


SOLD_FLAGS_SQL = {
    "listing_after_close_flag": FLAG(f"{D('ListingContractDate')} > {D('CloseDate')}"),
    "purchase_after_close_flag": FLAG(f"{D('PurchaseContractDate')} > {D('CloseDate')}"),
    "negative_timeline_flag": FLAG(f"{D('ListingContractDate')} > {D('PurchaseContractDate')}"),
    "ClosePrice_invalid_flag": FLAG(f"{N('ClosePrice')} <= 0 OR {N('ClosePrice')} > 50000000"),
    "ListPrice_invalid_flag": FLAG(f"{N('ListPrice')} <= 0"),
    "OriginalListPrice_invalid_flag": FLAG(f"{N('OriginalListPrice')} <= 0 OR {N('OriginalListPrice')} > 50000000"),
    "LivingArea_invalid_flag": FLAG(f"{N('LivingArea')} <= 0"),
    "DaysOnMarket_invalid_flag": FLAG(f"{N('DaysOnMarket')} < 0"),
}
SOLD_FLAGS_LAST_SQL = {
    **SOLD_FLAGS_SQL,
    "ClosePrice_invalid_flag": FLAG(f"{N('ClosePrice')} > 50000000"),
    "OriginalListPrice_invalid_flag": FLAG(f"{N('OriginalListPrice')} > 50000000"),
}
LISTED_FLAGS_SQL = {
    "ListPrice_invalid_flag": FLAG(f"{N('ListPrice')} <= 0 OR {N('ListPrice')} > 50000000"),
    "LivingArea_invalid_flag": FLAG(f"{N('LivingArea')} <= 0"),
}
GEO_FLAGS_SQL = {
    "geo_null_flag": FLAG(f"{N('Latitude')} IS NULL OR {N('Longitude')} IS NULL"),
    "geo_sentinel_flag": FLAG(f"{N('Latitude')} = 0 OR {N('Longitude')} = 0"),
    "geo_invalid_flag": FLAG(f"{N('Longitude')} > 0"),
}


def _flags(d: dict) -> str:
    return ", ".join(f"{v} AS {k}" for k, v in d.items())


def _greatest(d: dict) -> str:
    return "GREATEST(" + ", ".join(d.values()) + ")"


BASE = oracle_cte("sold", "listed", "rates") + f""",
sold_r AS (SELECT * FROM sold WHERE PropertyType = 'Residential'),
listed_r AS (SELECT * FROM listed WHERE PropertyType = 'Residential'),
rates_c AS (SELECT {D('observation_date')} AS date, {N('MORTGAGE30US')} AS rate_30yr_fixed FROM rates
            WHERE {N('MORTGAGE30US')} IS NOT NULL),
monthly AS (SELECT {YM('date')} AS year_month, {R4('avg(rate_30yr_fixed)')} AS rate_30yr_fixed
            FROM rates_c WHERE date IS NOT NULL GROUP BY 1),
sold_e AS (SELECT s.*, m.rate_30yr_fixed FROM (SELECT *, {YM(D('CloseDate'))} AS year_month FROM sold_r) s
           LEFT JOIN monthly m ON s.year_month = m.year_month),
listed_e AS (SELECT s.*, m.rate_30yr_fixed FROM (SELECT *, {YM(D('ListingContractDate'))} AS year_month FROM listed_r) s
             LEFT JOIN monthly m ON s.year_month = m.year_month),
sold_f AS (SELECT *, {_flags(SOLD_FLAGS_SQL)}, {_greatest(SOLD_FLAGS_SQL)} AS any_invalid_flag,
                  {_flags(GEO_FLAGS_SQL)} FROM sold_e),
listed_f AS (SELECT *, {_flags(LISTED_FLAGS_SQL)}, {_greatest(LISTED_FLAGS_SQL)} AS any_invalid_flag,
                    {_flags(GEO_FLAGS_SQL)} FROM listed_e),
clean_s AS (SELECT {_parsed(_SOLD_CLEAN_COLS, _SOLD_DATE)}, {', '.join(SOLD_FLAGS_SQL)}, any_invalid_flag,
                   {', '.join(GEO_FLAGS_SQL)} FROM sold_f),
clean_l AS (SELECT {_parsed(_LISTED_CLEAN_COLS, _LISTED_DATE)}, {', '.join(LISTED_FLAGS_SQL)}, any_invalid_flag,
                   {', '.join(GEO_FLAGS_SQL)} FROM listed_f)
"""


def sql(body: str) -> str:
    """A complete oracle statement: shared CTEs + ``body``."""
    return BASE + body


def null_counts_sql(table: str, cols: list[str]) -> str:
    """``(column_name, position, null_count, rows)`` rows for ``cols`` of ``table``."""
    parts = [
        f"SELECT '{c}' AS column_name, {i} AS position, count(*) - count({c}) AS null_count, count(*) AS rows FROM {table}"
        for i, c in enumerate(cols)
    ]
    return "\nUNION ALL ".join(parts)
