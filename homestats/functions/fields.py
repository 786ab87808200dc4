"""Declared fields and rules.

Fixed values: these names, thresholds and labels must equal the source
pipeline's for the results to line up. They are the defaults of the
operators' parameters, never hard-wired inside an operator.
"""

from __future__ import annotations

# Category filter.
PROPERTY_TYPE_COLUMN = "PropertyType"
RESIDENTIAL = "Residential"

# Thresholds.
HIGH_NULL_FRACTION = 0.90
CRITICAL_NULL_PCT = 5.0
PRICE_CEILING = 50_000_000
MIN_TRANSACTIONS = 50
TOP_K = 10
HISTOGRAM_BINS = 60
CLIP_QUANTILE = 0.99
BAR_WIDTH = 30

# Key and date columns per dataset.
KEY_COLUMN = "ListingKey"
SOLD_DATE_COLUMN = "CloseDate"
LISTED_DATE_COLUMN = "ListingContractDate"

# Critical fields for the null check.
CRITICAL_FIELDS = [
    "PropertyType", "City", "PostalCode", "CountyOrParish", "UnparsedAddress",
    "ListPrice", "LivingArea", "BedroomsTotal", "BathroomsTotalInteger", "YearBuilt",
]
# Critical fields checked per source file.
FILE_CRITICAL_FIELDS = ["PropertyType", "City", "PostalCode", "CountyOrParish", "UnparsedAddress"]

# Fields of the numeric statistics check.
STATS_FIELDS = [
    "ClosePrice", "ListPrice", "OriginalListPrice", "LivingArea", "DaysOnMarket",
    "BedroomsTotal", "BathroomsTotalInteger", "YearBuilt", "LotSizeSquareFeet", "TaxAnnualAmount",
]
# Fields of the numeric distribution review.
DISTRIBUTION_FIELDS = [
    "ClosePrice", "ListPrice", "OriginalListPrice", "LivingArea", "LotSizeAcres",
    "BedroomsTotal", "BathroomsTotalInteger", "DaysOnMarket", "YearBuilt",
]
# Fields of the per-file compact statistics.
COMPACT_FIELDS = ["ClosePrice", "ListPrice", "OriginalListPrice", "LivingArea", "DaysOnMarket"]

# Outlier rules (field, label, kind, bound); kinds: le, lt, gt.
OUTLIER_RULES = [
    ("ClosePrice", "ClosePrice <= 0", "le", 0),
    ("ClosePrice", "ClosePrice > $50M", "gt", PRICE_CEILING),
    ("ListPrice", "ListPrice <= 0", "le", 0),
    ("ListPrice", "ListPrice > $50M", "gt", PRICE_CEILING),
    ("OriginalListPrice", "OriginalListPrice <= 0", "le", 0),
    ("OriginalListPrice", "OriginalListPrice > $50M", "gt", PRICE_CEILING),
    ("DaysOnMarket", "DaysOnMarket < 0", "lt", 0),
    ("LivingArea", "LivingArea <= 0", "le", 0),
]

# Fixed value: the files of an export folder, plain or gzipped.
CSV_FILES = "*.{csv,csv.gz}"

# Numeric cleaning rules per dataset (column, label, kind, bound).
SOLD_FLAG_RULES = [
    ("ClosePrice", "ClosePrice <= 0", "le", 0),
    ("ClosePrice", "ClosePrice > $50M", "gt", PRICE_CEILING),
    ("ListPrice", "ListPrice <= 0", "le", 0),
    ("OriginalListPrice", "OriginalListPrice <= 0", "le", 0),
    ("OriginalListPrice", "OriginalListPrice > $50M", "gt", PRICE_CEILING),
    ("LivingArea", "LivingArea <= 0", "le", 0),
    ("DaysOnMarket", "DaysOnMarket < 0", "lt", 0),
]
LISTED_FLAG_RULES = [
    ("ListPrice", "ListPrice <= 0", "le", 0),
    ("ListPrice", "ListPrice > $50M", "gt", PRICE_CEILING),
    ("LivingArea", "LivingArea <= 0", "le", 0),
]

# Date fields parsed by the cleaning step.
SOLD_DATE_FIELDS = ["ListingContractDate", "CloseDate", "StatusChangeTimestamp", "ModificationTimestamp"]
LISTED_DATE_FIELDS = ["ListingContractDate", "ExpirationDate", "StatusChangeTimestamp", "ModificationTimestamp"]
# Fields holding a time of day (parsed as timestamps, the rest as dates).
TIMESTAMP_FIELDS = ["StatusChangeTimestamp", "ModificationTimestamp"]

# Date-order flags (name, earlier column, later column).
DATE_ORDER_FLAGS = [
    ("listing_after_close_flag", "ListingContractDate", "CloseDate"),
    ("purchase_after_close_flag", "PurchaseContractDate", "CloseDate"),
    ("negative_timeline_flag", "ListingContractDate", "PurchaseContractDate"),
]

DATE_ORDER_FLAG_NAMES = [name for name, _a, _b in DATE_ORDER_FLAGS]

# Location columns audited for nulls.
GEO_AUDIT_FIELDS = [
    "Latitude", "Longitude", "latfilled", "lonfilled",
    "PostalCode", "City", "CountyOrParish", "StateOrProvince",
]
# Location columns of the coverage table and its status bands.
GEO_COVERAGE_FIELDS = ["Latitude", "Longitude", "PostalCode", "City", "CountyOrParish", "StateOrProvince"]
COVERAGE_GOOD_PCT = 5.0
COVERAGE_PARTIAL_PCT = 20.0

# Bounding box of the market area (lat, lon).
BBOX_LAT = (32.0, 42.0)
BBOX_LON = (-125.0, -114.0)

# Rate series columns.
RATE_DATE_SOURCE = "observation_date"
RATE_VALUE_SOURCE = "MORTGAGE30US"
RATE_COLUMN = "rate_30yr_fixed"
MONTH_COLUMN = "year_month"

# File classification by name substring.
SOURCE_CLASSES = [("Sold", "Sold"), ("Listing", "Listing")]

# Text tokens read as missing in CSV exports.
NULL_TOKENS = ["", "NA", "N/A", "NULL", "null", "None", "n/a", "nan", "NaN", "#N/A", "<NA>"]
