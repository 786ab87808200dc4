"""Registered queries: name -> (spark, sf_dir) -> DataFrame, with DuckDB oracle SQL.

Each query starts from the derived relations (``Relations``) and calls one
operator. Date and timestamp outputs are rendered as text so both engines
report them identically; measures are rounded in both the same way.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from homestats.functions import fields as FD
from homestats.functions.coerce import as_date, as_number, as_timestamp
from homestats.operators import calendar as CAL
from homestats.operators import clean as CL
from homestats.operators import distribution as DI
from homestats.operators import features as FE
from homestats.operators import market as MK
from homestats.operators import profile as PR
from homestats.operators import rates as RT
from homestats.operators import report as RP
from homestats.operators import validate as VA
from homestats.plans.relations import Relations
from homestats.session import stored
from homestats.plans.sqlkit import (
    BASE, D, DSTR, FLAG, GEO_FLAGS_SQL, LISTED_COLUMNS, LISTED_FLAGS_SQL, N, PCT, R4, SOLD_COLUMNS,
    SOLD_FLAGS_LAST_SQL, SOLD_FLAGS_SQL, TS, TSTR, YM, null_counts_sql, sql,
)

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}
# The query bodies, taking a ``Relations`` (lets the benchmark run them on materialised tables).
BODIES: dict[str, Callable[[Relations], DataFrame]] = {}


def as_text_dates(df: DataFrame) -> DataFrame:
    """Render DATE as ``yyyy-MM-dd`` and TIMESTAMP as ``yyyy-MM-dd HH:mm:ss`` text."""
    conv = {}
    for f in df.schema.fields:
        if isinstance(f.dataType, T.DateType):
            conv[f.name] = F.date_format(F.col(f"`{f.name}`"), "yyyy-MM-dd")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            conv[f.name] = F.date_format(F.col(f"`{f.name}`"), "yyyy-MM-dd HH:mm:ss")
    return df.withColumns(conv) if conv else df


def register(name: str, oracle: str | None = None):
    def deco(fn: Callable[[Relations], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return as_text_dates(fn(Relations(spark, sf_dir)))

        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        BODIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return deco


# ---------------------------------------------------------------- market (flagship)

@register("top_counties_by_price", sql(f"""
SELECT CountyOrParish, {R4(f"quantile_cont({N('ClosePrice')}, 0.5)")} AS median_price,
       count({N('ClosePrice')}) AS transactions
FROM sold_r WHERE CountyOrParish IS NOT NULL GROUP BY CountyOrParish
HAVING count({N('ClosePrice')}) >= 50 ORDER BY median_price DESC, CountyOrParish LIMIT 10"""))
def q_top_counties(r: Relations) -> DataFrame:
    """Top 10 counties by median close price with at least 50 priced sales."""
    return MK.top_groups_by_median(r.sold_r)


@register("close_price_summary", sql(f"""
SELECT count({N('ClosePrice')}) AS n, {R4(f"avg({N('ClosePrice')})")} AS mean_price,
       {R4(f"quantile_cont({N('ClosePrice')}, 0.5)")} AS median_price FROM sold_r"""))
def q_close_price_summary(r):
    return MK.close_price_summary(r.sold_r)


@register("dom_summary", sql(f"""
SELECT count({N('DaysOnMarket')}) AS n, {R4(f"avg({N('DaysOnMarket')})")} AS mean_days,
       max({N('DaysOnMarket')}) AS max_days,
       {R4(f"quantile_cont({N('DaysOnMarket')}, 0.5)")} AS median_days,
       {R4(f"quantile_cont({N('DaysOnMarket')}, 0.75)")} AS p75_days,
       {R4(f"quantile_cont({N('DaysOnMarket')}, 0.9)")} AS p90_days FROM sold_r"""))
def q_dom_summary(r):
    return MK.dom_summary(r.sold_r)


_CP, _LP = N("ClosePrice"), N("ListPrice")
_BOTH = f"({_CP} IS NOT NULL AND {_LP} IS NOT NULL AND {_LP} > 0)"


@register("price_vs_list", sql(f"""
SELECT above, at_list, below, base, {PCT('above', 'base')} AS pct_above, {PCT('at_list', 'base')} AS pct_at,
       {PCT('below', 'base')} AS pct_below
FROM (SELECT count(*) FILTER (WHERE {_BOTH} AND {_CP} > {_LP}) AS above,
             count(*) FILTER (WHERE {_BOTH} AND {_CP} = {_LP}) AS at_list,
             count(*) FILTER (WHERE {_BOTH} AND {_CP} < {_LP}) AS below,
             count(*) FILTER (WHERE {_BOTH}) AS base FROM sold_r) t"""))
def q_price_vs_list(r):
    return MK.price_vs_list(r.sold_r)


@register("date_order_count", sql(f"""
SELECT CAST(sum({FLAG(f"{D('ListingContractDate')} > {D('CloseDate')}")}) AS BIGINT) AS n_violations FROM sold_r"""))
def q_date_order_count(r):
    return MK.date_order_count(r.sold_r)


# ---------------------------------------------------------------- categories

@register("residential_filter", sql("""
SELECT ListingKey, PropertyType, City, ClosePrice, CloseDate FROM sold_r"""))
def q_residential_filter(r):
    return PR.filter_category(r.sold).select("ListingKey", "PropertyType", "City", "ClosePrice", "CloseDate")


@register("filter_audit", sql("""
SELECT 'SOLD' AS dataset, count(*) AS rows_before, count(*) FILTER (WHERE PropertyType = 'Residential') AS rows_after,
       count(*) - count(*) FILTER (WHERE PropertyType = 'Residential') AS rows_dropped FROM sold
UNION ALL
SELECT 'LISTED', count(*), count(*) FILTER (WHERE PropertyType = 'Residential'),
       count(*) - count(*) FILTER (WHERE PropertyType = 'Residential') FROM listed"""))
def q_filter_audit(r):
    return PR.filter_audit(r.sold).select(F.lit("SOLD").alias("dataset"), "*").unionByName(
        PR.filter_audit(r.listed).select(F.lit("LISTED").alias("dataset"), "*"))


def _vc_sql(table: str, col: str, dropna: bool = True, limit: int | None = None) -> str:
    where = f"WHERE {col} IS NOT NULL" if dropna else ""
    tail = f"ORDER BY n DESC, value LIMIT {limit}" if limit else ""
    return sql(f"""
SELECT {col} AS value, count(*) AS n, {PCT('count(*)', f'(SELECT count(*) FROM {table})')} AS pct
FROM {table} {where} GROUP BY {col} {tail}""")


@register("property_type_counts", _vc_sql("sold", "PropertyType"))
def q_property_type_counts(r):
    return PR.value_counts(r.sold, "PropertyType")


@register("property_type_counts_all", _vc_sql("sold", "PropertyType", dropna=False))
def q_property_type_counts_all(r):
    return PR.value_counts(r.sold, "PropertyType", dropna=False)


@register("subtype_counts", _vc_sql("sold_r", "PropertySubType"))
def q_subtype_counts(r):
    return PR.value_counts(r.sold_r, "PropertySubType")


@register("top_cities", _vc_sql("sold_r", "City", limit=10))
def q_top_cities(r):
    return PR.top_k(r.sold_r, "City")


@register("top_counties", _vc_sql("sold_r", "CountyOrParish", limit=10))
def q_top_counties_volume(r):
    return PR.top_k(r.sold_r, "CountyOrParish")


@register("check_category", sql("""
SELECT PropertyType AS value, count(*) AS n,
       CASE WHEN (SELECT count(*) FILTER (WHERE PropertyType IS NOT DISTINCT FROM 'Residential') = count(*) FROM sold)
            THEN 'PASS' ELSE 'FAIL' END AS status
FROM sold GROUP BY PropertyType"""))
def q_check_category(r):
    return PR.check_category(r.sold)


# ---------------------------------------------------------------- nulls

_NP = f"np AS ({null_counts_sql('sold_r', SOLD_COLUMNS)})\n"


@register("null_profile", sql(f""", {_NP}
SELECT column_name, position, null_count, {PCT('null_count', 'rows', 2)} AS null_pct,
       CAST(null_count AS DOUBLE) / rows > 0.9 AS drop_candidate FROM np""").replace("\n, np AS", ",\nnp AS"))
def q_null_profile(r):
    return PR.null_profile(r.sold_r)


@register("high_null_columns", sql(f""", {_NP}
SELECT column_name, null_count, {PCT('null_count', 'rows', 2)} AS null_pct FROM np
WHERE CAST(null_count AS DOUBLE) / rows > 0.9""").replace("\n, np AS", ",\nnp AS"))
def q_high_null_columns(r):
    return PR.high_null_columns(r.sold_r)


@register("complete_columns", sql(f""", {_NP}
SELECT count(*) FILTER (WHERE null_count = 0) AS complete_columns, count(*) AS total_columns FROM np""").replace(
    "\n, np AS", ",\nnp AS"))
def q_complete_columns(r):
    return PR.complete_columns(r.sold_r)


def _critical_sql(table: str, cols: list[str]) -> str:
    present = [c for c in FD.CRITICAL_FIELDS if c in cols]
    body = "\nUNION ALL ".join(
        f"SELECT '{c}' AS field, count(*) - count({c}) AS null_count, count(*) AS rows FROM {table}" for c in present)
    return f"""
SELECT field, null_count, {PCT('null_count', 'rows', 4)} AS null_pct,
       CASE WHEN CAST(null_count AS DOUBLE) * 100.0E0 / rows < 5.0 THEN 'PASS' ELSE 'WARNING' END AS status
FROM ({body}) t"""


@register("critical_nulls", sql(_critical_sql("sold_r", SOLD_COLUMNS)))
def q_critical_nulls(r):
    return PR.critical_nulls(r.sold_r)


# ---------------------------------------------------------------- numeric profiles

def _long_sql(table: str, fields: list[str], cols: list[str], extra: str = "") -> str:
    present = [f for f in fields if f in cols]
    return "\nUNION ALL ".join(f"SELECT {extra}'{f}' AS field, {N(f)} AS v FROM {table}" for f in present)


def _stats_sql(table, fields, cols, qs: dict[str, float], with_null: bool) -> str:
    qcols = ", ".join(f"{R4(f'quantile_cont(v, {p})')} AS {n}" for n, p in qs.items())
    null = ", count(*) - count(v) AS \"null\"" if with_null else ""
    return f"""
SELECT field, count(v) AS count, min(v) AS min, max(v) AS max, {R4('avg(v)')} AS mean,
       {R4('stddev_samp(v)')} AS std {null}, {qcols}
FROM ({_long_sql(table, fields, cols)}) t GROUP BY field HAVING count(v) > 0"""


@register("numeric_stats", sql(_stats_sql("sold_r", FD.STATS_FIELDS, SOLD_COLUMNS,
                                          {"p25": 0.25, "median": 0.5, "p75": 0.75}, False)))
def q_numeric_stats(r):
    return PR.numeric_stats(r.sold_r)


@register("numeric_distribution", sql(_stats_sql(
    "sold_r", FD.DISTRIBUTION_FIELDS, SOLD_COLUMNS,
    {"p5": 0.05, "p25": 0.25, "median": 0.5, "p75": 0.75, "p95": 0.95}, True)))
def q_numeric_distribution(r):
    return PR.numeric_distribution(r.sold_r)


@register("compact_stats", sql(f"""
SELECT source, field, min(v) AS min, {R4('quantile_cont(v, 0.5)')} AS median, max(v) AS max,
       count(*) - count(v) AS nulls
FROM ({_long_sql("(SELECT *, substr(ListingContractDate, 1, 7) AS source FROM sold)", FD.COMPACT_FIELDS, SOLD_COLUMNS,
                 extra="source, ")}) t
GROUP BY source, field HAVING count(v) > 0"""))
def q_compact_stats(r):
    return PR.compact_stats(r.sold_by_source(), "source")


def _rule_sql(kind: str, bound) -> str:
    return {"le": "<=", "lt": "<", "gt": ">", "ge": ">="}[kind] + f" {bound}"


@register("outlier_counts", sql("\nUNION ALL ".join(
    f"SELECT '{f}' AS field, '{label}' AS rule, count(*) FILTER (WHERE {N(f)} {_rule_sql(k, b)}) AS n FROM sold_r"
    for f, label, k, b in FD.OUTLIER_RULES if f in SOLD_COLUMNS)))
def q_outlier_counts(r):
    return PR.outlier_counts(r.sold_r)


# ---------------------------------------------------------------- calendar

_MC = f"""mc AS (SELECT {YM(D('CloseDate'))} AS year_month, count(*) AS n FROM sold_r
       WHERE {D('CloseDate')} IS NOT NULL GROUP BY 1)
"""


def _with(extra: str, body: str) -> str:
    return BASE + ", " + extra + body


@register("monthly_counts", _with(_MC, """
SELECT year_month, n, CAST(floor(n / (SELECT max(n) FROM mc) * 30) AS INTEGER) AS bar FROM mc"""))
def q_monthly_counts(r):
    return CAL.monthly_counts(r.sold_r, "CloseDate")


@register("monthly_summary", _with(_MC, f"""
SELECT CAST(sum(n) AS BIGINT) AS total, count(*) AS months, {R4('avg(n)')} AS mean, min(n) AS min_n,
       (SELECT year_month FROM mc ORDER BY n, year_month LIMIT 1) AS min_month, max(n) AS max_n,
       (SELECT year_month FROM mc ORDER BY n DESC, year_month LIMIT 1) AS max_month FROM mc"""))
def q_monthly_summary(r):
    return CAL.monthly_summary(CAL.monthly_counts(r.sold_r, "CloseDate"))


@register("month_key", sql(f"""
SELECT {YM(D('CloseDate'))} AS year_month, count(*) AS n FROM sold_r GROUP BY 1"""))
def q_month_key(r):
    return CAL.month_key_counts(r.sold_r, "CloseDate")


@register("date_coverage", sql(f"""
SELECT count(d) AS valid, count(*) - count(d) AS invalid, {DSTR('min(d)')} AS earliest, {DSTR('max(d)')} AS latest,
       CASE WHEN year(min(d)) = 2024 AND month(min(d)) = 1 THEN 'PASS' ELSE 'WARNING' END AS start_status,
       CASE WHEN year(max(d)) = 2026 AND month(max(d)) >= 2 THEN 'PASS' ELSE 'WARNING' END AS end_status
FROM (SELECT {D('CloseDate')} AS d FROM sold_r) t"""))
def q_date_coverage(r):
    return CAL.date_coverage(r.sold_r, "CloseDate")


@register("missing_months", sql(f"""
SELECT {YM('m')} AS year_month FROM (SELECT unnest(generate_series(DATE '1994-11-01', DATE '2001-11-01', INTERVAL 1 MONTH)) AS m) g
WHERE {YM('m')} NOT IN (SELECT {YM(D('CloseDate'))} FROM sold_r WHERE {D('CloseDate')} IS NOT NULL)"""))
def q_missing_months(r):
    return CAL.missing_months(r.sold_r, "CloseDate", "1994-11", "2001-11")


# ---------------------------------------------------------------- validation

@register("duplicate_keys", sql("""
SELECT count(*) AS total, count(DISTINCT ListingKey) AS "unique", count(*) - count(DISTINCT ListingKey) AS duplicates,
       count(*) FILTER (WHERE ListingKey IS NULL) AS null_keys,
       CASE WHEN count(*) = count(DISTINCT ListingKey) THEN 'PASS' ELSE 'WARNING' END AS status FROM sold_r"""))
def q_duplicate_keys(r):
    return VA.duplicate_check(r.sold_r)


# What the validation checks, with its limits, as the check list states them.
_CHECKED_CRITICAL = ["PropertyType", "City", "PostalCode", "CountyOrParish", "UnparsedAddress", "ListPrice", "LivingArea",
                     "BedroomsTotal", "BathroomsTotalInteger", "YearBuilt"]
_CHECKED_NUMBERS = ["ClosePrice", "ListPrice", "OriginalListPrice", "LivingArea", "DaysOnMarket", "BedroomsTotal",
                    "BathroomsTotalInteger", "YearBuilt", "LotSizeSquareFeet", "TaxAnnualAmount"]
_CHECKED_OUTLIERS = [
    ("ClosePrice", "ClosePrice <= 0", "<= 0"), ("ClosePrice", "ClosePrice > $50M", "> 50000000"), ("ListPrice", "ListPrice <= 0", "<= 0"),
    ("ListPrice", "ListPrice > $50M", "> 50000000"), ("OriginalListPrice", "OriginalListPrice <= 0", "<= 0"),
    ("OriginalListPrice", "OriginalListPrice > $50M", "> 50000000"), ("DaysOnMarket", "DaysOnMarket < 0", "< 0"), ("LivingArea", "LivingArea <= 0", "<= 0"),
]


def _validate_sql(table: str, cols: list[str], date_col: str) -> str:
    """All nine checks (the first, of files, apart) as ``check, field, status, value, detail``."""
    d = D(date_col)
    nulls = null_counts_sql(table, cols)
    rows: list[str] = []

    def add(check: str, field: str | None, status: str, value: str, detail: str = "NULL", source: str = table) -> None:
        name = "NULL" if field is None else f"'{field}'"
        rows.append(f"SELECT '{check}' AS \"check\", CAST({name} AS VARCHAR) AS field, {status} AS status, "
                    f"CAST({value} AS DOUBLE) AS value, CAST({detail} AS VARCHAR) AS detail FROM {source}")

    def when(condition: str, bad: str = "WARNING") -> str:
        return f"CASE WHEN {condition} THEN 'PASS' ELSE '{bad}' END"

    other = "count(*) FILTER (WHERE PropertyType IS DISTINCT FROM 'Residential')"
    add("rows", None, "'INFO'", "count(*)")
    add("columns", None, "'INFO'", str(len(cols)), source="(SELECT 1) x")
    add("category", "PropertyType", when(f"{other} = 0", "FAIL"), other)
    add("date_valid", date_col, "'INFO'", f"count({d})")
    add("date_invalid", date_col, "'INFO'", f"count(*) - count({d})")
    add("date_start", date_col, when(f"year(min({d})) = 2024 AND month(min({d})) = 1"), f"year(min({d})) * 100 + month(min({d}))", f"min({d})")
    add("date_end", date_col, when(f"year(max({d})) = 2026 AND month(max({d})) >= 2"), f"year(max({d})) * 100 + month(max({d}))", f"max({d})")
    gaps = f"""(SELECT unnest(generate_series(DATE '2024-01-01', DATE '2026-03-01', INTERVAL 1 MONTH)) AS m) g
  WHERE {YM('m')} NOT IN (SELECT {YM(d)} FROM {table} WHERE {d} IS NOT NULL)"""
    add("missing_months", date_col, when("count(*) = 0"), "count(*)", source=gaps)
    add("duplicates", "ListingKey", when("count(*) = count(DISTINCT ListingKey)"), "count(*) - count(DISTINCT ListingKey)")
    months = f"(SELECT {YM(d)} AS ym, count(*) AS n FROM {table} WHERE {d} IS NOT NULL GROUP BY 1)"
    add("month_rows", date_col, "'INFO'", "n", "ym", f"{months} m")
    add("month_total", date_col, "'INFO'", "sum(n)", source=f"{months} m")
    add("month_mean", date_col, "'INFO'", R4("avg(n)"), source=f"{months} m")
    for check, order in (("month_min", "n"), ("month_max", "n DESC")):
        add(check, date_col, "'INFO'", "n", "ym", f"(SELECT * FROM {months} m ORDER BY {order}, ym LIMIT 1) o")
    add("high_null_columns", None, "'INFO'", "count(*) FILTER (WHERE CAST(null_count AS DOUBLE) / rows > 0.9)", source=f"({nulls}) np")
    add("complete_columns", None, "'INFO'", "count(*) FILTER (WHERE null_count = 0)", source=f"({nulls}) np")
    for c in _CHECKED_CRITICAL:
        if c in cols:
            missing = f"count(*) - count({c})"
            add("critical_null", c, when(f"CAST({missing} AS DOUBLE) * 100.0E0 / count(*) < 5.0"), PCT(missing, "count(*)"), missing)
    for f in _CHECKED_NUMBERS:
        if f in cols:
            v = f"(SELECT {N(f)} AS v FROM {table}) t HAVING count(v) > 0"
            for stat, value in (
                ("count", "count(v)"), ("min", "min(v)"), ("p25", R4("quantile_cont(v, 0.25)")), ("median", R4("quantile_cont(v, 0.5)")),
                ("p75", R4("quantile_cont(v, 0.75)")), ("max", "max(v)"), ("mean", R4("avg(v)")), ("std", R4("stddev_samp(v)")),
            ):
                add(f"numeric_{stat}", f, "'INFO'", value, source=v)
    for f, label, test in _CHECKED_OUTLIERS:
        if f in cols:
            hit = f"count(*) FILTER (WHERE {N(f)} {test})"
            add("outlier", label, when(f"{hit} = 0"), hit)
    for check, c, limit in (("subtype", "PropertySubType", ""), ("top", "City", "LIMIT 10"), ("top", "CountyOrParish", "LIMIT 10")):
        if c in cols:
            counts = f"(SELECT {c} AS value, count(*) AS n FROM {table} WHERE {c} IS NOT NULL GROUP BY 1 ORDER BY n DESC, value {limit}) c"
            add(check, c, "'INFO'", "n", "value", counts)
            add(f"{check}_pct", c, "'INFO'", PCT("n", f"(SELECT count(*) FROM {table})"), "value", counts)
    return "\nUNION ALL ".join(f"SELECT * FROM ({r}) r{i}" for i, r in enumerate(rows))


@register("validate_sold", sql(_validate_sql("sold_r", SOLD_COLUMNS, "CloseDate")))
def q_validate_sold(r):
    return VA.validate_dataset(VA.stored_input(r.sold_r, "CloseDate"), "CloseDate")


@register("validate_listed", sql(_validate_sql("listed_r", LISTED_COLUMNS, "ListingContractDate")))
def q_validate_listed(r):
    return VA.validate_dataset(VA.stored_input(r.listed_r, "ListingContractDate"), "ListingContractDate")


_SRC = "(SELECT *, substr(ListingContractDate, 1, 7) AS source FROM sold)"


@register("per_source_profile", sql(f"""
SELECT source, count(*) AS rows, count({D('CloseDate')}) AS valid_dates, {DSTR(f"min({D('CloseDate')})")} AS min_date,
       {DSTR(f"max({D('CloseDate')})")} AS max_date,
       {' + '.join(f"(CASE WHEN CAST(count(*) FILTER (WHERE {c} IS NULL) AS DOUBLE) * 100.0E0 / count(*) > 5.0 THEN 1 ELSE 0 END)" for c in FD.FILE_CRITICAL_FIELDS)} AS high_null_fields
FROM {_SRC} s GROUP BY source"""))
def q_per_source_profile(r):
    return VA.per_source_profile(r.sold_by_source(), "source", "CloseDate")


@register("per_source_type_mix", sql(f"""
SELECT source, PropertyType AS value, count(*) AS n,
       {PCT('count(*)', 'max(t.rows)')} AS pct
FROM {_SRC} s JOIN (SELECT source AS src, count(*) AS rows FROM {_SRC} x GROUP BY source) t ON s.source = t.src
WHERE PropertyType IS NOT NULL GROUP BY source, PropertyType"""))
def q_per_source_type_mix(r):
    return VA.per_source_type_mix(r.sold_by_source(), "source")


@register("dataset_summary", sql(f"""
SELECT count(DISTINCT source) AS sources, count(*) AS rows, {len(SOLD_COLUMNS) + 1} AS columns,
       {DSTR(f"min({D('CloseDate')})")} AS min_date, {DSTR(f"max({D('CloseDate')})")} AS max_date,
       count(DISTINCT {YM(D('CloseDate'))}) AS months FROM {_SRC} s"""))
def q_dataset_summary(r):
    return VA.dataset_summary(r.sold_by_source(), "source", "CloseDate")


# ---------------------------------------------------------------- the listed dataset's profiles

_NP_LISTED = f"({null_counts_sql('listed_r', LISTED_COLUMNS)}) np"
_SRC_LISTED = "(SELECT *, substr(ListingContractDate, 1, 7) AS source FROM listed)"


@register("null_profile_listed", sql(f"""SELECT column_name, position, null_count, {PCT('null_count', 'rows', 2)} AS null_pct,
       CAST(null_count AS DOUBLE) / rows > 0.9 AS drop_candidate FROM {_NP_LISTED}"""))
def q_null_profile_listed(r):
    return PR.null_profile(r.listed_r)


@register("high_null_columns_listed", sql(f"""SELECT column_name, null_count, {PCT('null_count', 'rows', 2)} AS null_pct FROM {_NP_LISTED}
WHERE CAST(null_count AS DOUBLE) / rows > 0.9"""))
def q_high_null_columns_listed(r):
    return PR.high_null_columns(r.listed_r)


@register("complete_columns_listed", sql(f"""
SELECT count(*) FILTER (WHERE null_count = 0) AS complete_columns, count(*) AS total_columns FROM {_NP_LISTED}"""))
def q_complete_columns_listed(r):
    return PR.complete_columns(r.listed_r)


@register("compact_stats_listed", sql("\nUNION ALL ".join(f"""SELECT source, '{f}' AS field, min(v) AS min, {R4('quantile_cont(v, 0.5)')} AS median,
       max(v) AS max, count(*) - count(v) AS nulls FROM (SELECT source, {N(f)} AS v FROM {_SRC_LISTED} s) t GROUP BY source HAVING count(v) > 0"""
                                                          for f in ("ListPrice", "LivingArea"))))
def q_compact_stats_listed(r):
    return PR.compact_stats(r.listed_by_source(), "source")


@register("per_source_profile_listed", sql(f"""
SELECT source, count(*) AS rows, count({D('ListingContractDate')}) AS valid_dates, {DSTR(f"min({D('ListingContractDate')})")} AS min_date,
       {DSTR(f"max({D('ListingContractDate')})")} AS max_date,
       {' + '.join(f"(CASE WHEN CAST(count(*) FILTER (WHERE {c} IS NULL) AS DOUBLE) * 100.0E0 / count(*) > 5.0 THEN 1 ELSE 0 END)" for c in ("PropertyType", "City", "CountyOrParish"))} AS high_null_fields
FROM {_SRC_LISTED} s GROUP BY source"""))
def q_per_source_profile_listed(r):
    return VA.per_source_profile(r.listed_by_source(), "source", "ListingContractDate")


@register("per_source_type_mix_listed", sql(f"""
SELECT source, PropertyType AS value, count(*) AS n, {PCT('count(*)', 'max(t.rows)')} AS pct
FROM {_SRC_LISTED} s JOIN (SELECT source AS src, count(*) AS rows FROM {_SRC_LISTED} x GROUP BY source) t ON s.source IS NOT DISTINCT FROM t.src
WHERE PropertyType IS NOT NULL GROUP BY source, PropertyType"""))
def q_per_source_type_mix_listed(r):
    return VA.per_source_type_mix(r.listed_by_source(), "source")


@register("dataset_summary_listed", sql(f"""
SELECT count(DISTINCT source) AS sources, count(*) AS rows, {len(LISTED_COLUMNS) + 1} AS columns,
       {DSTR(f"min({D('ListingContractDate')})")} AS min_date, {DSTR(f"max({D('ListingContractDate')})")} AS max_date,
       count(DISTINCT {YM(D('ListingContractDate'))}) AS months FROM {_SRC_LISTED} s"""))
def q_dataset_summary_listed(r):
    return VA.dataset_summary(r.listed_by_source(), "source", "ListingContractDate")


@register("dataset_monthly", sql(f"""
SELECT 'SOLD' AS dataset, {YM(D('CloseDate'))} AS year_month, count(*) AS n FROM sold WHERE {D('CloseDate')} IS NOT NULL GROUP BY 2
UNION ALL SELECT 'LISTED', {YM(D('ListingContractDate'))}, count(*) FROM listed WHERE {D('ListingContractDate')} IS NOT NULL GROUP BY 2"""))
def q_dataset_monthly(r):
    """Monthly counts of both whole datasets."""
    return CAL.monthly_counts(r.sold, "CloseDate").select(F.lit("SOLD").alias("dataset"), "year_month", "n").unionByName(
        CAL.monthly_counts(r.listed, "ListingContractDate").select(F.lit("LISTED").alias("dataset"), "year_month", "n"))


# ---------------------------------------------------------------- rates and the join

@register("rates_clean", sql(f"SELECT {DSTR('date')} AS date, rate_30yr_fixed FROM rates_c"))
def q_rates_clean(r):
    return r.rates


@register("rates_monthly", sql("SELECT year_month, rate_30yr_fixed FROM monthly"))
def q_rates_monthly(r):
    return r.monthly


@register("rates_coverage", sql(f"""
SELECT count(*) AS n, {DSTR('min(date)')} AS first_date, {DSTR('max(date)')} AS last_date,
       min(rate_30yr_fixed) AS min_rate, max(rate_30yr_fixed) AS max_rate FROM rates_c"""))
def q_rates_coverage(r):
    return RT.rates_coverage(r.rates)


@register("rates_recent", sql("SELECT year_month, rate_30yr_fixed FROM monthly ORDER BY year_month DESC LIMIT 6"))
def q_rates_recent(r):
    return RT.rates_recent(r.monthly)


@register("enrich_sold", sql("SELECT ListingKey, CloseDate, year_month, ClosePrice, rate_30yr_fixed FROM sold_e"))
def q_enrich_sold(r):
    return r.sold_e.select("ListingKey", "CloseDate", "year_month", "ClosePrice", "rate_30yr_fixed")


@register("enrich_listed", sql("SELECT ListingKey, ListingContractDate, year_month, ListPrice, rate_30yr_fixed FROM listed_e"))
def q_enrich_listed(r):
    return r.listed_e.select("ListingKey", "ListingContractDate", "year_month", "ListPrice", "rate_30yr_fixed")


def _audit_sql(name: str, before: str, after: str) -> str:
    return f"""SELECT '{name}' AS dataset, (SELECT count(*) FROM {before}) AS rows_before, count(*) AS rows_after,
       count(*) FILTER (WHERE year_month IS NULL) AS null_keys,
       count(*) FILTER (WHERE rate_30yr_fixed IS NULL) AS null_rates,
       (SELECT count(*) FROM {before}) = count(*) AS row_count_kept,
       CASE WHEN count(*) FILTER (WHERE rate_30yr_fixed IS NULL) = 0 THEN 'PASS' ELSE 'WARNING' END AS status
FROM {after}"""


@register("join_audit", sql(_audit_sql("SOLD", "sold_r", "sold_e") + "\nUNION ALL " + _audit_sql("LISTED", "listed_r", "listed_e")))
def q_join_audit(r):
    s = RT.join_audit(r.sold_r, r.sold_e).select(F.lit("SOLD").alias("dataset"), "*")
    l = RT.join_audit(r.listed_r, r.listed_e).select(F.lit("LISTED").alias("dataset"), "*")
    return s.unionByName(l)


@register("unmatched_months", sql("""
SELECT 'SOLD' AS dataset, year_month, count(*) AS n FROM sold_e WHERE rate_30yr_fixed IS NULL AND year_month IS NOT NULL GROUP BY year_month
UNION ALL
SELECT 'LISTED', year_month, count(*) FROM listed_e WHERE rate_30yr_fixed IS NULL AND year_month IS NOT NULL GROUP BY year_month"""))
def q_unmatched_months(r):
    s = RT.unmatched_keys(r.sold_e).select(F.lit("SOLD").alias("dataset"), "*")
    l = RT.unmatched_keys(r.listed_e).select(F.lit("LISTED").alias("dataset"), "*")
    return s.unionByName(l)


# ---------------------------------------------------------------- distribution tables

def _clipped_sql(field: str) -> str:
    return f"""(SELECT least(v, (SELECT quantile_cont(v, 0.99) FROM (SELECT {N(field)} AS v FROM sold_r) a WHERE v IS NOT NULL)) AS v
   FROM (SELECT {N(field)} AS v FROM sold_r) b WHERE v IS NOT NULL)"""


@register("histogram_original_list_price", sql(f""", c AS {_clipped_sql('OriginalListPrice')},
e AS (SELECT CASE WHEN min(v) = max(v) THEN min(v) - 0.5 ELSE min(v) END AS lo,
             CASE WHEN min(v) = max(v) THEN max(v) + 0.5 ELSE max(v) END AS hi FROM c),
h AS (SELECT CAST(least(floor((v - (SELECT lo FROM e)) * 60 / ((SELECT hi FROM e) - (SELECT lo FROM e))), 59) AS INTEGER) AS bin,
             count(*) AS n FROM c GROUP BY 1)
SELECT CAST(b.bin AS INTEGER) AS bin,
       {R4("(SELECT lo FROM e) + b.bin * (((SELECT hi FROM e) - (SELECT lo FROM e)) / 60)")} AS lower,
       {R4("(SELECT lo FROM e) + (b.bin + 1) * (((SELECT hi FROM e) - (SELECT lo FROM e)) / 60)")} AS upper,
       CAST(coalesce(h.n, 0) AS BIGINT) AS n
FROM (SELECT unnest(range(0, 60)) AS bin) b LEFT JOIN h ON h.bin = b.bin"""))
def q_histogram(r):
    return DI.histogram(r.sold_r, "OriginalListPrice")


# The fields of the distribution review that both engines' tables have.
_REVIEWED = ["ClosePrice", "ListPrice", "OriginalListPrice", "LivingArea", "LotSizeAcres", "BedroomsTotal",
             "BathroomsTotalInteger", "DaysOnMarket", "YearBuilt"]


def _histogram_sql(field: str) -> str:
    ends = f"(SELECT CASE WHEN min(v) = max(v) THEN min(v) - 0.5 ELSE min(v) END AS lo, CASE WHEN min(v) = max(v) THEN max(v) + 0.5 ELSE max(v) END AS hi FROM {_clipped_sql(field)} c)"
    counts = f"(SELECT CAST(least(floor((v - lo) * 60 / (hi - lo)), 59) AS INTEGER) AS bin, count(*) AS n FROM {_clipped_sql(field)} c, {ends} e GROUP BY 1)"
    return f"""SELECT '{field}' AS field, CAST(b.bin AS INTEGER) AS bin, {R4("lo + b.bin * ((hi - lo) / 60)")} AS lower,
       {R4("lo + (b.bin + 1) * ((hi - lo) / 60)")} AS upper, CAST(coalesce(h.n, 0) AS BIGINT) AS n
FROM (SELECT unnest(range(0, 60)) AS bin) b CROSS JOIN {ends} e LEFT JOIN {counts} h ON h.bin = b.bin"""


@register("histograms", sql("\nUNION ALL ".join(map(_histogram_sql, _REVIEWED))))
def q_histograms(r):
    """Histograms of all nine reviewed fields from one quantile run."""
    return DI.histograms(r.sold_r)


def _box_sql(field: str) -> str:
    return f"""SELECT '{field}' AS field, {R4('q1')} AS q1, {R4('med')} AS median, {R4('q3')} AS q3, {R4('q3 - q1')} AS iqr,
       coalesce((SELECT min(v) FROM {_clipped_sql(field)} c WHERE v >= q1 - 1.5 * (q3 - q1)), q1) AS whisker_low,
       coalesce((SELECT max(v) FROM {_clipped_sql(field)} c WHERE v <= q3 + 1.5 * (q3 - q1)), q3) AS whisker_high,
       (SELECT count(*) FROM {_clipped_sql(field)} c WHERE v < q1 - 1.5 * (q3 - q1) OR v > q3 + 1.5 * (q3 - q1)) AS n_outliers
FROM (SELECT quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS med, quantile_cont(v, 0.75) AS q3
      FROM {_clipped_sql(field)} c) q"""


@register("boxplot_stats", sql("\nUNION ALL ".join(map(_box_sql, _REVIEWED))))
def q_boxplot_stats(r):
    """Boxplot numbers of all nine reviewed fields from one quantile run."""
    return DI.boxplot_stats(r.sold_r)


@register("clip_p99", sql(f"""
SELECT ListingKey, CASE WHEN {N('ClosePrice')} IS NOT NULL
       THEN least({N('ClosePrice')}, (SELECT quantile_cont({N('ClosePrice')}, 0.99) FROM sold_r)) END AS ClosePrice
FROM sold_r"""))
def q_clip_p99(r):
    # the two columns written once: the quantile and the result read them
    return DI.clip_upper(stored(r.sold_r.select("ListingKey", "ClosePrice"), "prices"), "ClosePrice")


# ---------------------------------------------------------------- coercion

@register("coerce_numeric", sql(f"""
SELECT ListingKey, {N('ClosePrice')} AS ClosePrice, {N('LivingArea')} AS LivingArea, {N('DaysOnMarket')} AS DaysOnMarket
FROM sold"""))
def q_coerce_numeric(r):
    s = r.sold
    return s.select("ListingKey", *[as_number(s, c).alias(c) for c in ("ClosePrice", "LivingArea", "DaysOnMarket")])


@register("coerce_dates", sql(f"""
SELECT ListingKey, {DSTR(D('CloseDate'))} AS CloseDate, {DSTR(D('PurchaseContractDate'))} AS PurchaseContractDate,
       {TSTR(TS('ModificationTimestamp'))} AS ModificationTimestamp FROM sold"""))
def q_coerce_dates(r):
    s = r.sold
    return s.select("ListingKey", as_date(s, "CloseDate").alias("CloseDate"),
                    as_date(s, "PurchaseContractDate").alias("PurchaseContractDate"),
                    as_timestamp(s, "ModificationTimestamp").alias("ModificationTimestamp"))


# ---------------------------------------------------------------- cleaning

_SOLD_E_COLS = SOLD_COLUMNS + ["year_month", "rate_30yr_fixed"]
_LISTED_E_COLS = LISTED_COLUMNS + ["year_month", "rate_30yr_fixed"]


@register("drop_high_null", sql("SELECT * EXCLUDE (TaxYear, BusinessType) FROM sold_e"))
def q_drop_high_null(r):
    kept, _dropped = CL.drop_high_null(r.sold_e)
    return kept


@register("dropped_columns", sql(f""", nps AS ({null_counts_sql('sold_e', _SOLD_E_COLS)}),
npl AS ({null_counts_sql('listed_e', _LISTED_E_COLS)})
SELECT 'SOLD' AS dataset, column_name, {PCT('null_count', 'rows', 2)} AS null_pct FROM nps WHERE CAST(null_count AS DOUBLE) / rows > 0.9
UNION ALL
SELECT 'LISTED', column_name, {PCT('null_count', 'rows', 2)} FROM npl WHERE CAST(null_count AS DOUBLE) / rows > 0.9"""))
def q_dropped_columns(r):
    return r.clean_sold.dropped.select(F.lit("SOLD").alias("dataset"), "*").unionByName(
        r.clean_listed.dropped.select(F.lit("LISTED").alias("dataset"), "*"))


def _parse_report_sql(name: str, table: str, fields: list[str], cols: list[str]) -> str:
    present = [f for f in fields if f in cols]
    parser = {f: (TS if f in FD.TIMESTAMP_FIELDS else D) for f in present}
    return "\nUNION ALL ".join(
        f"SELECT '{name}' AS dataset, '{f}' AS column_name, count(*) FILTER (WHERE {f} IS NULL) AS before_null, "
        f"count(*) FILTER (WHERE {parser[f](f)} IS NULL) AS after_null, "
        f"count(*) FILTER (WHERE {parser[f](f)} IS NULL) - count(*) FILTER (WHERE {f} IS NULL) AS new_nulls FROM {table}"
        for f in present)


@register("date_parse_report", sql(
    _parse_report_sql("SOLD", "sold_e", FD.SOLD_DATE_FIELDS, _SOLD_E_COLS) + "\nUNION ALL "
    + _parse_report_sql("LISTED", "listed_e", FD.LISTED_DATE_FIELDS, _LISTED_E_COLS)))
def q_date_parse_report(r):
    return r.clean_sold.parse_report.select(F.lit("SOLD").alias("dataset"), "*").unionByName(
        r.clean_listed.parse_report.select(F.lit("LISTED").alias("dataset"), "*"))


@register("parse_dates", sql(f"""
SELECT ListingKey, {DSTR('ListingContractDate')} AS ListingContractDate, {DSTR('CloseDate')} AS CloseDate,
       {TSTR('StatusChangeTimestamp')} AS StatusChangeTimestamp, {TSTR('ModificationTimestamp')} AS ModificationTimestamp
FROM clean_s"""))
def q_parse_dates(r):
    return CL.parse_dates(r.sold_e, FD.SOLD_DATE_FIELDS).select("ListingKey", *FD.SOLD_DATE_FIELDS)


@register("export_dates", sql(f"""
SELECT ListingKey, {DSTR('ListingContractDate')} AS ListingContractDate, {DSTR('CloseDate')} AS CloseDate,
       strftime(StatusChangeTimestamp, '%Y-%m-%d') AS StatusChangeTimestamp,
       strftime(ModificationTimestamp, '%Y-%m-%d') AS ModificationTimestamp FROM clean_s"""))
def q_export_dates(r):
    return CL.export_dates(r.clean_sold.data).select("ListingKey", *FD.SOLD_DATE_FIELDS)


_DATE_FLAGS = ["listing_after_close_flag", "purchase_after_close_flag", "negative_timeline_flag"]


@register("date_flags", sql(f"SELECT ListingKey, {', '.join(_DATE_FLAGS)} FROM clean_s"))
def q_date_flags(r):
    return CL.add_date_flags(r.sold_e).select("ListingKey", *_DATE_FLAGS)


_SOLD_NUM_FLAGS = [k for k in SOLD_FLAGS_SQL if k not in _DATE_FLAGS]


@register("numeric_flags_sold", sql(f"SELECT ListingKey, {', '.join(_SOLD_NUM_FLAGS)} FROM clean_s"))
def q_numeric_flags_sold(r):
    return CL.flag_invalid(r.sold_e, FD.SOLD_FLAG_RULES).select("ListingKey", *_SOLD_NUM_FLAGS)


@register("numeric_flags_listed", sql(f"SELECT ListingKey, {', '.join(LISTED_FLAGS_SQL)} FROM clean_l"))
def q_numeric_flags_listed(r):
    return CL.flag_invalid(r.listed_e, FD.LISTED_FLAG_RULES).select("ListingKey", *LISTED_FLAGS_SQL)


@register("numeric_flags_last", sql("SELECT ListingKey, " + ", ".join(
    f"{SOLD_FLAGS_LAST_SQL[k]} AS {k}" for k in _SOLD_NUM_FLAGS) + " FROM sold_e"))
def q_numeric_flags_last(r):
    return CL.flag_invalid(r.sold_e, FD.SOLD_FLAG_RULES, combine="last").select("ListingKey", *_SOLD_NUM_FLAGS)


def _flag_log_sql(name: str, table: str, rules, cols) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{name}' AS dataset, '{c}' AS \"column\", '{label}' AS rule, "
        f"count(*) FILTER (WHERE {N(c)} {_rule_sql(k, b)}) AS flagged FROM {table}"
        for c, label, k, b in rules if c in cols)


@register("flag_log", sql(_flag_log_sql("SOLD", "sold_e", FD.SOLD_FLAG_RULES, _SOLD_E_COLS) + "\nUNION ALL "
                          + _flag_log_sql("LISTED", "listed_e", FD.LISTED_FLAG_RULES, _LISTED_E_COLS)))
def q_flag_log(r):
    return r.clean_sold.flag_log.unionByName(r.clean_listed.flag_log)


@register("any_flag_sold", sql("SELECT ListingKey, any_invalid_flag FROM clean_s"))
def q_any_flag_sold(r):
    return r.clean_sold.data.select("ListingKey", "any_invalid_flag")


@register("any_flag_listed", sql("SELECT ListingKey, any_invalid_flag FROM clean_l"))
def q_any_flag_listed(r):
    return r.clean_listed.data.select("ListingKey", "any_invalid_flag")


def _geo_nulls_sql(name, table, cols, fields=FD.GEO_AUDIT_FIELDS) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{name}' AS dataset, '{f}' AS column_name, count(*) - count({f}) AS null_count, "
        f"{PCT(f'count(*) - count({f})', 'count(*)', 2)} AS null_pct FROM {table}"
        for f in fields if f in cols)


_CLEAN_S_COLS = [c for c in _SOLD_E_COLS if c not in ("TaxYear", "BusinessType")]
_CLEAN_L_COLS = [c for c in _LISTED_E_COLS if c != "CoveredSpaces"]


@register("geo_nulls", sql(_geo_nulls_sql("SOLD", "clean_s", _CLEAN_S_COLS) + "\nUNION ALL "
                           + _geo_nulls_sql("LISTED", "clean_l", _CLEAN_L_COLS)))
def q_geo_nulls(r):
    return CL.geo_nulls(r.clean_sold.data, "SOLD").unionByName(CL.geo_nulls(r.clean_listed.data, "LISTED"))


def _geo_counts_sql(name, table) -> str:
    lat, lon = N("Latitude"), N("Longitude")
    return (f"SELECT '{name}' AS dataset, count(*) FILTER (WHERE {lat} IS NULL OR {lon} IS NULL) AS null_geo, "
            f"count(*) FILTER (WHERE {lat} = 0) AS zero_lat, count(*) FILTER (WHERE {lon} = 0) AS zero_lon, "
            f"count(*) FILTER (WHERE {lon} > 0) AS pos_lon FROM {table}")


@register("geo_counts", sql(_geo_counts_sql("SOLD", "clean_s") + "\nUNION ALL " + _geo_counts_sql("LISTED", "clean_l")))
def q_geo_counts(r):
    return CL.geo_counts(r.clean_sold.data, "SOLD").unionByName(CL.geo_counts(r.clean_listed.data, "LISTED"))


@register("geo_flags", sql(f"SELECT ListingKey, {', '.join(GEO_FLAGS_SQL)} FROM clean_s"))
def q_geo_flags(r):
    return CL.geo_flags(r.sold_e).select("ListingKey", *GEO_FLAGS_SQL)


_ALL_SOLD_FLAGS = list(SOLD_FLAGS_SQL) + ["any_invalid_flag"] + list(GEO_FLAGS_SQL)
_ALL_LISTED_FLAGS = list(LISTED_FLAGS_SQL) + ["any_invalid_flag"] + list(GEO_FLAGS_SQL)


@register("clean_sold", sql(f"SELECT ListingKey, {', '.join(_ALL_SOLD_FLAGS)} FROM clean_s"))
def q_clean_sold(r):
    return CL.flag_view(r.clean_sold)


@register("clean_listed", sql(f"SELECT ListingKey, {', '.join(_ALL_LISTED_FLAGS)} FROM clean_l"))
def q_clean_listed(r):
    return CL.flag_view(r.clean_listed)


# ---------------------------------------------------------------- report tables

def _totals_cte() -> str:
    s_dates = ", ".join(f"CAST(sum({f}) AS BIGINT) AS {f}" for f in _DATE_FLAGS)
    return f""", ts AS (SELECT 'SOLD' AS dataset, (SELECT count(*) FROM sold_e) AS raw_rows, {len(_SOLD_E_COLS)} AS raw_cols,
   {len(_SOLD_E_COLS) + len(_ALL_SOLD_FLAGS)} - (SELECT count(*) FROM ({null_counts_sql('sold_e', _SOLD_E_COLS)}) z
     WHERE CAST(null_count AS DOUBLE) / rows > 0.9) AS clean_cols,
   (SELECT count(*) FROM ({null_counts_sql('sold_e', _SOLD_E_COLS)}) z WHERE CAST(null_count AS DOUBLE) / rows > 0.9) AS cols_dropped,
   count(*) AS clean_rows,
   CAST(sum(any_invalid_flag) AS BIGINT) AS any_invalid_flag,
   CAST(sum(GREATEST({', '.join(_DATE_FLAGS)})) AS BIGINT) AS rows_with_date_flag, {s_dates} FROM clean_s),
tl AS (SELECT 'LISTED' AS dataset, (SELECT count(*) FROM listed_e) AS raw_rows, {len(_LISTED_E_COLS)} AS raw_cols,
   {len(_LISTED_E_COLS) + len(_ALL_LISTED_FLAGS)} - (SELECT count(*) FROM ({null_counts_sql('listed_e', _LISTED_E_COLS)}) z
     WHERE CAST(null_count AS DOUBLE) / rows > 0.9) AS clean_cols,
   (SELECT count(*) FROM ({null_counts_sql('listed_e', _LISTED_E_COLS)}) z WHERE CAST(null_count AS DOUBLE) / rows > 0.9) AS cols_dropped,
   count(*) AS clean_rows,
   CAST(sum(any_invalid_flag) AS BIGINT) AS any_invalid_flag FROM clean_l)
"""


@register("scorecard", sql(_totals_cte() + """
SELECT metric, CAST(value AS BIGINT) AS value FROM (
SELECT 'sold_raw_rows' AS metric, raw_rows AS value FROM ts UNION ALL SELECT 'listed_raw_rows', raw_rows FROM tl
UNION ALL SELECT 'sold_cols_dropped', cols_dropped FROM ts UNION ALL SELECT 'listed_cols_dropped', cols_dropped FROM tl
UNION ALL SELECT 'sold_listing_after_close_flag', listing_after_close_flag FROM ts
UNION ALL SELECT 'sold_purchase_after_close_flag', purchase_after_close_flag FROM ts
UNION ALL SELECT 'sold_negative_timeline_flag', negative_timeline_flag FROM ts
UNION ALL SELECT 'sold_any_invalid_flag', any_invalid_flag FROM ts UNION ALL SELECT 'listed_any_invalid_flag', any_invalid_flag FROM tl
UNION ALL SELECT 'sold_clean_cols', clean_cols FROM ts UNION ALL SELECT 'listed_clean_cols', clean_cols FROM tl) k"""))
def q_scorecard(r):
    return RP.scorecard(r.clean_sold, r.clean_listed)


@register("flag_rates", sql(_totals_cte() + f"""
SELECT dataset, flag, flagged, total, coalesce({PCT('flagged', 'total')}, 0.0) AS pct,
       least(coalesce({PCT('flagged', 'total')}, 0.0), 100.0) AS bar_pct FROM (
SELECT dataset, 'any_invalid_flag' AS flag, any_invalid_flag AS flagged, clean_rows AS total FROM ts
UNION ALL SELECT dataset, 'listing_after_close_flag', listing_after_close_flag, clean_rows FROM ts
UNION ALL SELECT dataset, 'purchase_after_close_flag', purchase_after_close_flag, clean_rows FROM ts
UNION ALL SELECT dataset, 'negative_timeline_flag', negative_timeline_flag, clean_rows FROM ts
UNION ALL SELECT dataset, 'any_invalid_flag', any_invalid_flag, clean_rows FROM tl) f"""))
def q_flag_rates(r):
    return RP.flag_rates(r.clean_sold, r.clean_listed)


@register("before_after", sql(_totals_cte() + """
SELECT dataset, measure, before, after, after - before AS delta FROM (
SELECT dataset, 'rows' AS measure, raw_rows AS before, clean_rows AS after FROM ts
UNION ALL SELECT dataset, 'columns', CAST(raw_cols AS BIGINT), CAST(clean_cols AS BIGINT) FROM ts
UNION ALL SELECT dataset, 'rows', raw_rows, clean_rows FROM tl
UNION ALL SELECT dataset, 'columns', CAST(raw_cols AS BIGINT), CAST(clean_cols AS BIGINT) FROM tl) b"""))
def q_before_after(r):
    return RP.before_after(r.clean_sold, r.clean_listed)


@register("rule_rates", sql(f""", lg AS ({_flag_log_sql("SOLD", "sold_e", FD.SOLD_FLAG_RULES, _SOLD_E_COLS)}
UNION ALL {_flag_log_sql("LISTED", "listed_e", FD.LISTED_FLAG_RULES, _LISTED_E_COLS)})
SELECT dataset, "column", rule, flagged,
  coalesce({PCT('flagged', "CASE WHEN dataset = 'SOLD' THEN (SELECT count(*) FROM clean_s) ELSE (SELECT count(*) FROM clean_l) END")}, 0.0) AS pct
FROM lg"""))
def q_rule_rates(r):
    return RP.rule_rates(r.clean_sold, r.clean_listed)


@register("geo_coverage", sql(f"""
SELECT *, CASE WHEN null_pct < 5.0 THEN 'Good' WHEN null_pct < 20.0 THEN 'Partial' ELSE 'Sparse' END AS status FROM (
{_geo_nulls_sql("SOLD", "clean_s", _CLEAN_S_COLS, FD.GEO_COVERAGE_FIELDS)}
UNION ALL {_geo_nulls_sql("LISTED", "clean_l", _CLEAN_L_COLS, FD.GEO_COVERAGE_FIELDS)}) g"""))
def q_geo_coverage(r):
    return RP.geo_coverage(r.clean_sold, r.clean_listed)


def _validity_sql(name, table) -> str:
    return f"""SELECT dataset, "check", n, coalesce({PCT('n', f'(SELECT count(*) FROM {table})')}, 0.0) AS pct,
       CASE WHEN n = 0 THEN 'None' ELSE 'Flagged' END AS status FROM (
  UNPIVOT ({_geo_counts_sql(name, table)}) ON null_geo, zero_lat, zero_lon, pos_lon INTO NAME "check" VALUE n) u"""


@register("geo_validity", sql(_validity_sql("SOLD", "clean_s") + "\nUNION ALL " + _validity_sql("LISTED", "clean_l")))
def q_geo_validity(r):
    return RP.geo_validity(r.clean_sold, r.clean_listed)


@register("date_consistency", sql(_totals_cte() + f"""
SELECT listing_after_close_flag + purchase_after_close_flag + negative_timeline_flag AS date_flag_hits,
       rows_with_date_flag, clean_rows - rows_with_date_flag AS consistent_rows,
       {PCT('clean_rows - rows_with_date_flag', 'clean_rows')} AS consistent_pct,
       {', '.join(f"{PCT(f, 'clean_rows')} AS {f}_pct" for f in _DATE_FLAGS)} FROM ts"""))
def q_date_consistency(r):
    return RP.date_consistency(r.clean_sold)


# What the flags of each dataset mean.
_MEANINGS = {
    "SOLD": {
        "listing_after_close_flag": "1 if ListingContractDate > CloseDate",
        "purchase_after_close_flag": "1 if PurchaseContractDate > CloseDate",
        "negative_timeline_flag": "1 if ListingContractDate > PurchaseContractDate",
        "ClosePrice_invalid_flag": "1 if ClosePrice <= 0 OR ClosePrice > $50M",
        "ListPrice_invalid_flag": "1 if ListPrice <= 0",
        "OriginalListPrice_invalid_flag": "1 if OriginalListPrice <= 0 OR OriginalListPrice > $50M",
        "LivingArea_invalid_flag": "1 if LivingArea <= 0",
        "DaysOnMarket_invalid_flag": "1 if DaysOnMarket < 0",
    },
    "LISTED": {
        "ListPrice_invalid_flag": "1 if ListPrice <= 0 OR ListPrice > $50M",
        "LivingArea_invalid_flag": "1 if LivingArea <= 0",
    },
}
for _flags in _MEANINGS.values():
    _flags |= {
        "geo_null_flag": "1 if Latitude or Longitude is null", "geo_sentinel_flag": "1 if Latitude = 0 or Longitude = 0",
        "geo_invalid_flag": "1 if Longitude > 0", "any_invalid_flag": "1 if any numeric or date flag is 1",
    }


def _dictionary_sql() -> str:
    return sql("\nUNION ALL ".join(
        f"SELECT '{name}' AS dataset, '{flag}' AS flag, '{meaning}' AS meaning, CAST(sum({flag}) AS BIGINT) AS flagged FROM {table}"
        for name, table in (("SOLD", "clean_s"), ("LISTED", "clean_l")) for flag, meaning in _MEANINGS[name].items()))


@register("flag_dictionary", _dictionary_sql())
def q_flag_dictionary(r):
    return RP.flag_dictionary(r.clean_sold, r.clean_listed)


@register("output_catalogue", sql(f"""
SELECT 'sold_clean_flagged' AS output, count(*) AS rows, {len(_CLEAN_S_COLS) + len(_ALL_SOLD_FLAGS)} AS columns FROM clean_s
UNION ALL SELECT 'listed_clean_flagged', count(*), {len(_CLEAN_L_COLS) + len(_ALL_LISTED_FLAGS)} FROM clean_l
UNION ALL SELECT 'numeric_flag_log', count(*), 4 FROM (
  {_flag_log_sql("SOLD", "sold_e", FD.SOLD_FLAG_RULES, _SOLD_E_COLS)}
  UNION ALL {_flag_log_sql("LISTED", "listed_e", FD.LISTED_FLAG_RULES, _LISTED_E_COLS)}) lg"""))
def q_output_catalogue(r):
    return RP.output_catalogue({
        "sold_clean_flagged": r.clean_sold.data,
        "listed_clean_flagged": r.clean_listed.data,
        "numeric_flag_log": r.clean_sold.flag_log.unionByName(r.clean_listed.flag_log),
    })


# ---------------------------------------------------------------- features

@register("features_price", sql(f"""
SELECT ListingKey, {R4(f"{N('ClosePrice')} / nullif({N('LivingArea')}, 0)")} AS price_per_sqft,
       {R4(f"{N('ClosePrice')} / nullif({N('OriginalListPrice')}, 0)")} AS price_ratio,
       {R4(f"({N('ListPrice')} - {N('OriginalListPrice')}) / nullif({N('OriginalListPrice')}, 0)")} AS list_price_change
FROM sold_r"""))
def q_features_price(r):
    return FE.features_price(r.sold_r).select("ListingKey", "price_per_sqft", "price_ratio", "list_price_change")


@register("features_time", sql(f"""
SELECT ListingKey, CAST(date_diff('day', {D('ListingContractDate')}, {D('PurchaseContractDate')}) AS INTEGER) AS days_to_contract,
       CAST(date_diff('day', {D('PurchaseContractDate')}, {D('CloseDate')}) AS INTEGER) AS contract_to_close FROM sold_r"""))
def q_features_time(r):
    return FE.features_time(r.sold_r).select("ListingKey", "days_to_contract", "contract_to_close")


@register("features_calendar", sql(f"""
SELECT ListingKey, CAST(month({D('ListingContractDate')}) AS INTEGER) AS listing_month,
       CAST(quarter({D('ListingContractDate')}) AS INTEGER) AS listing_quarter,
       CAST(year({D('ListingContractDate')}) AS INTEGER) AS listing_year FROM sold_r"""))
def q_features_calendar(r):
    return FE.features_calendar(r.sold_r).select("ListingKey", "listing_month", "listing_quarter", "listing_year")


@register("geo_bbox", sql(f"""
SELECT ListingKey, {FLAG(f"{N('Latitude')} IS NOT NULL AND {N('Longitude')} IS NOT NULL AND NOT ({N('Latitude')} BETWEEN 32.0 AND 42.0 AND {N('Longitude')} BETWEEN -125.0 AND -114.0)")} AS geo_outside_bbox_flag
FROM sold_r"""))
def q_geo_bbox(r):
    return FE.geo_bbox(r.sold_r).select("ListingKey", "geo_outside_bbox_flag")


@register("remove_flagged", sql(f"SELECT ListingKey, {DSTR('CloseDate')} AS CloseDate, ClosePrice FROM clean_s WHERE any_invalid_flag = 0"))
def q_remove_flagged(r):
    return FE.remove_flagged(r.clean_sold.data).select("ListingKey", "CloseDate", "ClosePrice")


# ---------------------------------------------------------------- union by name (monthly schema drift)

@register("union_monthly", sql("""
SELECT ListingKey, City, ClosePrice, CAST(NULL AS INTEGER) AS TaxYear FROM sold WHERE month(CAST(ListingContractDate AS DATE)) % 2 = 1
UNION ALL
SELECT ListingKey, NULL, ClosePrice, TaxYear FROM sold WHERE month(CAST(ListingContractDate AS DATE)) % 2 = 0"""))
def q_union_monthly(r):
    """Odd and even months carry different headers (reordered, one extra); union by name."""
    from homestats.sources.tables import union_by_name

    m = F.month(F.col("ListingContractDate").cast("date"))
    odd = r.sold.where(m % 2 == 1).select("ListingKey", "City", "ClosePrice")
    even = r.sold.where(m % 2 == 0).select("ClosePrice", "TaxYear", "ListingKey")
    return union_by_name([odd, even])


@register("preview", sql("""
SELECT ListingKey, CloseDate, year_month, ClosePrice, rate_30yr_fixed FROM sold_e
ORDER BY ListingKey NULLS LAST, CloseDate NULLS LAST, year_month NULLS LAST, ClosePrice NULLS LAST,
         rate_30yr_fixed NULLS LAST LIMIT 5"""))
def q_preview(r):
    """First five enriched rows; the order covers every shown column (keys repeat)."""
    return PR.preview(r.sold_e, ["ListingKey", "CloseDate", "year_month", "ClosePrice", "rate_30yr_fixed"], 5)


@register("schema_overview", sql("""
SELECT t.data_type, CAST(t.n AS BIGINT) AS n_columns, (SELECT count(*) FROM sold_r) AS rows, 27 AS columns
FROM (VALUES ('string', 14), ('double', 6), ('int', 6), ('bigint', 1)) t(data_type, n)"""))
def q_schema_overview(r):
    return PR.schema_overview(r.sold_r)
