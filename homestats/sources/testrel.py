"""Sold / listed / rate relations derived from the driver's TPC-H-style tables.

The driver tables hold no nulls, so a deterministic key injects the missing
values, junk text, sentinels, outliers and out-of-order dates the operators
must handle. The SQL text is shared by Spark (DataFrames bound through
``spark.sql`` parameters, no global views) and by the DuckDB oracles (plain
table names), so both engines see the same rows.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from homestats.session import release, stored

BASE_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]

SOLD_SQL = """
SELECT CASE WHEN k%997=0 THEN NULL ELSE l_orderkey*10+l_linenumber END AS ListingKey,
 CASE WHEN p_type IN ('STANDARD','ECONOMY') THEN 'Residential' WHEN k%211=0 THEN NULL ELSE p_type END AS PropertyType,
 p_brand AS PropertySubType, s_name AS City,
 CASE WHEN k%53=0 THEN NULL ELSE n_name END AS CountyOrParish,
 CASE WHEN k%13=0 THEN NULL ELSE CAST(c_custkey AS STRING) END AS PostalCode,
 'CA' AS StateOrProvince,
 CASE WHEN k%19=0 THEN NULL ELSE c_name END AS UnparsedAddress,
 CASE WHEN k%97=0 THEN '0' WHEN k%101=0 THEN CAST(CAST(floor(l_extendedprice) AS BIGINT)*1000 AS STRING)
      WHEN k%103=0 THEN '$1,000' WHEN k%107=0 THEN NULL ELSE CAST(CAST(floor(l_extendedprice) AS BIGINT) AS STRING) END AS ClosePrice,
 CASE WHEN k%83=0 THEN 0.0E0 WHEN k%11=0 THEN floor(l_extendedprice) ELSE l_quantity*1000.0E0 END AS ListPrice,
 CASE WHEN k%89=0 THEN -1.0E0 WHEN k%499=0 THEN 1390000000.0E0 WHEN k%17=0 THEN NULL ELSE l_quantity*1050.0E0 END AS OriginalListPrice,
 CASE WHEN k%61=0 THEN 0.0E0 WHEN k%67=0 THEN -1.0E0 WHEN k%71=0 THEN NULL ELSE p_size*50.0E0 END AS LivingArea,
 CASE WHEN k%73=0 THEN NULL ELSE p_size/10.0E0 END AS LotSizeAcres,
 CASE WHEN k%79=0 THEN NULL ELSE CAST(1+p_size%6 AS INT) END AS BedroomsTotal,
 CAST(1+p_size%4 AS INT) AS BathroomsTotalInteger,
 CAST(1950+p_partkey%70 AS INT) AS YearBuilt,
 CAST(l_quantity AS INT)-3 AS DaysOnMarket,
 CAST(od AS STRING) AS ListingContractDate,
 CASE WHEN k%127=0 THEN NULL ELSE CAST(od + CAST(5*l_linenumber AS INT) AS STRING) END AS PurchaseContractDate,
 CASE WHEN k%113=0 THEN 'bad-date' WHEN k%131=0 THEN '01/06/2024' WHEN k%137=0 THEN NULL ELSE CAST(od + CAST(k%60-4 AS INT) AS STRING) END AS CloseDate,
 CAST(od AS STRING) || ' 10:00:00' AS StatusChangeTimestamp,
 CASE WHEN k%23=0 THEN 'n/a?' ELSE CAST(od AS STRING) || ' 23:15:00' END AS ModificationTimestamp,
 CASE WHEN k%41=0 THEN NULL WHEN k%43=0 THEN 0.0E0 ELSE 32.0E0+(c_custkey%100)/10.0E0 END AS Latitude,
 CASE WHEN k%37=0 THEN NULL WHEN k%43=0 THEN 0.0E0 WHEN k%47=0 THEN 118.0E0 ELSE -114.0E0-(c_custkey%110)/10.0E0 END AS Longitude,
 CASE WHEN k%50=0 THEN 2020 ELSE NULL END AS TaxYear,
 CASE WHEN k%9=0 THEN 1 ELSE NULL END AS FireplacesTotal,
 CAST(NULL AS STRING) AS BusinessType
FROM (SELECT *, l_orderkey*7+l_linenumber AS k, CAST(o_orderdate AS DATE) AS od
      FROM {lineitem} JOIN {orders} ON l_orderkey=o_orderkey JOIN {customer} ON o_custkey=c_custkey
      JOIN {nation} ON c_nationkey=n_nationkey JOIN {part} ON l_partkey=p_partkey JOIN {supplier} ON l_suppkey=s_suppkey) j
"""

LISTED_SQL = """
SELECT o_orderkey AS ListingKey,
 CASE WHEN o_orderpriority IN ('1-URGENT','2-HIGH') THEN 'Residential' ELSE o_orderpriority END AS PropertyType,
 n_name AS CountyOrParish, c_mktsegment AS City,
 CASE WHEN o_orderkey%29=0 THEN 0.0E0 WHEN o_orderkey%31=0 THEN 60000000.0E0 WHEN o_orderkey%37=0 THEN NULL ELSE o_totalprice END AS ListPrice,
 CASE WHEN o_orderkey%41=0 THEN -1.0E0 ELSE 500.0E0+o_custkey%3000 END AS LivingArea,
 CAST(CAST(o_orderdate AS DATE) AS STRING) AS ListingContractDate,
 CASE WHEN o_orderkey%5=0 THEN NULL ELSE CAST(CAST(o_orderdate AS DATE)+180 AS STRING) END AS ExpirationDate,
 CASE WHEN o_orderkey%7=0 THEN NULL ELSE 33.0E0+(c_custkey%80)/10.0E0 END AS Latitude,
 CASE WHEN o_orderkey%7=0 THEN NULL WHEN o_orderkey%173=0 THEN 117.0E0 ELSE -115.0E0-(c_custkey%90)/10.0E0 END AS Longitude,
 CASE WHEN o_orderkey%25=0 THEN 1 ELSE NULL END AS CoveredSpaces
FROM {orders} JOIN {customer} ON o_custkey=c_custkey JOIN {nation} ON c_nationkey=n_nationkey
"""

RATES_SQL = """
SELECT CAST(o_orderdate AS DATE) AS observation_date,
 CASE WHEN min(o_orderkey)%13=0 THEN '.' ELSE CAST((20+min(o_orderkey)%41)/10.0E0 AS STRING) END AS MORTGAGE30US
FROM {orders} WHERE EXTRACT(DAY FROM CAST(o_orderdate AS DATE)) IN (4,11,18,25)
 AND NOT (EXTRACT(YEAR FROM CAST(o_orderdate AS DATE))=1997 AND EXTRACT(MONTH FROM CAST(o_orderdate AS DATE))=7)
GROUP BY CAST(o_orderdate AS DATE)
"""

RELATION_SQL = {"sold": SOLD_SQL, "listed": LISTED_SQL, "rates": RATES_SQL}


def base_tables(spark: SparkSession, sf_dir: str, names=tuple(BASE_TABLES)) -> dict[str, DataFrame]:
    """Lazy parquet scans of the named driver tables (pruning/pushdown left to Catalyst)."""
    return {t: spark.read.parquet(f"{sf_dir.rstrip('/')}/{t}.parquet") for t in names}


def relation(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One derived relation (``sold``, ``listed`` or ``rates``) as a lazy DataFrame."""
    used = [t for t in BASE_TABLES if f"{{{t}}}" in RELATION_SQL[name]]  # only these are opened
    tables = base_tables(spark, sf_dir, used)
    return spark.sql(RELATION_SQL[name], **tables)


#: What the two large relations are selected from.
_JOINS = {
    "sold": """{lineitem} JOIN {orders} ON l_orderkey=o_orderkey JOIN {customer} ON o_custkey=c_custkey
      JOIN {nation} ON c_nationkey=n_nationkey JOIN {part} ON l_partkey=p_partkey JOIN {supplier} ON l_suppkey=s_suppkey""",
    "listed": "{orders} JOIN {customer} ON o_custkey=c_custkey JOIN {nation} ON c_nationkey=n_nationkey",
}


def joined_rows(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The joined rows of ``sold`` or ``listed``, as a table of just the base columns that the relation is computed from.

    These are some 60 bytes a row instead of the relation's 150. The joins run in two jobs, so that their shuffles
    don't lie on the disks together, and lines meet their orders last: customers never move with lines, and
    what is alike (an order's lines) lies side by side.
    """
    t = base_tables(spark, sf_dir, [t for t in BASE_TABLES if f"{{{t}}}" in _JOINS[name]])
    text = RELATION_SQL[name].replace(_JOINS[name], "")

    def needed(df: DataFrame) -> DataFrame:
        return df.select(*[c for c in df.columns if re.search(rf"\b{c}\b", text)])

    o, c, n = t["orders"], t["customer"], t["nation"]
    orders = o.join(c, o["o_custkey"] == c["c_custkey"]).join(n, c["c_nationkey"] == n["n_nationkey"])
    if name == "listed":
        return stored(needed(orders), "listed-rows")
    line, p, s = t["lineitem"], t["part"], t["supplier"]
    items = stored(needed(line.join(p, line["l_partkey"] == p["p_partkey"]).join(s, line["l_suppkey"] == s["s_suppkey"])), "sold-items")
    rows = stored(needed(items.join(orders, items["l_orderkey"] == o["o_orderkey"])), "sold-rows")
    release(items)
    return rows


def relation_of(rows: DataFrame, name: str) -> DataFrame:
    """``sold`` or ``listed`` from its ``joined_rows``, by the relation's own SQL."""
    return rows.sparkSession.sql(RELATION_SQL[name].replace(_JOINS[name], "{joined}"), joined=rows)


def oracle_cte(*names: str) -> str:
    """``WITH`` clause defining the relations for the DuckDB oracle."""
    plain = {t: t for t in BASE_TABLES}
    parts = [f"{n} AS ({RELATION_SQL[n].format(**plain).strip()})" for n in names]
    return "WITH " + ",\n".join(parts) + "\n"
