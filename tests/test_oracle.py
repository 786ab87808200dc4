"""Oracle parity: every registered query against its DuckDB SQL on sf0.001."""

import datetime
import decimal
import math

import duckdb
import pytest

import __spark_entry__ as E
from homestats.plans import filequeries  # noqa: F401  (registers the file-side queries)
from homestats.plans.catalog import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9))
    if isinstance(v, decimal.Decimal):
        return repr(round(float(v), 9))
    if isinstance(v, (datetime.date, datetime.datetime)):
        return str(v)
    if isinstance(v, (list, tuple)):
        return str([_norm(x) for x in v])
    return repr(v)


_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLES) <= set(E.oracle_sql())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["CountyOrParish", "median_price", "transactions"]
    assert df.count() >= 0


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    rows, cols = df.collect(), df.columns
    res = con.execute(ORACLES[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(cols) == sorted(ocols)
    spark_types = {f.name: _TYPES.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
    oracle_types = {d[0]: str(d[1]) for d in res.description}
    assert spark_types == oracle_types
    si = [cols.index(c) for c in sorted(cols)]
    oi = [ocols.index(c) for c in sorted(ocols)]
    a = sorted(tuple(_norm(r[i]) for i in si) for r in rows)
    b = sorted(tuple(_norm(r[i]) for i in oi) for r in orows)
    assert a == b
