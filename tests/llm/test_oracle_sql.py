"""The queries with SQL against DuckDB on sf0.001, and the list of registered ones."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from homestats.llm.catalog import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


def _norm(v):
    return "nan" if isinstance(v, float) and math.isnan(v) else repr(v)


def test_all_are_registered():
    names = set(E.queries())
    assert set(QUERIES) | {"pipeline"} <= names and set(ORACLES) <= set(E.oracle_sql())
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = E.queries()[name](spark, SF)
    rows = df.collect()
    res = con.execute(ORACLES[name])
    columns = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(columns)
    got = sorted(tuple(_norm(r[c]) for c in sorted(columns)) for r in rows)
    want = sorted(tuple(_norm(r[columns.index(c)]) for c in sorted(columns)) for r in res.fetchall())
    assert got == want
