"""What steps keep on disk: shuffle files and intermediate tables go when nothing reads them any more."""

import datetime
import glob
import time

import pytest
from pyspark.sql import functions as F

from homestats.llm.common import materialize
from homestats.llm.components import connected_components
from homestats.plans import filequeries as FQ
from homestats.plans import relations as RL
from homestats.session import ensure_checkpoint_dir, release, shuffles_removed, stored
from homestats.sources import tables as TB
from homestats.sources.testrel import joined_rows, relation, relation_of


def _shuffle_files(spark) -> set[str]:
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n")
    return {f for f in files.split("\n") if "/shuffle_" in f}


def _kept(spark, name: str) -> list[str]:
    return glob.glob(f"{ensure_checkpoint_dir(spark).removeprefix('file:')}/homestats-{name}-*")


@pytest.mark.parametrize("write", [stored, materialize])
def test_written_tables_leave_no_shuffle_files(spark, write):
    before = _shuffle_files(spark)
    df = spark.range(1000).repartition(3, "id").groupBy((F.col("id") % 7).alias("k")).count()
    table = write(df, "counted")
    until = time.time() + 20
    while (new := _shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.2)
    assert not new
    assert table.count() == 7


def test_the_setting_is_put_back(spark):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    with pytest.raises(ZeroDivisionError), shuffles_removed(spark):
        assert spark.conf.get(key) == "true"
        1 / 0
    assert spark.conf.get(key, None) == before


def test_released_tables_are_gone(spark):
    t = stored(spark.range(3), "to-release")
    assert len(_kept(spark, "to-release")) == 1
    release(t)
    assert not _kept(spark, "to-release")


def test_components_keep_the_last_round(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)], "a long, b long")
    rows = connected_components(edges, "chain").collect()
    assert {tuple(r) for r in rows} == {(i, 0) for i in range(41)}
    assert len(_kept(spark, "chain")) == 1


@pytest.fixture(scope="module")
def base(spark, tmp_path_factory):
    """Base tables of our own, with nulls, missing partners and repeated rows."""
    at = str(tmp_path_factory.mktemp("base"))
    day = datetime.datetime(1996, 1, 20)
    orders = [(i, i % 9, "O", 1000.0 + i, None if i == 5 else day + datetime.timedelta(days=11 * i), ["1-URGENT", "5-LOW"][i % 2]) for i in range(60)]
    lines = [(o, (o * 3 + n) % 13, (o + n) % 5, n, float(n * 2), 900.0 + o + n) for o in range(62) for n in range(1, 4)]
    lines += [lines[3], (None, 1, 1, 1, 1.0, 1.0), (7, None, 1, 9, 2.0, 3.0), (8, 1, 1, None, None, None)]
    tables = {
        "orders": (orders + [orders[4], (None, 1, "O", 1.0, day, None), (61, None, "O", 2.0, day, "5-LOW")],
                   "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string"),
        "customer": ([(i, f"Customer#{i}", i % 3, "BUILDING") for i in range(8)] + [(None, "x", 1, None)],
                     "c_custkey long, c_name string, c_nationkey int, c_mktsegment string"),
        "nation": ([(i, f"NATION_{i}", 0) for i in range(3)], "n_nationkey int, n_name string, n_regionkey int"),
        "part": ([(i, ["STANDARD", "PROMO"][i % 2], f"Brand#{i}", i) for i in range(12)] + [(2, "SMALL", "Brand#2b", 5)],
                 "p_partkey long, p_type string, p_brand string, p_size int"),
        "supplier": ([(i, f"Supplier#{i}", 0) for i in range(5)], "s_suppkey long, s_name string, s_nationkey int"),
        "lineitem": (lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{at}/{name}.parquet")
    return at


def _rows(df) -> list[str]:
    return sorted(str(r.asDict()) for r in df.collect())


@pytest.mark.parametrize("name", ["sold", "listed"])
def test_joined_rows_give_the_relation(spark, base, name):
    rows = joined_rows(spark, base, name)
    want = relation(spark, base, name)
    out = relation_of(rows, name)
    assert out.dtypes == want.dtypes
    assert _rows(out) == _rows(want) and out.count() > 50
    assert len(rows.columns) < len(want.columns)


@pytest.mark.parametrize("parts", [1, 3])
def test_exports_hold_all_rows_and_nothing_else_stays(spark, base, monkeypatch, parts):
    monkeypatch.setattr(RL, "DEALT_PARTS", parts)
    monkeypatch.setattr(RL, "DEALT_ROWS", 10)
    monkeypatch.setattr(FQ, "EXPORT_ROWS", 4)
    kept = {n: _kept(spark, n) for n in ("sold-items", "sold-rows", "listed-rows")}
    root = FQ.export_monthly(RL.Relations(spark, base))
    for name in ("sold", "listed"):
        want = relation(spark, base, name)
        got = TB.read_table(spark, f"{root}/{name}", recursive=True)
        shown = [c for c in want.columns if dict(want.dtypes)[c] in ("string", "bigint", "int")]
        assert _rows(got.select(shown)) == _rows(want.select([F.col(c).cast("string") for c in shown]))
        files = got.groupBy("source_path").count()
        assert files.agg(F.max("count")).first()[0] <= 4
        months = got.groupBy("source_path").agg(F.count_distinct(F.substring("ListingContractDate", 1, 7)).alias("n"))
        assert months.agg(F.max("n")).first()[0] == 1
    assert {n: _kept(spark, n) for n in kept} == kept
