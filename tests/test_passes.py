"""Queries that pass over their rows several times derive them once; exports are gzipped and read like plain ones."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from homestats.operators import distribution as DI
from homestats.operators import market as MK
from homestats.operators import profile as PR
from homestats.operators import validate as VA
from homestats.sources import files as FI
from homestats.sources import tables as TB


def _counted(spark, df):
    """``df`` and a counter of the rows that are derived for it."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    return df.mapInArrow(count, df.schema), seen


@pytest.mark.parametrize("name, query", [
    ("numeric_stats", PR.numeric_stats), ("numeric_distribution", PR.numeric_distribution),
    ("compact_stats", lambda df: PR.compact_stats(df, "CountyOrParish")), ("histograms", DI.histograms), ("boxplot_stats", DI.boxplot_stats),
    ("close_price_summary", MK.close_price_summary), ("top_groups_by_median", lambda df: MK.top_groups_by_median(df, min_n=1)),
    ("validate_dataset", lambda df: VA.validate_dataset(VA.stored_input(df, "CloseDate"), "CloseDate")),
])
def test_rows_are_derived_once(spark, golden, name, query):
    df, seen = _counted(spark, golden)
    got = query(df).collect()
    assert seen.value == golden.count()
    assert sorted(map(str, got)) == sorted(map(str, query(golden).collect()))


def test_a_source_of_no_type(spark, golden):
    rows = PR.compact_stats(golden.withColumn("source", F.lit(None)), "source", ["ListPrice"]).collect()
    assert [(r["source"], r["nulls"], r["max"]) for r in rows] == [(None, 1, 300.0)]


def test_marks_keep_nulls_and_columns(spark):
    df = spark.createDataFrame([(1, "a", None), (None, "b", "x")], "n int, t string, u string")
    out = PR.value_or_mark(df, ["n"])
    assert out.columns == df.columns
    assert [tuple(r) for r in out.collect()] == [(1, True, None), (None, True, True)]


def test_gzipped_exports_are_read_like_plain_ones(spark, tmp_path):
    rows = [(str(i), "Multi\nLine" if i % 7 == 0 else f'a "{i}", b', f"20240{1 + i % 2}") for i in range(200)]
    df = spark.createDataFrame(rows, "ListingKey string, City string, source string").withColumn("source", F.concat(F.lit("ExportSold"), "source"))
    found = []
    for codec in (None, "gzip"):
        at = TB.write_table(df.repartition("source"), str(tmp_path / str(codec)), "csv", partition_by=["source"], compression=codec)
        assert {r["source"] for r in FI.list_sources(spark, at, recursive=True).collect()} == {"source=ExportSold202401", "source=ExportSold202402"}
        over = FI.file_overview(spark, at, recursive=True).select("class", "source", "rows", "parsed_rows", "columns")
        t = TB.read_table(spark, at, recursive=True).select("ListingKey", "City", FI.source_name(F.col("source_path")).alias("s"))
        found.append((sorted(map(str, over.collect())), sorted(map(tuple, t.collect()))))
    assert found[0] == found[1] and len(found[0][1]) == 200


def test_names_of_gzipped_files(spark):
    paths = ["file:/d/ExportSold202401.csv", "file:/d/ExportSold202401.csv.gz", "file:/d/source=ExportSold202402/part-0.csv.gz"]
    got = spark.createDataFrame([(p,) for p in paths], "path string").select(FI.source_name(F.col("path"))).collect()
    assert [r[0] for r in got] == ["ExportSold202401", "ExportSold202401", "source=ExportSold202402"]


def test_monthly_exports_are_gzipped(spark):
    from homestats.plans.filequeries import export_monthly
    from homestats.plans.relations import Relations

    root = export_monthly(Relations(spark, "/root/testdata/sf0.001"), ["listed"]).removeprefix("file:")
    files = [p for p in glob.glob(f"{root}/listed/source=*/*") if os.path.basename(p).startswith("part-")]
    assert files and all(p.endswith(".csv.gz") for p in files)
