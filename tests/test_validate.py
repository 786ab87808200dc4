"""The validation table reads its input three times, whatever its checks; empty tables and null keys have results."""

from pyspark.sql import functions as F

from homestats.functions import fields as FD
from homestats.operators import validate as VA
from homestats.operators.profile import numeric_stats, top_k, value_counts


def test_three_scans(spark, golden):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    df = golden.withColumn("City", F.col("CountyOrParish")).withColumn("PropertySubType", F.lit("Condo"))
    n = df.count()
    VA.validate_dataset(df.mapInArrow(count, df.schema), "CloseDate").collect()
    assert n < seen.value <= 3 * n


def test_checks_equal_the_profiles(spark, golden):
    df = golden.withColumn("City", F.concat("CountyOrParish", F.lit("ville"))).withColumn("PropertySubType", F.col("CountyOrParish"))
    rows = VA.validate_dataset(df, "CloseDate", k=2).collect()
    got = {(r["check"], r["field"], r["detail"]): r["value"] for r in rows}
    for r in numeric_stats(df).collect():
        for name in ("count", "min", "p25", "median", "p75", "max", "mean", "std"):
            assert got["numeric_" + name, r["field"], None] == r[name]
    for r in value_counts(df, "PropertySubType").collect():
        assert (got["subtype", "PropertySubType", r["value"]], got["subtype_pct", "PropertySubType", r["value"]]) == (r["n"], r["pct"])
    for col in ("City", "CountyOrParish"):
        top = top_k(df, col, 2).collect()
        assert {d: v for (c, f, d), v in got.items() if c == "top" and f == col} == {r["value"]: r["n"] for r in top}
    dup = VA.duplicate_check(df).first()
    assert got["duplicates", FD.KEY_COLUMN, None] == dup["duplicates"]


def test_empty_table(spark, golden):
    rows = VA.validate_dataset(golden.limit(0), "CloseDate").collect()
    got = {r["check"]: (r["status"], r["value"]) for r in rows}
    assert got["rows"] == ("INFO", 0.0) and got["duplicates"] == ("PASS", 0.0)
    assert not [r for r in rows if r["check"].startswith(("month_", "numeric_", "top", "subtype"))]
