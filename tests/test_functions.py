"""Coercion, rounding, quantile and histogram goldens."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from homestats.functions.coerce import as_date, as_number, as_timestamp, flag, round_half_even
from homestats.operators.distribution import boxplot_stats, histogram
from homestats.operators.quantiles import exact_quantiles, quantile_columns


def test_number_coercion(spark):
    vals = ["5", " 7.5 ", "$5", "1d", "NaN", "inf", "1e3", "-2", ".5", "", None, "1,000"]
    df = spark.createDataFrame([(v,) for v in vals], "x string")
    got = [r[0] for r in df.select(as_number(df, "x")).collect()]
    assert got == [5.0, 7.5, None, None, None, None, 1000.0, -2.0, 0.5, None, None, None]


def test_number_coercion_of_numeric_nan(spark):
    df = spark.createDataFrame([(float("nan"),), (1.0,)], "x double")
    assert [r[0] for r in df.select(as_number(df, "x")).collect()] == [None, 1.0]


def test_absent_column_is_null(spark):
    df = spark.createDataFrame([(1,)], "a int")
    r = df.select(as_number(df, "zz").alias("n"), as_date(df, "zz").alias("d"), as_timestamp(df, "zz").alias("t")).first()
    assert (r["n"], r["d"], r["t"]) == (None, None, None)


def test_date_coercion(spark):
    df = spark.createDataFrame([("2024-01-05",), ("bad-date",), ("01/06/2024",), (None,), ("2024-01-05 10:00:00",)], "x string")
    got = [str(r[0]) if r[0] else None for r in df.select(as_date(df, "x")).collect()]
    assert got == ["2024-01-05", None, None, None, "2024-01-05"]


def test_flag_never_null(spark):
    df = spark.createDataFrame([(None,), (1.0,), (-1.0,)], "x double")
    assert [r[0] for r in df.select(flag(F.col("x") <= 0)).collect()] == [0, 0, 1]


def test_half_even_rounding(spark):
    df = spark.createDataFrame([(0.05,), (0.15,), (0.25,), (90.05,), (45.19875,)], "x double")
    got = [r[0] for r in df.select(round_half_even(F.col("x"), 1)).collect()]
    assert got == [0.0, 0.2, 0.2, 90.0, 45.2]
    assert df.select(round_half_even(F.col("x"), 4)).collect()[4][0] == float(np.round(45.19875, 4))


@pytest.mark.parametrize("method", ["bracketed", "distributed", "in_task"])
def test_quantile_goldens(spark, method):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,), (10.0,), (None,)], "v double")
    probs = [0.05, 0.25, 0.5, 0.75, 0.95, 0.99]
    got = {r["p"]: r["q"] for r in exact_quantiles(df, "v", probs, method=method).collect()}
    assert [got[p] for p in probs] == pytest.approx([1.2, 2, 3, 4, 8.8, 9.76])
    std = df.agg(F.stddev_samp("v")).first()[0]
    assert std == pytest.approx(3.5355339059)


@pytest.mark.parametrize("method", ["bracketed", "distributed", "in_task"])
def test_quantiles_match_numpy_with_hot_group(spark, method):
    rng = np.random.default_rng(7)
    # one group holds a third of the rows and spans many range chunks
    groups = np.concatenate([np.full(3000, "hot"), rng.choice(list("abcdefgh"), 6000)])
    values = np.round(rng.lognormal(10, 1, groups.size), 0)
    values[rng.choice(values.size, 200, replace=False)] = np.nan
    pdf = pd.DataFrame({"g": groups, "v": values})
    df = spark.createDataFrame(pdf).withColumn("v", F.nanvl("v", F.lit(None).cast("double")))
    probs = [0.0, 0.05, 0.25, 0.5, 0.9, 0.99, 1.0]
    got = {(r["g"], r["p"]): r["q"]
           for r in exact_quantiles(df, "v", probs, ["g"], num_chunks=16, method=method).collect()}
    for g, sub in pdf.dropna().groupby("g"):
        for p in probs:
            assert got[(g, p)] == pytest.approx(float(sub["v"].quantile(p)), rel=1e-12), (g, p)


@pytest.mark.parametrize("method", ["bracketed", "distributed", "in_task"])
def test_quantile_single_value_and_empty_group(spark, method):
    df = spark.createDataFrame([("a", 5.0), ("b", None)], "g string, v double")
    out = {r["g"]: r["med"] for r in quantile_columns(df, "v", {"med": 0.5}, ["g"], method=method).collect()}
    assert out == {"a": 5.0}


def test_chunks_hold_a_bounded_number_of_pairs(spark):
    from homestats.operators.quantiles import chunk_table

    df = spark.range(1000).selectExpr("CAST(id AS DOUBLE) AS v")
    sizes = [r["count"] for r in chunk_table(df, "v", [], chunk_rows=50).groupBy("_q_pid").count().collect()]
    assert sum(sizes) == 1000 and max(sizes) <= 100  # ranges come from a sample


def test_dates_with_formats_and_junk(spark):
    from homestats.functions.coerce import as_date, as_number, as_timestamp

    rows = [("2024-01-05",), ("01/15/2024",), ("2024-01-05 xyz",), ("2024-01-05Tfoo",), (" 2024-1-5 ",), ("2024-01-05 10:00:00",), (None,)]
    df = spark.createDataFrame(rows, "d string")
    day = lambda *a: [str(r[0]) for r in df.select(as_date(df, "d", *a)).collect()]
    assert day() == ["2024-01-05", "None", "None", "None", "2024-01-05", "2024-01-05", "None"]
    assert day(["MM/dd/yyyy"])[1] == "2024-01-15"
    assert str(df.select(as_timestamp(df, "d", ["MM/dd/yyyy"])).collect()[1][0]) == "2024-01-15 00:00:00"
    n = spark.createDataFrame([("1e400",), ("-1e400",), ("1e3",)], "n string")
    assert [r[0] for r in n.select(as_number(n, "n")).collect()] == [None, None, 1000.0]
    x = spark.createDataFrame([(float("inf"),), (float("nan"),), (2.0,)], "n double")
    assert [r[0] for r in x.select(as_number(x, "n")).collect()] == [None, None, 2.0]


def test_histogram_golden(spark):
    df = spark.createDataFrame([(float(x),) for x in range(5)], "v double")
    rows = histogram(df, "v", bins=4, clip_q=1.0).orderBy("bin").collect()
    assert [r["n"] for r in rows] == [1, 1, 1, 2]
    assert rows[0]["lower"] == 0.0 and rows[-1]["upper"] == 4.0


def test_histogram_constant_and_counts_sum(spark):
    df = spark.createDataFrame([(3.0,)] * 4 + [(None,)], "v double")
    rows = histogram(df, "v", bins=60).collect()
    assert sum(r["n"] for r in rows) == 4 and len(rows) == 60


def test_boxplot_matches_numpy(spark):
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(100, 10, 500), [400.0, 500.0, -300.0]])
    df = spark.createDataFrame([(float(v),) for v in x], "v double")
    r = boxplot_stats(df, ["v"], clip_q=1.0).first()
    q1, med, q3 = np.percentile(x, [25, 50, 75])
    iqr = q3 - q1
    assert r["q1"] == pytest.approx(q1, abs=1e-4) and r["q3"] == pytest.approx(q3, abs=1e-4)
    assert r["whisker_low"] == pytest.approx(x[x >= q1 - 1.5 * iqr].min())
    assert r["whisker_high"] == pytest.approx(x[x <= q3 + 1.5 * iqr].max())
    assert r["n_outliers"] == int(((x < q1 - 1.5 * iqr) | (x > q3 + 1.5 * iqr)).sum())
    assert not math.isnan(r["median"])


def test_typed_table(spark):
    from homestats.functions.coerce import typed_table

    df = spark.createDataFrame([("5", "2024-01-02", "2024-01-02 10:00:00", "x")], "a string, d string, t string, s string")
    out = typed_table(df, numeric=["a", "zz"], dates=["d"], timestamps=["t"])
    assert [f.dataType.simpleString() for f in out.schema.fields] == ["double", "date", "timestamp", "string"]
    assert out.first()["a"] == 5.0


def test_hot_group_is_spread_over_chunks(spark):
    """A group with a third of all rows spans many chunks; no chunk exceeds ~2x its share."""
    from homestats.operators.quantiles import chunk_table

    df = spark.range(30000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('g', CAST(id % 50 AS STRING)) END AS g",
        "CAST(id AS DOUBLE) AS v")
    ranked = chunk_table(df, "v", ["g"], 16)
    per_chunk = {r["_q_pid"]: r["n"] for r in ranked.groupBy("_q_pid").count().withColumnRenamed("count", "n").collect()}
    hot_chunks = ranked.where("g = 'hot'").select("_q_pid").distinct().count()
    assert hot_chunks >= 4
    assert max(per_chunk.values()) <= 2 * 30000 / 16


def test_quantiles_survive_a_failed_task(spark, monkeypatch):
    """A chunk task that dies on its first attempt is retried; results are unchanged."""
    import homestats.operators.quantiles as Q

    original = Q._running_count()

    def flaky(batches):
        from pyspark import TaskContext

        ctx = TaskContext.get()
        if ctx.partitionId() == 1 and ctx.attemptNumber() == 0:
            raise RuntimeError("injected task failure")
        yield from original(batches)

    monkeypatch.setattr(Q, "_running_count", lambda: flaky)
    rng = np.random.default_rng(11)
    vals = rng.integers(0, 1000, 5000).astype(float)
    df = spark.createDataFrame([(float(v),) for v in vals], "v double")
    got = {r["p"]: r["q"] for r in Q.exact_quantiles(df, "v", [0.1, 0.5, 0.9], num_chunks=8, method="distributed").collect()}
    for p in (0.1, 0.5, 0.9):
        assert got[p] == pytest.approx(float(np.quantile(vals, p)))


def test_approx_quantiles_within_rank_error(spark):
    rng = np.random.default_rng(5)
    vals = rng.normal(0, 1, 20000)
    df = spark.createDataFrame([(float(v),) for v in vals], "v double")
    got = {r["p"]: r["q"] for r in exact_quantiles(df, "v", [0.1, 0.5, 0.9], method="approx").collect()}
    ordered = np.sort(vals)
    for p, q in got.items():
        rank = np.searchsorted(ordered, q) / len(vals)
        assert abs(rank - p) <= 0.002


def test_bracketed_quantiles_of_large_groups(spark):
    """Every way through the brackets equals numpy, with a hot group, ties, and groups of null and small size."""
    rng = np.random.default_rng(3)
    groups = np.concatenate([np.full(40000, "hot"), np.full(30000, "tied"), rng.choice(list("abcd"), 3000)])
    values = rng.lognormal(10, 1, groups.size)
    values[40000:70000] = rng.choice([1.0, 2.0, 3.0], 30000, p=[0.25, 0.25, 0.5])
    pdf = pd.DataFrame({"g": groups, "v": values})
    df = spark.createDataFrame(pdf).withColumn("g", F.when(F.col("g") != "d", F.col("g")))
    probs = [0.99, 0.0, 0.25, 0.5, 0.75, 1.0]
    want = {(None if g == "d" else g, p): float(x["v"].quantile(p)) for g, x in pdf.groupby("g") for p in probs}
    for limits in ({}, {"small_group": 100}, {"gathered": 10}, {"large_groups": 1}, {"small_group": 0, "gathered": 0}):
        out = exact_quantiles(df, "v", probs, ["g"], bounds=True, **limits).collect()
        got = {(r["g"], r["p"]): r["q"] for r in out}
        assert len(out) == len(want) and got == pytest.approx(want, rel=1e-12), limits
        assert all(r["lo"] <= r["q"] <= r["hi"] for r in out)
    hot = df.where("g = 'hot'").drop("g")
    for limits in ({}, {"gathered": 10}):
        got = {r["p"]: r["q"] for r in exact_quantiles(hot, "v", probs, **limits).collect()}
        assert got == pytest.approx({p: want[("hot", p)] for p in probs}, rel=1e-12)


def test_a_wrong_sketch_does_not_change_quantiles(spark, monkeypatch):
    """Where a found value lies in no bracket, the group is ranged whole."""
    import homestats.operators.quantiles as Q

    monkeypatch.setattr(Q.F, "percentile_approx", lambda c, at, accuracy: F.array(*[F.lit(10.0 * p) for p in at]))
    df = spark.range(3000).selectExpr("id % 2 AS g", "CAST(id AS DOUBLE) AS v")
    got = {(r["g"], r["p"]): r["q"] for r in Q.exact_quantiles(df, "v", [0.5, 0.9], ["g"], small_group=100).collect()}
    want = {(g, p): float(np.quantile(np.arange(g, 3000, 2), p)) for g in (0, 1) for p in (0.5, 0.9)}
    assert got == pytest.approx(want)


def test_brackets_keep_most_values_from_the_shuffle(spark):
    """A large group shuffles counters and the values near its quantiles; no table is written for it."""
    import homestats.operators.quantiles as Q

    written = []
    df = spark.range(200000).selectExpr("CAST(id * 7919 % 200003 AS DOUBLE) AS v")
    original, Q.scratch_path = Q.scratch_path, lambda *a: written.append(a)
    try:
        got = {r["p"]: r["q"] for r in Q.exact_quantiles(df, "v", [0.25, 0.5]).collect()}
    finally:
        Q.scratch_path = original
    ordered = np.sort(np.arange(200000) * 7919 % 200003)
    assert got == {p: float(np.quantile(ordered, p)) for p in (0.25, 0.5)} and not written
