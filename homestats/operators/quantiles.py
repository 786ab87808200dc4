"""Exact, distributed quantiles (linear interpolation between order statistics).

Spark's ``percentile`` aggregate merges a value->count map of *every distinct
value of a group* inside one task, and a global percentile does so for the
whole column. With a hot group (a county holding a third of all rows) that
task's memory grows with the data. The default way, ``bracketed``, selects the order
statistics between bounds instead and writes no table:

1. One aggregate gives each group's number of values and, from a mergeable sketch, two
   values around each wanted quantile whose ranks are sure to lie on either side of it.
2. Groups of up to ``SMALL_GROUP`` values are sorted whole, an array each.
3. Larger groups (few by nature: their brackets are collected up to ``LARGE_GROUPS`` of
   them and broadcast) are read once more. Values between brackets become one counter per gap
   already on the map side, so a hot group shuffles counters and the share
   ``4 / SKETCH`` of its values per quantile. A running count over these gives the ranks.
4. What was found is checked to lie in its bracket. A group where a sketch was wrong
   takes the ranged way below, so results never depend on the sketch.

The ``distributed`` way ranges all distinct values, whatever the groups are like; the
bracketed one falls back to it for more than ``LARGE_GROUPS`` large groups, and ranges what
lies in the brackets where that is more than ``GATHERED`` values of a group:

1. ``groupBy(group, value).count()`` — map-side combined, shuffled on the
   pair, so a hot group is spread over many reducers.
2. ``repartitionByRange`` on ``(group, value)`` — equal-sized, ordered chunks;
   a hot group simply spans many chunks.
3. A running row count inside each chunk (a vectorised ``mapInArrow``
   helper, no per-row Python), and the chunk id. The result is written to the
   shared checkpoint folder, which cuts lineage and pins chunk ids.
4. Chunk totals per group (at most ``chunks + groups`` rows) give each chunk's
   starting rank; the wanted ranks ``floor((n-1)p)`` and the next one are then
   located in exactly one chunk each.
5. Join the few wanted ranks back on ``(chunk, group)`` — a key that never
   holds more than one chunk of rows — and interpolate.

All ways give the same rows. Null values are ignored; groups with no values produce no rows.
A caller who knows its groups to be small may ask for ``method="in_task"``.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from homestats.session import scratch_path

_V, _N, _PID, _PCUM = "_q_v", "_q_n", "_q_pid", "_q_pcum"

# Distinct (group, value) rows of one chunk: what a task sorts and counts at a time.
CHUNK_ROWS = 1_000_000

# The sketch tells ranks to n / SKETCH; brackets reach twice as far.
SKETCH = 5_000
# A task sorts a group of up to so many values whole.
SMALL_GROUP = 4 * SKETCH
# Brackets of at most so many larger groups are collected and broadcast.
LARGE_GROUPS = 10_000
# Values in the brackets of one group that a single task may rank.
GATHERED = 1_000_000

_TOTAL, _CUTS, _AT = "_q_total", "_q_cuts", "_q_at"


def _in_task_quantiles(df: DataFrame, value: str, probs: list[float], by: list[str],
                       prob_col: str, out_col: str) -> DataFrame:
    """Built-in ``percentile`` per group: a task holds all distinct values of a group."""
    qs = (
        df.where(F.col(value).isNotNull())
        .groupBy(*by)
        .agg(F.percentile(F.col(value).cast("double"), F.array(*[F.lit(p) for p in probs])).alias("_qs"))
    )
    plist = F.array(*[F.lit(p) for p in probs])
    return qs.select(*by, F.posexplode("_qs").alias("_pos", out_col)).select(
        *by, F.element_at(plist, F.col("_pos") + 1).alias(prob_col), F.col(out_col)
    )


def _running_count():
    """The per-chunk batch function: chunk id and running row count over one
    range-partitioned, sorted chunk.

    Built as a closure so it is shipped to the Python workers by value: the
    executors need no copy of this package.
    """
    n_col, pid_col, pcum_col = _N, _PID, _PCUM

    def run_chunk(batches):
        import pyarrow as pa
        import pyarrow.compute as pc
        from pyspark import TaskContext

        pid, carry = TaskContext.get().partitionId(), 0
        for batch in batches:
            if not batch.num_rows:
                continue
            counts = batch.column(n_col).cast(pa.int64())
            run = pc.add(pc.cumulative_sum(counts), carry)
            carry = run[-1].as_py()
            pids = pa.array([pid], pa.int32()).take(pa.array([0] * batch.num_rows))
            yield pa.RecordBatch.from_arrays([*batch.columns, pids, run], names=[*batch.schema.names, pid_col, pcum_col])

    return run_chunk


def _values(df: DataFrame, value: str, by: list[str]) -> DataFrame:
    return df.select(*by, F.col(value).cast("double").alias(_V)).where(F.col(_V).isNotNull())


def chunk_table(df: DataFrame, value: str, by: Sequence[str], chunks: int | None = None,
                chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Steps 1-3: distinct ``(group, value, n)`` rows in ordered chunks with the chunk
    id and the running count, written to the shared checkpoint folder and read back.

    The pairs are written first, so that finding the ranges and dealing rows out to
    them doesn't compute the input twice. There is a chunk per ``chunk_rows`` pairs,
    or a chunk per shuffle partition if those are more; both only set the number
    of tasks. Two jobs run here.
    """
    by = list(by)
    pairs = _values(df, value, by).groupBy(*by, _V).agg(F.count(F.lit(1)).alias(_N))
    return _chunked(pairs, by, chunks, chunk_rows)


def _chunked(pairs: DataFrame, by: list[str], chunks: int | None, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """``chunk_table`` of counted values ``(*by, value, n)``."""
    spark = pairs.sparkSession
    stored_path = scratch_path(spark, "quantile-pairs")
    pairs.write.parquet(stored_path)
    stored = spark.read.schema(pairs.schema).parquet(stored_path)
    if chunks is None:
        chunks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-stored.count() // chunk_rows))
    ordered = stored.repartitionByRange(chunks, *by, _V).sortWithinPartitions(*by, _V)
    out_schema = T.StructType(
        list(pairs.schema.fields)
        + [T.StructField(_PID, T.IntegerType(), False), T.StructField(_PCUM, T.LongType(), False)]
    )
    path = scratch_path(spark, "quantile")
    ordered.mapInArrow(_running_count(), out_schema).write.parquet(path)
    return spark.read.schema(out_schema).parquet(path)


def _ranged(ranked: DataFrame, probs: list[float], by: list[str], prob_col: str) -> DataFrame:
    """Steps 4 and 5: ``(*by, p, lo, hi, frac)`` from a chunk table."""
    # Per (chunk, group): rows in the chunk and the running count where it starts.
    seg = ranked.groupBy(_PID, *by).agg(
        F.sum(_N).alias("_seg_n"), F.min(F.col(_PCUM) - F.col(_N)).alias("_seg_start")
    )
    by_group = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    seg = seg.withColumn(
        "_off",
        F.coalesce(
            F.sum("_seg_n").over(by_group.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0),
        ),
    ).withColumn("_total", F.sum("_seg_n").over(by_group))

    pos = (F.col("_total") - 1).cast("double") * F.col(prob_col)
    lo = F.floor(pos).cast("long")
    targets = (
        seg.withColumn(prob_col, F.explode(F.array(*[F.lit(p) for p in probs])))
        .withColumn("_frac", pos - F.floor(pos))
        .withColumn(
            "_want",
            F.explode(
                F.array(
                    F.struct(F.lit(0).alias("side"), lo.alias("rank")),
                    F.struct(F.lit(1).alias("side"), F.least(lo + 1, F.col("_total") - 1).alias("rank")),
                )
            ),
        )
        .where((F.col("_want.rank") >= F.col("_off")) & (F.col("_want.rank") < F.col("_off") + F.col("_seg_n")))
        # position of the wanted rank on the chunk's running count
        .select(
            _PID, *by, prob_col, "_frac",
            F.col("_want.side").alias("_side"),
            (F.col("_want.rank") - F.col("_off") + F.col("_seg_start")).alias("_t"),
        )
    )
    r, t = ranked.alias("r"), targets.alias("t")
    cond = [F.col(f"r.{_PID}") == F.col(f"t.{_PID}")] + [F.col(f"r.{c}").eqNullSafe(F.col(f"t.{c}")) for c in by]
    hits = (
        r.join(t, cond, "inner")
        .where((F.col(f"r.{_PCUM}") - F.col(f"r.{_N}") <= F.col("t._t")) & (F.col("t._t") < F.col(f"r.{_PCUM}")))
        .select(*[F.col(f"t.{c}").alias(c) for c in by], F.col(f"t.{prob_col}"), F.col("t._frac"),
                F.col("t._side"), F.col(f"r.{_V}"))
    )
    return hits.groupBy(*by, prob_col).agg(
        F.max(F.when(F.col("_side") == 0, F.col(_V))).alias("lo"), F.max(F.when(F.col("_side") == 1, F.col(_V))).alias("hi"),
        F.max("_frac").alias("frac"),
    )


def _wanted(total: Column, probs: list[float], prob_col: str, at_rank) -> Column:
    """An array of ``(p, lo, hi, frac)``; ``at_rank(rank)`` gives the value of a rank from 0."""
    out = []
    for p in probs:
        pos = (total - 1).cast("double") * F.lit(p)
        lo = F.floor(pos).cast("long")
        out.append(F.struct(
            F.lit(p).alias(prob_col), at_rank(lo).alias("lo"), at_rank(F.least(lo + 1, total - 1)).alias("hi"),
            (pos - F.floor(pos)).alias("frac"),
        ))
    return F.array(*out)


def _sorted_whole(values: DataFrame, probs: list[float], by: list[str], prob_col: str) -> DataFrame:
    """``(*by, p, lo, hi, frac)`` of groups small enough for an array each."""
    held = values.groupBy(*by).agg(F.sort_array(F.collect_list(_V)).alias(_CUTS)).where(F.size(_CUTS) > 0)
    at_rank = lambda rank: F.element_at(_CUTS, (rank + 1).cast("int"))
    return held.select(*by, F.inline(_wanted(F.size(_CUTS), probs, prob_col, at_rank)))


def _same_group(left: str, right: str, by: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in by])


def _bracketed(df: DataFrame, value: str, probs: list[float], by: list[str], prob_col: str, num_chunks: int | None,
               small_group: int, large_groups: int, gathered: int) -> DataFrame:
    """``(*by, p, lo, hi, frac)`` by selection between the bounds of a sketch (see the module's text)."""
    spark = df.sparkSession
    values = _values(df, value, by)
    probs = sorted(set(probs))
    reach = 2 / SKETCH
    around = [x for p in probs for x in (max(0.0, p - reach), min(1.0, p + reach))]
    sketched = values.groupBy(*by).agg(
        F.count(F.lit(1)).alias(_TOTAL), F.percentile_approx(_V, around, SKETCH).alias(_CUTS)
    )
    # the largest groups: if all groups are among them, no other read looks for small ones
    most = sketched.orderBy(F.desc(_TOTAL)).limit(large_groups + 1).collect()
    large = [r for r in most if r[_TOTAL] > small_group]
    if not large:
        return _sorted_whole(values, probs, by, prob_col)
    if len(large) > large_groups:
        return _ranged(chunk_table(df, value, by, num_chunks), probs, by, prob_col)

    groups = F.broadcast(spark.createDataFrame(large, sketched.schema))
    if by:
        rows = values.alias("v").join(groups.alias("g"), _same_group("v", "g", by)).select("v.*", _TOTAL, _CUTS)
    else:  # the one group's bounds are constants
        cuts = F.array(*[F.lit(x) for x in large[0][_CUTS]])
        rows = values.select(_V, F.lit(large[0][_TOTAL]).alias(_TOTAL), cuts.alias(_CUTS))
    low, high = [F.col(_CUTS)[2 * i] for i in range(len(probs))], [F.col(_CUTS)[2 * i + 1] for i in range(len(probs))]

    def held(v: Column) -> Column:
        return reduce(lambda a, b: a | b, [(v >= a) & (v <= b) for a, b in zip(low, high, strict=True)])

    # values in no bracket are counted together between the brackets on either side
    gap = reduce(lambda a, b: a + b, [(F.col(_V) > b).cast("int") for b in high])
    counted = rows.groupBy(*by, gap.alias("_q_gap"), F.when(held(F.col(_V)), F.col(_V)).alias("_q_in")).agg(
        F.count(F.lit(1)).alias(_N), F.min(_V).alias(_AT), F.max(_TOTAL).alias(_TOTAL)
    )
    if max(r[_TOTAL] for r in large) * 2 * reach * len(probs) > gathered:
        ranked = _chunked(counted.select(*by, F.col(_AT).alias(_V), _N), by, num_chunks)
        found = _ranged(ranked, probs, by, prob_col)
    else:
        group = Window.partitionBy(*(by or [F.lit(0)])).orderBy(_AT).rowsBetween(Window.unboundedPreceding, 0)
        ranked = counted.withColumn(_PCUM, F.sum(_N).over(group))
        start = F.col(_PCUM) - F.col(_N)
        at_rank = lambda rank: F.max(F.when((start <= rank) & (rank < F.col(_PCUM)), F.col(_AT)))
        # totals stay inside the aggregates of ranks, so they are grouped by, too
        one = ranked.groupBy(*by, _TOTAL).agg(_wanted(F.col(_TOTAL), probs, prob_col, at_rank).alias("_q_found"))
        found = one.select(*by, F.inline("_q_found"))
    if by:
        checked = found.alias("v").join(groups.alias("g"), _same_group("v", "g", by)).select("v.*", _CUTS)
    else:
        checked = found.withColumn(_CUTS, cuts)
    sure = F.coalesce(held(F.col("lo")) & held(F.col("hi")), F.lit(False))
    known = checked.select(*by, prob_col, "lo", "hi", "frac", sure.alias("_q_sure"))
    results = known.collect()  # a row per large group and quantile
    unsure = [r for r in results if not r["_q_sure"]]
    parts = [spark.createDataFrame([r for r in results if r["_q_sure"]], known.schema).drop("_q_sure")]
    if len(large) < len(most):
        parts.append(_sorted_whole(
            values.alias("v").join(groups.alias("g"), _same_group("v", "g", by), "left_anti"), probs, by, prob_col))
    if unsure:
        again = spark.createDataFrame(unsure, known.schema).select(*by, prob_col)
        of = values.alias("v").join(F.broadcast(again).alias("g"), _same_group("v", "g", by), "left_semi") if by else values
        exact = _ranged(chunk_table(of, _V, by, num_chunks), probs, by, prob_col)
        same = _same_group("v", "g", [*by, prob_col])
        parts.append(exact.alias("v").join(F.broadcast(again).alias("g"), same, "left_semi"))
    return reduce(DataFrame.unionByName, parts)


def exact_quantiles(
    df: DataFrame,
    value: str,
    probs: Sequence[float],
    by: Sequence[str] = (),
    prob_col: str = "p",
    out_col: str = "q",
    num_chunks: int | None = None,
    method: str = "bracketed",
    accuracy: int = 10000,
    bounds: bool = False,
    small_group: int = SMALL_GROUP,
    large_groups: int = LARGE_GROUPS,
    gathered: int = GATHERED,
) -> DataFrame:
    """Long result ``(*by, p, q)``: the exact quantile ``q`` of ``value`` per group.

    ``value`` must already be numeric (use ``as_number``); ``by`` may be empty.
    Matches pandas / numpy ``quantile(interpolation='linear')``. With ``bounds``
    (not in ``in_task`` or ``approx``) the two order statistics and the weight of the upper one
    are given too, as ``lo, hi, frac``: what a monotone function of the values
    needs to have its own quantiles without another run.
    ``method``: ``bracketed``, ``distributed`` or, for groups known to be small, ``in_task``;
    ``approx`` opts out of exactness for a mergeable ``percentile_approx`` sketch
    (bounded memory per group, rank error about n / ``accuracy``, no interpolation).
    ``small_group``, ``large_groups`` and ``gathered`` are the bracketed way's limits; they
    choose where values are ordered, not what comes out. That way runs one or two aggregates
    while it is built and keeps the large groups' results, a few numbers each.
    """
    by = list(by)
    probs = [float(p) for p in probs]
    if method not in ("bracketed", "distributed", "in_task", "approx"):
        raise ValueError("method must be bracketed, distributed, in_task or approx")
    if method == "approx":
        qs = df.where(F.col(value).isNotNull()).groupBy(*by).agg(
            F.percentile_approx(F.col(value).cast("double"), [float(p) for p in probs], accuracy).alias("_qs"))
        plist = F.array(*[F.lit(float(p)) for p in probs])
        return qs.select(*by, F.posexplode("_qs").alias("_pos", out_col)).select(
            *by, F.element_at(plist, F.col("_pos") + 1).alias(prob_col), F.col(out_col))
    if method == "in_task":
        return _in_task_quantiles(df, value, probs, by, prob_col, out_col)
    if method == "bracketed":
        found = _bracketed(df, value, probs, by, prob_col, num_chunks, small_group, large_groups, gathered)
    else:
        found = _ranged(chunk_table(df, value, by, num_chunks), probs, by, prob_col)
    parts = ["lo", "hi", "frac"] if bounds else []
    return found.select(*by, prob_col, (F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("frac")).alias(out_col), *parts)


def quantile_columns(
    df: DataFrame,
    value: str,
    named_probs: dict[str, float],
    by: Sequence[str] = (),
    method: str = "bracketed",
) -> DataFrame:
    """Wide result: one row per group, one column per named quantile."""
    by = list(by)
    probs = sorted(set(named_probs.values()))
    longq = exact_quantiles(df, value, probs, by, method=method)
    aggs = [
        F.max(F.when(F.col("p") == F.lit(p), F.col("q"))).alias(name)
        for name, p in named_probs.items()
    ]
    return longq.groupBy(*by).agg(*aggs)
