"""Mixing sources to target weights.

Tokens (words) are summed per source; each source's target share gives it a
repetition rate; a document is emitted ``floor(rate)`` times, and once more with
the probability of the rate's fraction. That draw is a hash of the seed and the
document, so reruns and retried tasks agree. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from homestats.llm.common import count_words, draw, fresh, materialize

#: Up to this many sources the table of rates (two numbers and a name each) is broadcast.
BROADCAST_SOURCES = 100_000
#: Beyond it, each source's documents are dealt over this many join keys.
SALTS = 64


def cycled_weights(cycle=(3.0, 1.0, 2.0)):
    """Weights that repeat along the sources in code-point order, the null source last."""

    def weigh(sources: DataFrame) -> DataFrame:
        place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
        pick = F.element_at(F.array(*[F.lit(float(w)) for w in cycle]), (F.pmod(place, F.lit(len(cycle))) + 1).cast("int"))
        return sources.withColumn("weight", pick)

    return weigh


def source_targets(sizes: DataFrame, weigh, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """``(source, source_size, weight, target)`` from ``(source, size)`` rows.

    ``share`` times all sizes is dealt out by weight; no target exceeds ``most``
    times its source's size, and the excess is dealt out again by weight until
    none does. That fixed point is ``min(cap, level * weight)``: sources fill up in
    the order of cap / weight, and the level is the first one at which the next
    source is not filled. One row per source; sources without words get 0.

    The windows run over one row per source (aggregated before).
    """
    sources = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    weighed = weigh(sources).withColumn("cap", F.col("source_size") * F.lit(float(most)))
    order = Window.orderBy("fills_at", F.col("source").asc_nulls_last())
    upto = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    level = (
        weighed.withColumn("fills_at", F.when(F.col("weight") > 0, F.col("cap") / F.col("weight")).otherwise(F.lit(0.0)))
        .withColumn("total", F.sum("source_size").over(everything) * F.lit(float(share)))
        .withColumn("all_weight", F.sum("weight").over(everything))
        .withColumn("filled", F.coalesce(F.sum("cap").over(upto), F.lit(0.0)))
        .withColumn("filled_weight", F.coalesce(F.sum("weight").over(upto), F.lit(0.0)))
        .withColumn("level", F.try_divide(F.col("total") - F.col("filled"), F.col("all_weight") - F.col("filled_weight")))
        .withColumn("place", F.row_number().over(order))
        .withColumn("first_level", F.min(F.when(F.col("level") <= F.col("fills_at"), F.struct("place", "level"))).over(everything))
    )
    target = F.coalesce(F.least(F.col("cap"), F.col("first_level.level") * F.col("weight")), F.col("cap"))
    return level.select("source", "source_size", "weight", target.cast("double").alias("target"))


def _with_rates(docs: DataFrame, rates: DataFrame, source: str, columns: list[str]) -> DataFrame:
    """Join each document with its source's row; null is a source like any other.

    A counted table of at most ``BROADCAST_SOURCES`` rows is broadcast. A longer one
    is joined by shuffle, a source's documents dealt over ``SALTS`` keys, so that a
    source holding a third of all rows isn't one task's work.
    """
    side = rates.select(F.col("source").alias(s := fresh("source")), *columns)
    same = docs[source].eqNullSafe(side[s])
    if rates.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES:
        return docs.join(F.broadcast(side), same, "inner").drop(s)
    salt, key = fresh("salt"), fresh("key")
    salted = docs.withColumn(salt, F.pmod(F.xxhash64(*docs.columns), F.lit(SALTS)))
    copies = side.withColumn(key, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    return salted.join(copies, salted[source].eqNullSafe(copies[s]) & (salted[salt] == copies[key]), "inner").drop(s, salt, key)


def mix_plan(
    docs: DataFrame, weigh=None, share: float = 1.5, most: float = 2.0, seed: int = 17,
    doc_id: str = "doc_id", text: str = "text", source: str = "source",
) -> DataFrame:
    """``docs`` without its text, with ``size, source_size, target, rate, copies, taken``.

    Null or empty texts have size 0 (their rate still applies); a null source is a
    source of its own, last in order; a source without words has rate 0. Rows with
    the same id, source and size draw alike, so repeated rows are taken equally
    often. An empty table gives an empty result. Callers' columns of the same names
    as those added are dropped.
    """
    added = ["size", "source_size", "target", "rate", "copies", "taken"]
    kept = [c for c in docs.columns if c not in added and c != text]
    sized = docs.select(*[F.col(f"`{c}`") for c in kept], count_words(F.col(text)).alias("size"))
    targets = materialize(source_targets(sized.select(F.col(source).alias("source"), "size"), weigh or cycled_weights(), share, most), "mix-targets")
    out = _with_rates(sized, targets, source, ["source_size", "target"])
    return _copies(out, seed, doc_id, source).withColumn("taken", F.col("size") * F.col("copies"))


def _copies(df: DataFrame, seed: int, doc_id: str, source: str) -> DataFrame:
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    extra: Column = draw(seed, F.col(doc_id), F.col(source), F.col("size")) < F.col("rate") - F.floor("rate")
    return df.withColumn("rate", rate).withColumn("copies", (F.floor("rate") + extra.cast("long")).cast("long"))


def mix(
    docs: DataFrame, weigh=None, share: float = 1.5, most: float = 2.0, seed: int = 17,
    doc_id: str = "doc_id", text: str = "text", source: str = "source",
) -> DataFrame:
    """The mixed corpus: rows of ``docs`` with its own columns, each as often as it is taken.

    Cases are as in ``mix_plan``; columns of the caller keep their names and values.
    """
    names = {c: fresh("own") for c in docs.columns}
    inner = docs.withColumnsRenamed(names)
    sized = inner.withColumn("size", count_words(F.col(names[text])))
    per_source = sized.select(F.col(names[source]).alias("source"), "size")
    targets = materialize(source_targets(per_source, weigh or cycled_weights(), share, most), "mix-targets")
    rated = _copies(_with_rates(sized, targets, names[source], ["source_size", "target"]), seed, names[doc_id], names[source])
    repeated = rated.withColumn("copy", F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int"))))
    return repeated.select(*[F.col(new).alias(old) for old, new in names.items()])
