"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from homestats.llm.common import materialize, release


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``(node, root)`` of every node of ``edges (a, b)``; a root is its component's smallest node.

    Each round points every node's larger neighbours to its smallest one, then its
    smaller neighbours; a component becomes a star in few rounds. A node's neighbours
    are never collected: rounds are aggregates by node and joins with them, written
    to the shared folder, where one round's take the place of the last one's. Loops and repeated edges do no harm; no edges, no rows.
    """
    current = materialize(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name
    )
    print_of = F.struct(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.lit(0)).alias("h"))
    before = current.select(print_of.alias("p")).first()["p"]
    while True:
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # every edge now points down; small star: all smaller neighbours of a node to the smallest
        smallest = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(smallest, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        last = current
        current = materialize(moved.unionByName(smallest.select("a", F.col("m").alias("b"))).filter("a <> b").distinct(), name)
        release(last)
        after = current.select(print_of.alias("p")).first()["p"]
        if after == before:
            break
        before = after
    roots = current.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
