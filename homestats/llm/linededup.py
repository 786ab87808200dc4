"""Line dedup over levelled sorted runs of line hashes.

Every batch of documents becomes a run: sorted rows ``(h1, h2, n_docs)``, one per
distinct line key of the batch. Before its run is written, the batch is
merge-anti-joined with the *settled* keys (those already known to reach the
limit), so a line found everywhere is stored until it is settled and not again.
When a level holds ``fanout`` runs they are merged into one run of the next level,
their counts added, and keys that reach the limit move to the settled run. After
the last batch all runs are merged once; a document then loses every line whose
key is settled. DataFrame functions only.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from homestats.llm.common import SPACE_CHARS, fresh, materialize, scratch_path

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
KEY = ["h1", "h2"]


def line_key(line: Column) -> Column:
    """The line stripped of ASCII white space at both ends, A-Z in lower case."""
    return F.translate(F.btrim(line, F.lit(SPACE_CHARS)), _UPPER, _LOWER)


def lines_of(text: Column) -> Column:
    """The lines of a text; null or empty: one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _hashed(key: Column) -> Column:
    """128 bits that stand for a key."""
    return F.struct(F.xxhash64(key).alias("h1"), F.xxhash64(F.lit("line"), key).alias("h2"))


class LineRuns:
    """Levelled sorted runs of line-key counts in the shared folder.

    ``min_docs`` documents settle a key, ``fanout`` runs of a level are merged into
    one of the next. Each run is a table sorted by key within hash partitions.
    Only run paths are kept on the driver.
    """

    def __init__(self, spark: SparkSession, min_docs: int, fanout: int = 4):
        self.spark, self.min_docs, self.fanout = spark, min_docs, fanout
        self.levels: list[list[str]] = [[]]
        self.settled_runs: list[str] = []

    _SCHEMA = "h1 long, h2 long, n_docs long"

    def _write(self, df: DataFrame, name: str) -> str:
        path = scratch_path(self.spark, name)
        df.sortWithinPartitions(*KEY).write.parquet(path)
        return path

    def _read(self, paths: list[str]) -> DataFrame:
        runs = [self.spark.read.schema(self._SCHEMA).parquet(p) for p in paths]
        return reduce(DataFrame.unionByName, runs) if runs else self.spark.createDataFrame([], self._SCHEMA)

    def settled(self) -> DataFrame:
        """Keys known to be in at least ``min_docs`` documents."""
        return self._read(self.settled_runs).select(*KEY)

    def add(self, counts: DataFrame) -> None:
        """Add a batch's ``(h1, h2, n_docs)``, one row per key, as a run; merge levels that are full."""
        if self.settled_runs:
            counts = counts.join(self.settled(), KEY, "left_anti")
        self.levels[0].append(self._write(counts, "line-run"))
        level = 0
        while len(self.levels[level]) >= self.fanout:
            merged = self._merge(self.levels[level])
            self.levels[level] = []
            if level + 1 == len(self.levels):
                self.levels.append([])
            self.levels[level + 1].append(merged)
            level += 1

    def _merge(self, paths: list[str]) -> str:
        """Merge runs: counts of a key are added; keys that reach the limit become settled."""
        merged = materialize(
            self._read(paths).groupBy(*KEY).agg(F.sum("n_docs").alias("n_docs")).sortWithinPartitions(*KEY), "line-merge"
        )
        # both parts are read from the merged table by a filter on n_docs
        self.settled_runs.append(self._write(merged.filter(F.col("n_docs") >= self.min_docs), "line-settled"))
        return self._write(merged.filter(F.col("n_docs") < self.min_docs), "line-run")

    def finish(self) -> DataFrame:
        """Merge whatever runs are left; the settled keys are then complete."""
        if paths := [p for level in self.levels for p in level]:
            self.levels = [[], [self._merge(paths)]]
        return self.settled()


def frequent_line_keys(docs: DataFrame, min_docs: int, min_chars: int, batches: int, fanout: int, text: str) -> DataFrame:
    """Keys of at least ``min_chars`` code points in at least ``min_docs`` documents (rows)."""
    spark = docs.sparkSession
    keys = F.array_distinct(F.filter(F.transform(lines_of(F.col(text)), line_key), lambda k: F.length(k) >= min_chars))
    # One pass over the texts hashes all lines; a document's text decides its batch.
    hashed = docs.select(
        F.pmod(F.xxhash64(F.col(text)), F.lit(batches)).cast("int").alias("batch"),
        F.explode(F.transform(keys, _hashed)).alias("k"),
    )
    path = scratch_path(spark, "line-batches")
    per_batch = hashed.groupBy("batch", "k.h1", "k.h2").agg(F.count(F.lit(1)).alias("n_docs"))
    per_batch.write.partitionBy("batch").parquet(path)
    runs = LineRuns(spark, min_docs, fanout)
    schema = spark.createDataFrame([], LineRuns._SCHEMA + ", batch int").schema
    stored = spark.read.schema(schema).parquet(path)
    for b in range(batches):
        runs.add(stored.filter(F.col("batch") == b).drop("batch"))
    return runs.finish()


def drop_frequent_lines(
    docs: DataFrame, min_docs: int = 10, min_chars: int = 1, batches: int = 4, fanout: int = 2,
    doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """``docs`` with ``text`` less its frequent lines, and ``n_lines, n_dropped`` added.

    A line's key is the line stripped of ASCII white space with A-Z in lower case.
    Keys of at least ``min_chars`` code points found in at least ``min_docs``
    documents lose all their lines everywhere; other lines stay, joined by a line
    feed. Every row is a document, repeated rows and rows without an id too. Null
    and empty texts have one empty line, which has no key to count when
    ``min_chars`` is 1 or more; their result is the empty text. Callers' columns keep their
    names; ``n_lines`` and ``n_dropped`` of theirs are replaced.
    """
    settled = frequent_line_keys(docs.select(F.col(text)), min_docs, min_chars, batches, fanout, text)
    # Where the frequent lines are: narrow rows, no text. A row is known by its id and its text's digest.
    identity = [F.col(doc_id).alias("id"), F.xxhash64(F.col(text)).alias("t1"), F.xxhash64(F.lit("text"), F.col(text)).alias("t2")]
    keyed = docs.select(*identity, F.posexplode(F.transform(lines_of(F.col(text)), lambda x: _hashed(line_key(x)))).alias("at", "k"))
    hits = keyed.select("id", "t1", "t2", "at", "k.h1", "k.h2").join(settled, KEY, "left_semi")
    drops = hits.groupBy("id", "t1", "t2").agg(F.collect_set("at").alias("drops"))

    names = {c: fresh("own") for c in docs.columns if c not in ("n_lines", "n_dropped")}
    own = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()])
    t = F.col(names[text])
    joined = own.join(
        drops,
        F.col(names[doc_id]).eqNullSafe(F.col("id")) & (F.xxhash64(t) == F.col("t1")) & (F.xxhash64(F.lit("text"), t) == F.col("t2")),
        "left",
    )
    lines = lines_of(t)
    stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.coalesce(F.col("drops"), F.array().cast("array<int>")))
    kept = F.when(F.col("drops").isNull(), F.coalesce(t, F.lit(""))).otherwise(
        F.array_join(F.transform(stay, lambda i: F.get(lines, i)), "\n")
    )
    out = [kept.alias(c) if c == text else F.col(n).alias(c) for c, n in names.items()]
    return joined.select(
        *out, F.size(lines).cast("long").alias("n_lines"), F.coalesce(F.size("drops"), F.lit(0)).cast("long").alias("n_dropped")
    )
