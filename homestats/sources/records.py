"""CSV records of large files, read by many tasks a file although quoted cells may hold line breaks.

A line either begins a record or goes on inside a quoted cell, and what it does to the line after it depends on
nothing else. So a first scan tells per split where its last line ends if the split begins outside a
quoted cell, and if it begins inside one. These two answers, put one after the other over a
file's splits, give the state every split really begins in; the second scan then builds
records in each split by itself. Records cut by a split's end (at most two pieces a split) come
from one more scan, which passes on only the lines of splits that hold such pieces, and are shuffled to be put together.

The grammar is the usual one: a cell is quoted if a quote is its first character, quotes inside are
doubled, and quotes inside plain cells are text. ASCII-compatible encodings only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Splits that begin or end inside a quoted cell and are told to all tasks; with more, files are read whole.
MOST_CUT = 500_000

# Cells up to a comma; a line that begins a record and ends inside a quoted
# cell; a line that begins and ends inside one.
_CELLS = r'(?:[^",][^,]*,|"(?:[^"]|"")*"(?:[^",][^,]*)?,|,)*'
_OPENS = "^" + _CELLS + r'"(?:[^"]|"")*$'
_STAYS = r'^(?:[^"]|"")*(?:"(?:[^",][^,]*)?,' + _CELLS + r'"(?:[^"]|"")*)?$'


def _lines(spark: SparkSession, path: str | Sequence[str], pattern: str | None, recursive: bool) -> DataFrame:
    """``(path, start, line)``: lines as bytes, in file order within a split; ``start`` is the split's."""
    reader = spark.read.option("lineSep", "\n")
    if pattern is not None:
        reader = reader.option("pathGlobFilter", pattern).option("recursiveFileLookup", str(bool(recursive)).lower())
    return reader.text(path if isinstance(path, str) else list(path)).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"),
        F.col("value").cast("binary").alias("line"),
    )


def _line_tools():
    """What both scans do with a batch: its splits, the states of its lines. Closures, so executors need no copy of this package."""
    opens, stays = _OPENS, _STAYS

    def segments(batch):
        """``(path, start, lines)`` of each split's rows in a batch."""
        import numpy as np
        import pyarrow.compute as pc

        paths, starts = batch.column(0), batch.column(1).to_numpy()
        new = starts[1:] != starts[:-1]
        new |= pc.not_equal(paths[1:], paths[:-1]).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(new) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            yield paths[a].as_py(), int(starts[a]), batch.column(2)[a:b]

    def effects(lines):
        """The state after each line if it begins outside a quoted cell, and if inside."""
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        outside, inside = np.zeros(len(lines), np.int8), np.ones(len(lines), np.int8)
        quoted = np.flatnonzero(pc.match_substring(lines, '"').to_numpy(zero_copy_only=False))
        if len(quoted):
            some = lines.take(pa.array(quoted))
            outside[quoted] = pc.match_substring_regex(some, opens).to_numpy(zero_copy_only=False)
            inside[quoted] = pc.match_substring_regex(some, stays).to_numpy(zero_copy_only=False)
        return outside, inside

    def states(outside, inside, state):
        """The state before each line and after the last one."""
        import numpy as np

        fixed = outside == inside
        turns = np.cumsum(outside > inside)
        at = np.maximum.accumulate(np.where(fixed, np.arange(len(outside)), -1))
        known = at >= 0
        after = (np.where(known, outside[at], state) + turns - np.where(known, turns[at], 0)) % 2
        return np.concatenate(([state], after[:-1])), int(after[-1])

    def blank(lines):
        import pyarrow as pa
        import pyarrow.compute as pc

        return pc.is_in(lines, value_set=pa.array([b"", b"\r"], pa.binary())).to_numpy(zero_copy_only=False)

    return segments, effects, states, blank


def split_states(spark: SparkSession, path: str | Sequence[str], pattern: str | None = None, recursive: bool = False,
                 quoted_breaks: bool = True) -> DataFrame:
    """``(path, start, inside, open, lines, records)``, a row per split that holds a line's beginning.

    ``inside`` and ``open`` tell whether the split begins and ends inside a quoted cell, ``lines`` counts the physical
    lines that begin in it, ``records`` those that begin a record and aren't blank. Empty files have no row.
    Without ``quoted_breaks`` every line begins a record.
    """
    segments, effects, states, blank = _line_tools()

    def scan(batches):
        import pyarrow as pa

        names = ["path", "start", "lines", "records0", "records1", "end0", "end1"]

        def row(key, lines, records, ends):
            values = [*key, lines, *records, *ends]
            return pa.RecordBatch.from_arrays([pa.array([v], pa.string() if i == 0 else pa.int64()) for i, v in enumerate(values)], names=names)

        key = None
        for batch in batches:
            if not batch.num_rows:
                continue
            for path, start, rows in segments(batch):
                if (path, start) != key:
                    if key is not None:
                        yield row(key, lines, records, ends)
                    key, lines, records, ends = (path, start), 0, [0, 0], [0, 1]
                outside, inside = effects(rows)
                if not quoted_breaks:
                    outside[:] = inside[:] = 0
                text = ~blank(rows)
                lines += len(rows)
                for i in (0, 1):
                    before, ends[i] = states(outside, inside, ends[i])
                    records[i] += int((text & (before == 0)).sum())
        if key is not None:
            yield row(key, lines, records, ends)

    found = _lines(spark, path, pattern, recursive).mapInArrow(
        scan, "path string, start long, lines long, records0 long, records1 long, end0 long, end1 long")
    # the state before a split: where the last split that always ends alike ends, turned as often as splits after it turn it
    before = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("path").orderBy("start").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = found.withColumn("turns", F.sum((F.col("end0") > F.col("end1")).cast("long")).over(upto))
    fixed = F.last(F.when(F.col("end0") == F.col("end1"), F.struct("end0", "turns")), ignorenulls=True).over(before)
    turned = F.coalesce(F.last("turns").over(before), F.lit(0))
    found = found.withColumn("fixed", fixed).withColumn("turned", turned)
    state = (F.coalesce(F.col("fixed.end0"), F.lit(0)) + F.col("turned") - F.coalesce(F.col("fixed.turns"), F.lit(0))) % 2
    found = found.withColumn("inside", state == 1)
    return found.select(
        "path", "start", "inside", (F.when(F.col("inside"), F.col("end1")).otherwise(F.col("end0")) == 1).alias("open"), "lines",
        F.when(F.col("inside"), F.col("records1")).otherwise(F.col("records0")).alias("records"),
    )


def csv_records(spark: SparkSession, path: str | Sequence[str], pattern: str | None = None, recursive: bool = False,
                most_cut: int = MOST_CUT) -> DataFrame | None:
    """``(path, header, record)``: every record's bytes, line breaks inside it included; blank ones are left out.

    ``header`` marks the record at a file's beginning. None if more than ``most_cut`` splits begin or
    end inside quoted cells, as their list goes to all tasks (the scan's own plan holds every split anyhow).
    A quoted cell that never closes ends with its file. One job runs here.
    """
    cut = split_states(spark, path, pattern, recursive).where("inside OR open").select("path", "start", "inside")
    cut = cut.limit(most_cut + 1).toArrow()
    if cut.num_rows > most_cut:
        return None
    lines = _lines(spark, path, pattern, recursive)
    rows = zip(cut["path"].to_pylist(), cut["start"].to_pylist(), cut["inside"].to_pylist(), strict=True)
    schema = "path string, start long, kind int, header boolean, record binary"
    build = _builder({(path, start) for path, start, inside in rows if inside})
    whole = lines.mapInArrow(build, schema).where("kind = 0").select("path", "header", "record")
    if not cut.num_rows:
        return whole
    known = F.broadcast(spark.createDataFrame(cut.select(["path", "start"])))  # at most most_cut short rows
    pieces = lines.join(known, ["path", "start"], "left_semi").select("path", "start", "line").mapInArrow(build, schema).where("kind > 0")
    order = Window.partitionBy("path").orderBy("start", F.desc("kind"))
    number = F.sum((F.col("kind") == 1).cast("long")).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    joined = pieces.withColumn("number", number).groupBy("path", "number").agg(
        F.max("header").alias("header"), F.array_sort(F.collect_list(F.struct("start", "record"))).alias("pieces"))
    record = F.reduce(F.slice("pieces", F.lit(2), F.size("pieces")), F.element_at("pieces", 1)["record"],
                      lambda made, p: F.concat(made, F.lit(b"\n"), p["record"]))
    return whole.unionByName(joined.select("path", "header", record.alias("record")))


def _builder(begun_inside: set[tuple[str, int]]):
    """The batch function that builds the records of each split, and the pieces of those cut by its ends."""
    segments, effects, states, blank = _line_tools()

    def build(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        names = ["path", "start", "kind", "header", "record"]

        def rows(key, kind, headers, records):
            """``kind``: 0 whole records, 1 the beginning of one cut by the split's end, 2 what goes on from before the split."""
            n = len(records)
            return pa.RecordBatch.from_arrays(
                [pa.repeat(pa.scalar(key[0]), n), pa.repeat(pa.scalar(key[1], pa.int64()), n), pa.repeat(pa.scalar(kind, pa.int32()), n),
                 pa.array(headers, pa.bool_()), records], names=names)

        def piece(key, kind, header, held):
            return rows(key, kind, [header], pa.array([b"\n".join(held)], pa.binary()))

        key = held = None  # ``held``: lines of a record that isn't closed yet
        for batch in batches:
            if not batch.num_rows:
                continue
            for path, start, lines in segments(batch):
                fresh = (path, start) != key
                if fresh:
                    if held is not None:
                        yield piece(key, 2 if goes_on else 1, heads, held)
                    key = (path, start)
                    state = int(key in begun_inside)
                    held, goes_on, heads = ([], True, False) if state else (None, False, False)
                before, state = states(*effects(lines), state)
                begins = np.flatnonzero(before == 0)
                done = begins[0] if len(begins) else len(lines)
                if held is not None:
                    held += lines[:done].to_pylist()
                    if len(begins) or state == 0:
                        yield piece(key, 2 if goes_on else 0, heads, held)
                        held, goes_on, heads = None, False, False
                if not len(begins):
                    continue
                bounds = np.append(begins, len(lines))
                first = fresh and start == 0 and begins[0] == 0
                if state:  # the last record goes on
                    held, heads = lines[int(bounds[-2]):].to_pylist(), bool(first and len(begins) == 1)
                    bounds = bounds[:-1]
                if len(bounds) < 2:
                    continue
                lists = pa.ListArray.from_arrays(pa.array((bounds - bounds[0]).astype(np.int32)), lines[int(bounds[0]):int(bounds[-1])])
                whole = pc.binary_join(lists, pa.scalar(b"\n", pa.binary()))
                headers = np.zeros(len(whole), bool)
                headers[0] = first
                text = ~blank(whole)
                yield rows(key, 0, headers[text], whole.filter(pa.array(text)))
        if held is not None:
            yield piece(key, 2 if goes_on else 1, heads, held)

    return build


def record_text(record, encoding: str):
    """A record decoded. One that ends in a carriage return loses it, and those of its line breaks, as Spark's reader does."""
    text = F.decode(record, encoding)
    bare = F.replace(F.substring(text, F.lit(1), F.length(text) - 1), F.lit("\r\n"), F.lit("\n"))
    return F.when(F.endswith(text, F.lit("\r")), bare).otherwise(text)
