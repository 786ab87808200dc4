"""Records of CSV files read in many splits a file, against Spark's own whole-file reader."""

import os
import tempfile

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from homestats.sources import files as FI
from homestats.sources import records as RC
from homestats.sources import tables as TB

HEADER = "ListingKey,\"City, State\",Remarks"
ROWS = [
    "1,Pasadena,plain", "2,\"Long\nBeach\",\"two\n\nbreaks, a comma\"", "3,\"say \"\"hi\"\"\",\"ends with quote\"\"\"",
    "4,5\" pipe,6' wall", "5,,", "", "6,\"\",\"\n\"", "7,\"a\n1,b,c\n2,\"\"x\"\",y\nz\",\"\"\"\n\"\"\"", "8,few", "9,a,b",
    "10,\"" + "long line\n" * 40 + "\",end", "11,last,row",
]


@pytest.fixture
def small_splits(spark):
    def setting(n):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(n))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")

    yield setting
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def folder(*texts):
    d = tempfile.mkdtemp(prefix="homestats-records-")
    for i, text in enumerate(texts):
        with open(os.path.join(d, f"ExportSold20240{i + 1}.csv"), "w", encoding="utf-8", newline="") as f:
            f.write(text)
    return d


def both(spark, d):
    """Rows by splits, and by Spark's reader with a file as one task."""
    by_splits, whole = TB.read_table(spark, d), TB.read_table(spark, d, whole_files=True)
    assert by_splits.columns == whole.columns
    return sorted(map(repr, by_splits.collect())), sorted(map(repr, whole.collect()))


@pytest.mark.parametrize("size", [7, 61, 1 << 20])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_records_are_those_of_whole_files(spark, small_splits, size, end):
    text = end.join([HEADER, *(r.replace("\n", end) for r in ROWS)])
    d = folder(text + end, text, HEADER + end)
    small_splits(size)
    found, want = both(spark, d)
    assert found == want
    if size == 7:
        assert RC._lines(spark, d, "*.csv", False).select("path", "start").distinct().count() > 20  # a file is many splits


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(cells=st.lists(st.lists(st.text(alphabet="ab,\"\n ", max_size=6), min_size=3, max_size=3), max_size=12), size=st.integers(8, 60))
def test_any_cells(spark, small_splits, cells, size):
    """Whatever quoted cells hold is read back, at any split size."""
    quoted = ["\"" + "\",\"".join(c.replace("\"", "\"\"") for c in row) + "\"" for row in cells]
    d = folder("\n".join([HEADER, *quoted]) + "\n")
    small_splits(size)
    found = [r["record"].decode() for r in RC.csv_records(spark, d, "*.csv").where("NOT header").collect()]
    assert sorted(found) == sorted(quoted)


@pytest.mark.parametrize("size", [16, 1 << 20])
def test_overview_counts_records_and_lines(spark, small_splits, size):
    text = "\n".join([HEADER, *ROWS]) + "\n"
    d = folder(text, HEADER + "\n", "")  # empty files aren't listed
    small_splits(size)
    seen = {r["source"]: (r["rows"], r["parsed_rows"], r["columns"]) for r in FI.file_overview(spark, d).collect() if r["source"] != "TOTAL"}
    assert seen["ExportSold202401"] == (text.count("\n") - 1, len([r for r in ROWS if r]), 3)
    assert seen["ExportSold202402"] == (0, 0, 3)
    assert "ExportSold202403" not in seen


def test_more_cut_splits_than_told_read_whole_files(spark, small_splits, monkeypatch):
    d = folder("\n".join([HEADER, *ROWS]) + "\n")
    small_splits(16)
    assert RC.csv_records(spark, d, "*.csv", most_cut=1) is None
    monkeypatch.setattr(RC.csv_records, "__defaults__", (None, False, 1))
    found, want = both(spark, d)
    assert found == want


def test_open_quote_ends_with_its_file(spark, small_splits):
    d = folder("a,b\n1,\"x\n2,y\n", "a,b\n3,z\n")
    small_splits(4)
    rows = [r["record"] for r in RC.csv_records(spark, d, "*.csv").where("NOT header").collect()]
    assert sorted(rows) == [b"1,\"x\n2,y", b"3,z"]


def test_no_files_and_empty_files(spark):
    assert RC.split_states(spark, folder("", ""), "*.csv").count() == 0
    assert TB.read_table(spark, folder()).columns == ["source_file"]
