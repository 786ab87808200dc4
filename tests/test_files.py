"""CSV file fixtures written to a temp folder: header drift, BOM, Latin-1,
quoted newlines, null tokens, classification, empty and missing folders."""

import os
import tempfile
import time

import pytest

from homestats.sources import files as FI
from homestats.sources import tables as TB


@pytest.fixture(scope="module")
def export_dir():
    d = tempfile.mkdtemp(prefix="homestats-files-")
    with open(os.path.join(d, "ExportSold202401.csv"), "w", encoding="utf-8") as f:
        f.write('ListingKey,City,ClosePrice\n1,La Cañada,100\n2,"Multi\nLine City",NA\n3,Pasadena,$5\n\n4,Glendale,NaN\n')
    with open(os.path.join(d, "ExportSold202402.csv"), "w", encoding="utf-8-sig") as f:
        f.write("ClosePrice,ListingKey,Extra\n250,5,x\n,6,y\n")
    with open(os.path.join(d, "ExportListing202401.csv"), "w", encoding="utf-8") as f:
        f.write("ListingKey,ListPrice\n10,500\n")
    with open(os.path.join(d, "notes.csv"), "w", encoding="utf-8") as f:
        f.write("a,b\n1,2\n")
    return d


def test_list_and_classify(spark, export_dir):
    files = FI.list_sources(spark, export_dir)
    assert files.count() == 4
    cls = {(r["name"], r["class"]) for r in FI.classify_sources(files).collect()}
    assert ("ExportSold202401.csv", "Sold") in cls and ("ExportListing202401.csv", "Listing") in cls
    assert ("notes.csv", "other") in cls


def test_headers_strip_bom(spark, export_dir):
    heads = {os.path.basename(r["path"]): r["header"] for r in FI.file_headers(spark, export_dir).collect()}
    assert heads["ExportSold202402.csv"] == ["ClosePrice", "ListingKey", "Extra"]


def test_header_consistency(spark, export_dir):
    hc = [r for r in FI.header_consistency(spark, export_dir).collect() if r["class"] == "Sold"]
    assert len(hc) == 2
    other = [r for r in hc if not r["is_base"]][0]
    assert sorted(other["extra"]) == ["Extra"] and sorted(other["missing"]) == ["City"]


def test_read_table_aligns_by_name(spark, export_dir):
    df = TB.read_table(spark, export_dir, pattern="ExportSold*.csv")
    rows = {r["ListingKey"]: r for r in df.collect()}
    assert set(rows) == {"1", "2", "3", "4", "5", "6"}
    assert rows["5"]["ClosePrice"] == "250" and rows["5"]["City"] is None and rows["5"]["Extra"] == "x"
    assert rows["1"]["City"] == "La Cañada"
    assert rows["2"]["City"] == "Multi\nLine City"  # quoted newline is one record
    assert rows["2"]["ClosePrice"] is None and rows["4"]["ClosePrice"] is None  # NA, NaN tokens
    assert rows["6"]["ClosePrice"] is None
    assert rows["1"]["source_file"] == "ExportSold202401.csv"


def test_doubled_quotes_and_quoted_names(spark):
    d = tempfile.mkdtemp(prefix="homestats-quotes-")
    with open(os.path.join(d, "ExportSold202401.csv"), "w", encoding="utf-8") as f:
        f.write('ListingKey,"City, State","The ""Addr""",ClosePrice\n1,"Pasadena, CA","The ""Oaks"", Unit 2",100\n')
    heads = FI.file_headers(spark, d).first()["header"]
    assert heads == ["ListingKey", "City, State", 'The "Addr"', "ClosePrice"]
    row = TB.read_table(spark, d).first()
    assert (row["City, State"], row['The "Addr"'], row["ClosePrice"]) == ("Pasadena, CA", 'The "Oaks", Unit 2', "100")
    back = TB.write_table(spark.createDataFrame([('a "b", c', 'x\ny')], "s string, t string"), d + "/out", "csv")
    again = TB.read_table(spark, back).first()
    assert (again["s"], again["t"]) == ('a "b", c', "x\ny")


def test_line_split_is_the_callers_choice(spark, export_dir):
    # without quoted line breaks both ways give the same rows
    whole = TB.read_table(spark, export_dir, pattern="ExportSold202402.csv")
    split = TB.read_table(spark, export_dir, pattern="ExportSold202402.csv", multi_line=False)
    assert sorted(map(str, whole.collect())) == sorted(map(str, split.collect()))


def test_latin1_headers(spark):
    d = tempfile.mkdtemp(prefix="homestats-latin1h-")
    with open(os.path.join(d, "ExportSold202404.csv"), "w", encoding="latin-1") as f:
        f.write("ListingKey,Cañada\r\n1,ñ\r\n")
    assert FI.file_headers(spark, d, encoding="ISO-8859-1").first()["header"] == ["ListingKey", "Cañada"]
    assert TB.read_table(spark, d, encoding="ISO-8859-1").first()["Cañada"] == "ñ"


def test_latin1(spark):
    d = tempfile.mkdtemp(prefix="homestats-latin1-")
    with open(os.path.join(d, "ExportSold202403.csv"), "w", encoding="latin-1") as f:
        f.write("ListingKey,City\n1,La Cañada\n")
    df = TB.read_table(spark, d, encoding="ISO-8859-1")
    assert df.first()["City"] == "La Cañada"


def test_file_overview(spark, export_dir):
    ov = {(r["class"], r["source"]): r for r in FI.file_overview(spark, export_dir).collect()}
    assert ov[("Sold", "ExportSold202402")]["rows"] == 2
    assert ov[("Sold", "ExportSold202402")]["columns"] == 3
    assert ov[("Sold", "ExportSold202401")]["rows"] == 6  # physical lines minus the header
    assert ov[("Sold", "ExportSold202401")]["parsed_rows"] == 4  # quoted newline and blank line handled
    assert ov[("Sold", "TOTAL")]["rows"] == 8 and ov[("Sold", "TOTAL")]["parsed_rows"] == 6


def test_empty_and_missing(spark):
    empty = tempfile.mkdtemp(prefix="homestats-empty-")
    assert FI.list_sources(spark, empty).count() == 0
    assert FI.source_check(spark, empty).first()["status"] == "FAIL"
    assert FI.source_check(spark, empty + "/nope").first()["status"] == "FAIL"


def test_write_and_summary_roundtrip(spark):
    d = tempfile.mkdtemp(prefix="homestats-write-")
    df = spark.createDataFrame([(1, "a"), (2, None)], "k int, v string")
    TB.write_table(df, d + "/t", "csv")
    back = spark.read.option("header", True).csv(d + "/t")
    assert back.count() == 2
    from pyspark.sql import functions as F

    s = spark.range(1).select(F.struct(F.lit(3).alias("raw_rows"), F.array(F.lit("x")).alias("dropped")).alias("sold"))
    TB.write_summary(s, d + "/s")
    r = TB.read_summary(spark, d + "/s").first()
    assert r["sold"]["raw_rows"] == 3 and r["sold"]["dropped"] == ["x"]


@pytest.mark.parametrize("head_bytes", [1, 7, 1 << 16])
def test_headers_read_the_first_record_only(spark, head_bytes):
    d = tempfile.mkdtemp(prefix="homestats-heads-")
    files = {
        "a.csv": b'ListingKey,"City\nor ""town""",x\r\n1,"2\n",3\n', "b.csv": b"\xef\xbb\xbfk,v", "c.csv": b"", "d e.csv": b"p,q\n",
        "f.csv": b'"a","b"\n', "big.csv": b"one,two\n" + b"1,2\n" * 300_000,
    }
    for name, data in files.items():
        with open(os.path.join(d, name), "wb") as f:
            f.write(data)
    heads = FI.file_headers(spark, d, head_bytes=head_bytes)
    got = {os.path.basename(r["path"]): r["header"] for r in heads.collect()}
    assert got == {"a.csv": ["ListingKey", 'City\nor "town"', "x"], "b.csv": ["k", "v"], "d e.csv": ["p", "q"], "f.csv": ["a", "b"], "big.csv": ["one", "two"]}
    plan = heads._jdf.queryExecution().executedPlan().toString()
    assert "FileScan text" not in plan and "content" not in plan  # no file is scanned for its header
    rows = TB.read_table(spark, d, pattern="*e.csv").columns
    assert rows[:2] == ["p", "q"]


def test_a_header_costs_the_same_however_large_the_file(spark):
    d = tempfile.mkdtemp(prefix="homestats-bytes-")
    with open(os.path.join(d, "huge.csv"), "wb") as f:
        f.write(b"k,v\n")
        f.truncate(200 << 30)  # sparse: 200 GB that nobody could read in time
    began = time.time()
    assert FI.file_headers(spark, d).first()["header"] == ["k", "v"]
    assert time.time() - began < 60


def test_stores_that_only_spark_reads_are_scanned(spark, export_dir, monkeypatch):
    want = {r["path"]: r["header"] for r in FI.file_headers(spark, export_dir).collect()}
    monkeypatch.setattr(FI, "_arrow_opens", lambda path: False)
    got = {r["path"]: r["header"] for r in FI.file_headers(spark, export_dir).collect()}
    assert [sorted(x.values()) for x in (got, want)] == [sorted(want.values())] * 2


def test_a_failed_overwrite_leaves_the_old_table(spark):
    from pyspark.sql import functions as F

    path = tempfile.mkdtemp(prefix="homestats-stage-") + "/t"
    for fmt in ("csv", "parquet"):
        TB.write_table(spark.range(5), path, fmt)
        bad = spark.range(100, 200).select(F.when(F.col("id") < 150, F.col("id")).otherwise(F.raise_error(F.lit("lost"))).alias("id"))
        with pytest.raises(Exception, match="lost"):
            TB.write_table(bad, path, fmt)
        reader = spark.read.option("header", True) if fmt == "csv" else spark.read
        assert sorted(int(r["id"]) for r in reader.format(fmt).load(path).collect()) == list(range(5))
        TB.write_table(spark.range(7), path, fmt)
        assert reader.format(fmt).load(path).count() == 7
        assert os.listdir(os.path.dirname(path)) == ["t"]
    TB.write_table(spark.range(3), path, "parquet", mode="append")
    assert spark.read.parquet(path).count() == 10
