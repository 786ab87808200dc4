"""Incremental ingest: each monthly file is processed once across runs."""

import os
import tempfile

from homestats.streaming.ingest import ingest_once

COLS = ["ListingKey", "PropertyType", "ClosePrice", "ListPrice", "ListingContractDate", "CloseDate",
        "Latitude", "Longitude"]


def _write(d, name, rows):
    with open(os.path.join(d, name), "w", encoding="utf-8") as f:
        f.write(",".join(COLS) + "\n")
        for r in rows:
            f.write(",".join(r) + "\n")


def test_ingest_is_incremental(spark):
    base = tempfile.mkdtemp(prefix="homestats-stream-")
    src, sink, ckpt = (os.path.join(base, x) for x in ("src", "sink", "ckpt"))
    os.makedirs(src)
    _write(src, "ExportSold202401.csv", [
        ("1", "Residential", "100", "90", "2024-01-05", "2024-02-01", "34", "-118"),
        ("2", "Residential", "0", "90", "2024-02-10", "2024-02-01", "0", "0"),
        ("3", "Land", "5", "5", "2024-01-01", "2024-01-02", "34", "-118"),
    ])
    ingest_once(spark, src, COLS, sink, ckpt)
    first = {r["ListingKey"]: r for r in spark.read.parquet(sink).collect()}
    assert set(first) == {"1", "2"}  # Residential only
    assert first["2"]["ClosePrice_invalid_flag"] == 1 and first["2"]["listing_after_close_flag"] == 1
    assert first["2"]["geo_sentinel_flag"] == 1 and first["1"]["any_invalid_flag"] == 0

    _write(src, "ExportSold202402.csv", [("4", "Residential", "70000000", "90", "2024-02-01", "2024-03-01", "", "")])
    ingest_once(spark, src, COLS, sink, ckpt)
    rows = spark.read.parquet(sink).collect()
    assert sorted(r["ListingKey"] for r in rows) == ["1", "2", "4"]  # no file processed twice
    new = [r for r in rows if r["ListingKey"] == "4"][0]
    assert new["ClosePrice_invalid_flag"] == 1 and new["geo_null_flag"] == 1
    assert new["source_file"] == "ExportSold202402.csv"


def test_headers_are_aligned_by_name(spark):
    base = tempfile.mkdtemp(prefix="homestats-stream-order-")
    src, sink, ckpt = (os.path.join(base, x) for x in ("src", "sink", "ckpt"))
    os.makedirs(src)
    with open(os.path.join(src, "ExportSold202401.csv"), "w", encoding="utf-8-sig") as f:
        f.write("ListingKey,PropertyType,ClosePrice,ListPrice\n1,Residential,100,90\n")
    with open(os.path.join(src, "ExportSold202402.csv"), "w", encoding="utf-8") as f:
        f.write('ListPrice,Extra,ClosePrice,PropertyType,ListingKey\n91,"a ""b"", c",NA,Residential,2\n')
    ingest_once(spark, src, COLS, sink, ckpt)
    rows = {r["ListingKey"]: r for r in spark.read.parquet(sink).collect()}
    assert (rows["1"]["ClosePrice"], rows["1"]["ListPrice"]) == ("100", "90")
    assert (rows["2"]["ClosePrice"], rows["2"]["ListPrice"]) == (None, "91")  # NA is a null token
    assert rows["2"]["ListingContractDate"] is None


def test_batches_admit_few_files_and_a_restart_goes_on(spark):
    base = tempfile.mkdtemp(prefix="homestats-stream-bound-")
    src, sink, ckpt = (os.path.join(base, x) for x in ("src", "sink", "ckpt"))
    os.makedirs(src)
    row = ("Residential", "100", "90", "2024-01-05", "2024-02-01", "34", "-118")
    for i in range(5):
        _write(src, f"ExportSold20240{i + 1}.csv", [(str(i), *row)])
    ingest_once(spark, src, COLS, sink, ckpt, max_files_per_trigger=2)
    assert sorted(os.listdir(sink)) == ["batch_id=0", "batch_id=1", "batch_id=2"]
    _write(src, "ExportSold202406.csv", [("5", *row)])
    ingest_once(spark, src, COLS, sink, ckpt, max_files_per_trigger=2)
    assert sorted(r["ListingKey"] for r in spark.read.parquet(sink).collect()) == list("012345")
    assert sorted(os.listdir(sink)) == [f"batch_id={i}" for i in range(4)]
