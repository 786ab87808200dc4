import base64
import gzip
import hashlib
import os

import pytest
from pyspark.sql import functions as F

from homestats.llm import warc
from homestats.llm.catalog import QUERIES

PAGES = [
    (1, "http://a/1", "<p>one</p>"), (2, "http://a/2\r\nWARC-Type: evil", "<p>one</p>"), (3, None, "<p>one</p>"),
    (4, "u", None), (5, "u", ""), (6, "é", "WARC/1.1\r\nWARC-Type: response\r\n\r\n\r\n\r\n" * 3), (7, "u", "x" * 300_000),
    (7, "u", "x" * 300_000), (8, "u", "x" * 300_000), (None, "n", "<p>one</p>"), (None, None, "only here"), (9, "u", "é\x00 "),
]


@pytest.fixture
def pages(spark):
    return spark.createDataFrame(PAGES, "page_id long, url string, html string")


def expected(rows, min_bytes=0):
    data = [(i, (h or "").encode()) for i, _, h in rows]
    out = []
    for i, p in data:
        ids = [j for j, q in data if q == p and j is not None]
        kept = max(ids) if ids else None
        revisit = len(p) >= min_bytes and kept is not None and i != kept
        out.append((i, len(p), base64.b32encode(hashlib.sha1(p).digest()).decode(), "revisit" if revisit else "response", kept if revisit else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("compression", ["none", "gzip"])
@pytest.mark.parametrize("min_bytes", [0, 11])
def test_round_trip(spark, pages, tmp_path, compression, min_bytes):
    path = str(tmp_path / "w")
    warc.write_pages(pages.repartition(3).withColumn("payload", F.lit("mine")), path, min_bytes, compression)
    back = warc.read_pages(spark, path)
    rows = back.collect()
    got = sorted(((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in rows), key=repr)
    assert got == expected(PAGES, min_bytes)
    texts = {(i, (h or "").encode()) for i, _, h in PAGES}
    for r in rows:
        if r["record_type"] == "response":
            assert (r["page_id"], bytes(r["payload"])) in texts
        else:
            assert r["payload"] is None
    assert not [f for f in os.listdir(path) if f.startswith("_")]
    files = [f for f in os.listdir(path) if not f.startswith(".")]
    assert files and all(f.endswith(".warc.gz" if compression == "gzip" else ".warc") for f in files)


def test_predicates_are_pushed_and_payloads_passed_over(spark, pages, tmp_path):
    path = str(tmp_path / "w")
    warc.write_pages(pages, path, compression="none")
    warc.register(spark)
    read = spark.read.format("warc").option("payload", "false").load(path)
    for condition in (
        "record_type = 'revisit'", "record_type IN ('warcinfo', 'revisit')", "target_uri IS NULL", "NOT target_uri = 'u'",
        "target_uri LIKE 'http%'", "target_uri LIKE '%2%'", "refers_to IS NOT NULL AND target_uri <= 'u'", "target_uri > 'u'",
        "payload_bytes > 5", "target_uri <=> NULL", "record_id LIKE '%8>'",
    ):
        plain = [r for r in spark.createDataFrame(read.collect(), read.schema).filter(condition).collect()]
        assert sorted(map(repr, read.filter(condition).collect())) == sorted(map(repr, plain)), condition
    reader = warc.WarcReader({"path": path, "payload": "false"})
    rest = list(reader.pushFilters([warc.EqualTo(("record_type",), "revisit"), warc.EqualTo(("payload_bytes",), 3)]))
    assert rest == [warc.EqualTo(("payload_bytes",), 3)]
    got = [r for p in reader.partitions() for b in reader.read(p) for r in b.to_pylist()]
    assert got and all(r["record_type"] == "revisit" and r["payload"] is None for r in got)


def test_partitions_group_files_by_size(tmp_path):
    for i, n in enumerate((10, 200, 30, 40)):
        (tmp_path / f"{i}.warc").write_bytes(b"x" * n)
    (tmp_path / "_temporary").mkdir()
    (tmp_path / "_temporary" / "x.warc").write_bytes(b"x")
    groups = warc.WarcReader({"path": str(tmp_path), "splitBytes": "100"}).partitions()
    assert [[os.path.basename(f) for f in g.files] for g in groups] == [["1.warc"], ["3.warc", "2.warc", "0.warc"]]


def test_reads_archives_of_others(spark, tmp_path):
    record = (
        b"WARC/1.0\r\nwarc-type: resource\r\nWARC-Target-URI: urn:x\r\nContent-Type: text/plain\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    )
    with gzip.open(tmp_path / "a.warc.gz", "wb") as f:
        f.write(record * 2)
    warc.register(spark)
    rows = spark.read.format("warc").load(str(tmp_path)).collect()
    assert [(r["record_type"], r["target_uri"], r["payload_bytes"], bytes(r["payload"])) for r in rows] == [("resource", "urn:x", 5, b"hello")] * 2


def test_empty_table(spark, tmp_path):
    path = str(tmp_path / "w")
    warc.write_pages(spark.createDataFrame([], "page_id long, url string, html string"), path)
    assert warc.read_pages(spark, path).count() == 0


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url", "html").collect()]
    got = [tuple(r) for r in QUERIES["op7_warc_pages"](spark, sf).collect()]
    assert sorted(got, key=repr) == expected(rows)
