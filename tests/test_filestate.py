"""State per file: only new and changed files are read, and merged states equal the profile of all files."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from homestats.operators import validate as V
from homestats.sources import files as FI
from homestats.sources import filestate as FS
from homestats.sources import tables as TB

FIELDS = ["City", "PostalCode", "PropertyType"]


def _month(folder, name, header, rows):
    path = folder / f"{name}.csv"
    path.write_text("\n".join([",".join(header), *(",".join(r) for r in rows)]) + "\n")
    return path


@pytest.fixture
def folder(tmp_path):
    d = tmp_path / "raw"
    d.mkdir()
    rows = [[str(i), "" if i % 3 == 0 else "Napa", f"2024-01-{1 + i % 28:02d}", str(1000 + i)] for i in range(60)]
    _month(d, "ExportSold202401", ["ListingKey", "City", "CloseDate", "ClosePrice"], rows)
    rows = [["2024-02-03" if i else "junk", str(100 + i), "NA" if i < 9 else "94501", str(5 * i)] for i in range(50)]
    _month(d, "ExportSold202402", ["CloseDate", "ListingKey", "PostalCode", "ClosePrice"], rows)
    _month(d, "ExportSold202403", ["ListingKey", "City", "CloseDate", "ClosePrice"], [])  # a header only
    return d


def _rows(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=repr)


def _same_as_whole(spark, folder, state):
    kept = FS.present_states(spark, str(folder), state)
    whole = TB.read_table(spark, str(folder)).withColumn("source", FI.source_name(F.col("source_path")))
    assert _rows(FS.source_profile(kept, FIELDS)) == _rows(V.per_source_profile(whole, "source", "CloseDate", FIELDS))
    assert _rows(FS.source_critical(kept, FIELDS)) == _rows(V.per_source_critical(whole, "source", FIELDS))
    assert _rows(FS.dataset_profile(kept)) == _rows(V.dataset_summary(whole.drop("source"), "source_path", "CloseDate"))
    return kept


def test_only_new_and_changed_files_are_read(spark, folder, tmp_path, monkeypatch):
    state, read = str(tmp_path / "state"), []
    original = FS.read_table
    monkeypatch.setattr(FS, "read_table", lambda s, paths, **kw: (read.append([p.rsplit("/", 1)[1][10:16] for p in paths]), original(s, paths, **kw))[1])

    def update(**kw):
        read.clear()
        n = FS.update_states(spark, str(folder), state, "CloseDate", FIELDS, numeric=["ClosePrice"], **kw)
        return n, [m for batch in read for m in batch]

    assert update(max_files=2) == (2, ["202401", "202402"])
    assert update(max_files=2) == (1, ["202403"])
    assert update() == (0, [])
    _same_as_whole(spark, folder, state)
    _month(folder, "ExportSold202404", ["ListingKey", "City", "CloseDate", "Extra"], [["7", "Napa", "2024-04-01", "x"], ["8", "", "", "y"]])
    assert update() == (1, ["202404"])
    _same_as_whole(spark, folder, state)
    _month(folder, "ExportSold202403", ["ListingKey", "City", "CloseDate"], [["9", "Sonoma", "2024-03-01"]])
    assert update() == (1, ["202403"])
    _same_as_whole(spark, folder, state)
    (folder / "ExportSold202401.csv").unlink()
    assert update() == (0, [])
    _same_as_whole(spark, folder, state)


def test_estimates_merge_over_files(spark, folder, tmp_path):
    state = str(tmp_path / "state")
    while FS.update_states(spark, str(folder), state, "CloseDate", FIELDS, numeric=["ClosePrice"], max_files=1):
        pass
    out = {(r["field"], r["p"]): r["estimate"] for r in FS.dataset_estimates(FS.present_states(spark, str(folder), state)).collect()}
    values = np.concatenate([1000 + np.arange(60.0), 5 * np.arange(50.0)])
    assert out[("distinct keys", None)] == pytest.approx(110, rel=0.05)
    for p in (0.25, 0.5, 0.75):
        assert abs(np.mean(values <= out[("ClosePrice", p)]) - p) <= 0.03


def test_an_empty_folder_and_a_failed_batch(spark, folder, tmp_path, monkeypatch):
    empty = tmp_path / "none"
    empty.mkdir()
    state = str(tmp_path / "state")
    assert FS.update_states(spark, str(empty), state, "CloseDate", FIELDS) == 0
    kept = FS.present_states(spark, str(empty), state)
    assert kept.count() == 0 and FS.source_profile(kept).count() == 0
    assert FS.dataset_profile(kept).first()["rows"] == 0
    original = FS._state_of
    broken = F.udf(lambda x: 1 / 0, "bigint")
    monkeypatch.setattr(FS, "_state_of", lambda *a: original(*a).withColumn("rows", broken("rows")))
    with pytest.raises(Exception, match="ZeroDivisionError"):
        FS.update_states(spark, str(folder), state, "CloseDate", FIELDS)
    monkeypatch.undo()
    assert FS.states(spark, state).count() == 0  # nothing of the failed batch is taken for a state
    assert FS.update_states(spark, str(folder), state, "CloseDate", FIELDS) == 3
    _same_as_whole(spark, folder, state)


def test_a_hot_month_is_several_files_and_one_export(spark, monkeypatch):
    """Rows of a month beyond the advisory size are written by several tasks; what the file queries tell doesn't change."""
    from homestats.plans import filequeries as Q
    from homestats.plans.catalog import BODIES
    from homestats.plans.relations import Relations
    from homestats.sources.testrel import relation

    sold, listed, rates = (relation(spark, "/root/testdata/sf0.001", n) for n in ("sold", "listed", "rates"))
    sold = sold.withColumn("ListingContractDate", F.when(F.col("ListingKey").cast("long") % 3 == 0, F.lit("1995-03-01")).otherwise(F.col("ListingContractDate").cast("string")))
    # a partition is split by the tasks that wrote it, so there must be several
    r = Relations.from_tables(spark, sold.repartition(8), listed, rates)
    names = ["source_files", "source_classes", "header_consistency", "source_check", "file_overview"]
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    roots, results = [], []
    try:
        for size in (before, "64k"):
            spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", size)
            root = Q.export_monthly(r)
            monkeypatch.setattr(Q, "export_monthly", lambda *a, root=root, **kw: root)
            roots.append(root)
            results.append({n: _rows(BODIES[n](r)) for n in names})
            monkeypatch.undo()
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    hot = [FI.list_sources(spark, f"{root}/sold/source=ExportSold199503").count() for root in roots]
    assert hot[0] == 1 and hot[1] > 1
    assert results[0] == results[1]
