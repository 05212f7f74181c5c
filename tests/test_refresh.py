"""Incremental ingest: what a refresh leaves equals an ingest of everything, and reads only what changed."""

from __future__ import annotations

import os
import shutil

import pytest
from pyspark.sql import functions as F

from vitalgrid import ingest
from vitalgrid.plans import refresh as r
from vitalgrid.plans.metrics import load_metrics
from vitalgrid.sources import export
from vitalgrid.sources.csv_chunks import FILE_COLUMNS, read_records
from vitalgrid.sources.tables import committed, read_table, read_tables, remove_old_versions

HEART_RATE, STRESS, OTHER = (f"com.samsung.shealth.{x}" for x in ("tracker.heart_rate", "stress", "some_thing"))


def write(folder, datatype_id, columns, lines):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / f"{datatype_id}.csv").write_text(f"{datatype_id},1\n{columns}\n" + "".join(f"{line}\n" for line in lines))


def held(spark, out):
    """All tables as columns with their types, and rows."""
    return {name: (df.dtypes, sorted(map(repr, df.collect()))) for name, df in read_tables(spark, out).items()}


@pytest.fixture
def store(spark, tmp_path, monkeypatch):
    """Three persons' exports, refreshed once, with metrics; gives a check of a refresh against a whole ingest."""
    root, out = tmp_path / "in", str(tmp_path / "out")
    for i, person in enumerate(("ann", "bob", "cy")):
        export_dir = root / f"wear_{person}_20240101000000"
        write(export_dir, HEART_RATE, "start_time,heart_rate,binning_data",
              [f"2024-01-{d:02d} 08:00:00.000,{50 + i + d},b{d}.json" for d in range(1, 6)])
        blobs = export_dir / "jsons" / HEART_RATE
        blobs.mkdir(parents=True)
        (blobs / "b1.json").write_text(f'[{{"x": {i}}}]')
    write(root / "wear_cy_20240101000000", OTHER, "a,b", ["1,x"])
    read = []
    rows = export.read_export_rows

    def watched(spark, root, files, within=None):
        read.append(within)
        return rows(spark, root, files, within)

    monkeypatch.setattr(export, "read_export_rows", watched)
    count = [0]

    def refreshed(expected_persons, metrics=False):
        report = r.refresh(spark, str(root), out, buckets=8).collect()
        assert {x["persons"] for x in report} == ({expected_persons} if expected_persons else set())
        count[0] += 1
        whole = str(tmp_path / f"whole{count[0]}")
        last = read[-1] if read else None
        ingest(spark, str(root), whole)
        if metrics:
            load_metrics(spark, whole)
            load_metrics(spark, out)
            newest = [sorted(map(repr, read_table(spark, x, "_metrics_newest").collect())) for x in (out, whole)]
            assert newest[0] == newest[1]
        assert held(spark, out) == held(spark, whole)
        return last

    r.refresh(spark, str(root), out, buckets=8)
    assert read == [None]
    return root, out, refreshed


def test_new_export_of_one_person(spark, store):
    root, out, refreshed = store
    refreshed(0, metrics=True)
    before = committed(spark, out)["heart_rate"]["buckets"]
    # corrects a day, adds one, with one more column
    write(root / "wear_bob_20240301000000", HEART_RATE, "start_time,heart_rate,comment",
          ["2024-01-02 08:00:00.000,99,again", "2024-01-09 08:00:00.000,60,"])
    within = refreshed(1, metrics=True)
    assert [os.path.basename(f) for f in within] == ["wear_bob_20240101000000", "wear_bob_20240301000000"]
    after = committed(spark, out)["heart_rate"]["buckets"]
    assert sum(after[b] != before.get(b) for b in after) == 1 and len(after) == len(before)
    assert "comment" in read_tables(spark, out)["heart_rate"].columns
    kept = held(spark, out)
    assert remove_old_versions(spark, out) and held(spark, out) == kept


def test_changed_and_vanished_files(spark, store):
    root, out, refreshed = store
    # a blob of ann's is written again; what is gone: cy's only table of its kind, then all of cy
    (root / "wear_ann_20240101000000" / "jsons" / HEART_RATE / "b1.json").write_text('[{"x": 17, "y": 2}]')
    (root / "wear_cy_20240101000000" / f"{OTHER}.csv").unlink()
    refreshed(2)
    assert "some_thing" not in read_tables(spark, out)
    shutil.rmtree(root / "wear_cy_20240101000000")
    refreshed(1)
    assert {x["user_id"] for x in read_tables(spark, out)["heart_rate"].select("user_id").collect()} == {"ann", "bob"}


def test_other_types_and_whole_ingests_read_all(spark, store, tmp_path):
    root, out, refreshed = store
    # a table that only an unknown type filled gets the types of a known one
    write(root / "wear_ann_20240101000000", "com.samsung.health.stress", "start_time,score", ["2024-01-01,5"])
    refreshed(1)
    write(root / "wear_bob_20240101000000", STRESS, "start_time,score", ["2024-01-01 08:00:00.000,7"])
    refreshed(3)
    ingest(spark, str(root), out)
    refreshed(3)


def test_many_changed_folders(spark, store, monkeypatch):
    """More folders than a read names: files older than all of the changed persons' are left out."""
    root, out, refreshed = store
    rows, persons = export.read_export_rows, []

    def watched(spark, root, files, within=None, since=None):
        if since is None:
            return rows(spark, root, files, within)
        found = read_records(spark, root, files, within, since).select(*FILE_COLUMNS, export.record_cells(F.col("record")).alias("cells"))
        persons.append({x["user_id"] for x in found.select("user_id").distinct().collect()})
        return found

    monkeypatch.setattr(export, "read_export_rows", watched)
    monkeypatch.setattr(r, "TOLD_FOLDERS", 0)
    for file in root.rglob("*.csv"):
        os.utime(file, (1_600_000_000, 1_600_000_000))
    refreshed(3)
    write(root / "wear_dan_20240101000000", HEART_RATE, "start_time,heart_rate", ["2024-01-02 08:00:00.000,70"])
    refreshed(1)
    assert persons[-1] == {"dan"}


def test_folders_to_read(spark):
    names = "file string, user_id string, export_dir string, stamp long"
    changed = spark.createDataFrame([("a",)], "user_id string")

    def of(*folders):
        return r._folders(spark.createDataFrame([(f, "a", f, 1) for f in folders], names), changed)

    assert of("/in/a", "/in/a/b", "/in/a-b", "/in/ab") == ["/in/a-b", "/in/a", "/in/ab"]
    assert of("/in/a*", "/in/b") is None and of() == []


def test_changed_persons(spark):
    def ledger(*rows):
        return spark.createDataFrame([(f, u, "", s) for f, u, s in rows], "file string, user_id string, export_dir string, stamp long")

    before = ledger(("1", "same", 1), ("2", "changed", 1), ("3", "gone", 1), ("4", "moved", 1))
    now = ledger(("1", "same", 1), ("2", "changed", 2), ("4", "to", 1), ("5", "new", 1))
    assert sorted(x[0] for x in r.changed_persons(before, now).collect()) == ["changed", "gone", "moved", "new", "to"]
