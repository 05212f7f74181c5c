"""Export folders and archives to tables."""

from __future__ import annotations

import glob
import gzip
import json
import zipfile
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from vitalgrid import bindings, build_daily_metrics, ingest
from vitalgrid.operators.dedup import keep_last
from vitalgrid.params import MetricParams
from vitalgrid.plans import ingest as plan
from vitalgrid.plans.metrics import load_metrics
from vitalgrid.plans.profile import profile
from vitalgrid.sources import export
from vitalgrid.sources.tables import read_table, read_tables, table_listing

TRACKED, PLAIN = "com.samsung.shealth.", "com.samsung.health."
HEART_RATE = f"{TRACKED}tracker.heart_rate"
STRESS = f"{TRACKED}stress"


def csv(folder, datatype_id, columns, lines, name=None, version="1", bom=False):
    folder.mkdir(parents=True, exist_ok=True)
    header = ",".join(f"{PLAIN}x.{c}" for c in columns)
    text = f"{datatype_id},{version}\n{header}\n" + "".join(f"{line}\n" for line in lines)
    path = folder / f"{name or datatype_id}.csv"
    path.write_text(text, encoding="utf-8-sig" if bom else "utf-8")
    return path


def blob(folder, *parts, data):
    path = folder.joinpath("jsons", *parts)
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(data)


def tables(spark, tmp_path, **options):
    ingest(spark, str(tmp_path / "in"), str(tmp_path / "out"), **options).collect()
    return read_tables(spark, str(tmp_path / "out"))


@pytest.fixture
def root(tmp_path):
    return tmp_path / "in" / "device_anna_20240201120000"


def test_quoted_commas_and_line_breaks(spark, tmp_path, root, rows):
    csv(root, HEART_RATE, ["start_time", "heart_rate", "binning_data", "end_time"], [
        '2023-11-20 21:15:30.250,72,"<p>one;\ntwo, three</p>",2023-11-20 21:25:30.250',
        '2023-11-20 22:15:30.250,49,"[no json, just text]",2023-11-20 22:25:30.250',
        '2023-11-20 23:15:30.250,93,"say ""hi""",2023-11-20 23:25:30.250'], bom=True)
    found = rows(tables(spark, tmp_path)["heart_rate"], "start_time")
    assert [r["bpm"] for r in found] == [72.0, 49.0, 93.0]
    assert found[0]["binning_data"] == "<p>one;\ntwo, three</p>" and found[0]["binning_data_json"] is None
    assert found[2]["binning_data"] == 'say "hi"'
    assert found[0]["end_time"] == datetime(2023, 11, 20, 21, 25, 30, 250000)
    assert {r["user_id"] for r in found} == {"anna"} and {r["export_ts"] for r in found} == {"20240201120000"}


def test_trailing_commas_short_and_wide_rows(spark, tmp_path, root, rows):
    csv(root, f"{TRACKED}sleep_combined", ["start_time", "sleep_score", "efficiency", "deviceuuid"], [
        "2023-07-09 22:41:00.000,67,91,watch seven,", "2023-07-10 21:05:00.000,55", "x,1,2,3,extra",
        "NA,null, 7 ,#N/A,"])
    report = rows(ingest(spark, str(tmp_path / "in"), str(tmp_path / "out")))
    assert report == [{"table_name": "sleep_combined", "row_count": 4, "wide_rows": 1}]
    assert not glob.glob(f"{spark.conf.get('spark.checkpoint.dir')}/vitalgrid-*/part=*")
    table = read_table(spark, str(tmp_path / "out"), "sleep_combined")
    assert table.columns == ["user_id", "export_ts", "start_time", "sleep_score", "efficiency", "deviceuuid"]
    cells = {tuple(r)[2:] for r in table.collect()}
    assert cells == {("2023-07-09 22:41:00.000", "67", "91", "watch seven"), ("2023-07-10 21:05:00.000", "55", None, None),
                     ("x", "1", "2", "3"), (None, None, " 7 ", None)}


def test_corrupt_times_keep_their_row(spark, tmp_path, root, rows):
    csv(root, STRESS, ["start_time", "end_time", "score"], [
        "2023-05-02 13:20:00.000,2023-05-02 13:45:00.000,17", "0723-04-05 01:02:03,9998-12-31 00:10:00,62"])
    found = rows(tables(spark, tmp_path)["stress"], "score")
    assert [(r["start_time"], r["score"]) for r in found] == [(datetime(2023, 5, 2, 13, 20), 17.0), (None, 62.0)]


def test_rows_without_time_collapse_to_the_last(spark, tmp_path, root, rows):
    csv(root, STRESS, ["start_time", "end_time", "score"], ["bad,bad,1", ",,2", "junk,,3"])
    assert [r["score"] for r in rows(tables(spark, tmp_path)["stress"])] == [3.0]


def test_newer_export_then_file_then_row_wins(spark, tmp_path, rows):
    old, new = (tmp_path / "in" / f"device_anna_{t}" for t in ("20240101000000", "20240301000000"))
    bob = tmp_path / "in" / "bob"
    columns = ["start_time", "score"]
    csv(new, STRESS, columns, ["2024-01-01 06:00:00,5"], name="a")
    csv(new, STRESS, columns, ["2024-01-01 06:00:00,6", "2024-01-01 06:00:00,7"], name="b")
    csv(old, STRESS, columns, ["2024-01-01 06:00:00,1", "2024-01-02 06:00:00,2"], name="z")
    csv(bob, STRESS, columns, ["2024-01-01 06:00:00,9"])
    found = rows(tables(spark, tmp_path)["stress"], "user_id", "start_time")
    assert [(r["user_id"], r["score"]) for r in found] == [("anna", 7.0), ("anna", 2.0), ("bob", 9.0)]


def test_layouts_of_one_table_are_united(spark, tmp_path, root, rows):
    csv(root, f"{TRACKED}tracker.oxygen_saturation", ["start_time", "spo2"], ["2024-01-01,97"], name="a")
    csv(root, f"{TRACKED}tracker.oxygen_saturation", ["oxygen_saturation", "extra", "start_time"],
        ["95,e,2024-01-02"], name="b", version="")
    csv(root, f"{TRACKED}tracker.oxygen_saturation", ["spo2", "oxygen_saturation", "start_time"],
        [",93,2024-01-03", "92,91,2024-01-04"], name="c")
    found = rows(tables(spark, tmp_path)["spo2"], "start_time")
    assert [(r["spo2"], r["extra"]) for r in found] == [(97.0, None), (95.0, "e"), (93.0, None), (92.0, None)]


def test_clashing_names_and_ids(spark, tmp_path, root):
    csv(root, f"{PLAIN}sleep_stage", ["stage", "Stage", "user_id", "start_time"], ["1,2,me,2024-01-01"], name="a")
    csv(root, f"{TRACKED}sleep_stage", ["stage", "start_time"], ["3,2024-01-02"], name="b")
    table = tables(spark, tmp_path)["sleep_stage"]
    assert table.columns == ["user_id", "export_ts", "stage", "Stage_2", "user_id_2", "start_time"]
    # two types share the table: the known one gives the types
    assert dict(table.dtypes)["stage"] == "double" and table.count() == 2


def test_header_only_file_gives_an_empty_table(spark, tmp_path, root):
    csv(root, STRESS, ["start_time", "score"], [])
    found = tables(spark, tmp_path)
    assert found["stress"].count() == 0 and "score" in found["stress"].columns


def test_any_width(spark, tmp_path, root, rows):
    """300 columns in one file, and a filled cell far beyond the header of another."""
    names = ["start_time", "score", *[f"c{i}" for i in range(298)]]
    csv(root, STRESS, names, ["2024-01-01,7," + ",".join(map(str, range(298))) + ","], name="wide")
    csv(root, f"{TRACKED}sleep_combined", ["start_time"], ["2024-01-01" + "," * 400 + "x", "2024-01-02" + "," * 400])
    report = rows(ingest(spark, str(tmp_path / "in"), str(tmp_path / "out")), "table_name")
    assert [(r["table_name"], r["row_count"], r["wide_rows"]) for r in report] == [("sleep_combined", 2, 1), ("stress", 1, 0)]
    found = rows(read_table(spark, str(tmp_path / "out"), "stress"))[0]
    assert found["score"] == 7.0 and found["c297"] == "297"
    zip_of(root, tmp_path / "zips" / "e.zip")
    again = rows(ingest(spark, str(tmp_path / "zips"), str(tmp_path / "z"), archives=True), "table_name")
    assert again == report
    assert rows(read_table(spark, str(tmp_path / "z"), "stress"))[0] == found


def test_missing_source(spark, tmp_path):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        ingest(spark, str(tmp_path / "nowhere"), str(tmp_path / "out"))


def blob_export(root):
    lines = [f"2024-01-01 0{i}:00:00,{50 + i},{cell}" for i, cell in enumerate(
        ["one", "one.json", "only_root", "packed", "broken", "absent", "", '"[{""k"": 1.0}]"', "../one", "torn"])]
    csv(root, HEART_RATE, ["start_time", "heart_rate", "binning_data"], lines)
    blob(root, HEART_RATE, "one.json", data=b'[{"from": "typed.json"}]')
    blob(root, HEART_RATE, "one", data=b'[{"from": "typed"}]')
    blob(root, "one", data=b'[{"from": "root"}]')
    blob(root, "only_root", data=b'{"from": "root"}')
    blob(root, HEART_RATE, "packed.json", data=gzip.compress('[{"p": "ž"}]'.encode()))
    blob(root, HEART_RATE, "broken.json", data=b"[{")
    blob(root, "broken", data=b'{"never": 1}')
    blob(root, HEART_RATE, "torn.json", data=gzip.compress(b"[]")[:-6])


BLOBS = [[{"from": "typed.json"}], [{"from": "typed.json"}], {"from": "root"}, [{"p": "ž"}], None, None, None,
         [{"k": 1.0}], None, None]


def decoded(table, rows):
    return [json.loads(r["binning_data_json"]) if r["binning_data_json"] else None
            for r in rows(table, "start_time")]


def test_blobs(spark, tmp_path, root, rows):
    """First existing candidate wins, even with bad JSON; gzip by its magic bytes."""
    blob_export(root)
    assert decoded(tables(spark, tmp_path)["heart_rate"], rows) == BLOBS


def test_one_blob_for_many_rows(spark, tmp_path, root):
    csv(root, HEART_RATE, ["start_time", "heart_rate", "binning_data"],
        [f"{1704100000000 + i * 1000},60,same" for i in range(500)])
    blob(root, HEART_RATE, "same.json", data=b"[1]")
    table = tables(spark, tmp_path)["heart_rate"]
    assert table.where("binning_data_json = '[1]'").count() == 500


def zip_of(folder, path):
    path.parent.mkdir(parents=True, exist_ok=True)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
        for file in sorted(folder.rglob("*")):
            if file.is_file():
                archive.write(file, file.relative_to(folder.parent))


def test_archives_give_the_same_tables(spark, tmp_path, rows):
    folder = tmp_path / "plain" / "device_anna_20240201120000"
    blob_export(folder)
    csv(folder, STRESS, ["start_time", "score"], ["2024-01-01,1,", '"2024-01-02","a,\nb"', "2024-01-03"], bom=True)
    zip_of(folder, tmp_path / "zips" / "export.zip")
    ingest(spark, str(tmp_path / "plain"), str(tmp_path / "a")).collect()
    report = rows(ingest(spark, str(tmp_path / "zips"), str(tmp_path / "b"), archives=True))
    assert report == [{"table_name": "heart_rate", "row_count": 10, "wide_rows": 0},
                      {"table_name": "stress", "row_count": 3, "wide_rows": 0}]
    for name in ("heart_rate", "stress"):
        a, b = (read_table(spark, str(tmp_path / x), name) for x in "ab")
        assert a.columns == b.columns
        assert rows(a, "start_time") == rows(b, "start_time")


def test_unsafe_archive_member_fails(spark, tmp_path):
    (tmp_path / "zips").mkdir()
    with zipfile.ZipFile(tmp_path / "zips" / "x.zip", "w") as archive:
        archive.writestr("../evil.csv", "a,1\nb\n")
    with pytest.raises(Exception, match="unsafe path in archive"):
        ingest(spark, str(tmp_path / "zips"), str(tmp_path / "out"), archives=True)


def test_folder_names(spark, tmp_path, rows):
    for name in ("device_jo_ann_20240201120000", "plain name+1%", "x_1"):
        csv(tmp_path / "in" / name, STRESS, ["start_time", "score"], ["2024-01-01,1"])
    found = rows(tables(spark, tmp_path)["stress"], "user_id")
    assert [(r["user_id"], r["export_ts"]) for r in found] == [
        ("jo_ann", "20240201120000"), ("plain name+1%", None), ("x_1", None)]


def test_ingest_to_metrics(spark, tmp_path, root):
    csv(root, HEART_RATE, ["start_time", "end_time", "heart_rate"],
        [f"2024-01-0{i} 07:00:00.000,2024-01-0{i} 07:10:00.000,{55 + i}" for i in range(1, 6)])
    csv(root, f"{TRACKED}sleep_combined", ["start_time", "end_time", "sleep_score"],
        [f"2024-01-0{i} 23:00:00.000,2024-01-0{i + 1} 07:00:00.000,{70 + i}," for i in range(1, 5)])
    csv(root, f"{TRACKED}tracker.pedometer_day_summary", ["day_time", "step_count"],
        [f"{1704067200000 + i * 86400000},{9000 + i}" for i in range(5)])
    found = tables(spark, tmp_path)
    assert "metrics_daily" not in found
    back = load_metrics(spark, str(tmp_path / "out")).orderBy("day").collect()
    assert sorted(back) == sorted(build_daily_metrics(found).collect())
    assert [r["steps"] for r in back] == [9000.0 + i for i in range(5)]
    assert [r["sleep_minutes"] for r in back] == [None] + [480.0] * 4
    assert [r["resting_hr"] for r in back] == [56.0, 57.0, 58.0, 59.0, 60.0]
    # stored metrics follow the tables when those are read again
    csv(root, STRESS, ["start_time", "score"], ["2024-01-09 07:00:00.000,30"])
    tables(spark, tmp_path)
    assert load_metrics(spark, str(tmp_path / "out")).count() == 9


def test_missing_table(spark, tmp_path):
    assert read_table(spark, str(tmp_path), "nothing") is None
    empty = read_table(spark, str(tmp_path), "nothing", "user_id long, score double")
    assert empty.count() == 0 and empty.columns == ["user_id", "score"]


def test_listing_and_profile(spark, tmp_path, rows):
    stress = spark.createDataFrame(
        [(1, "2024-01-01", "5"), (1, "junk", None), (1, None, "7"), (1, "2024-01-02", "x" * 90)],
        "user_id int, start_time string, score string")
    unowned = stress.select(F.when(F.col("score") == "5", F.col("user_id")).alias("user_id"))
    assert rows(table_listing({"stress": stress, "a": unowned}), "table_name") == [
        {"table_name": "a", "n_rows": 4, "n_unowned": 3, "columns": ["user_id"]},
        {"table_name": "stress", "n_rows": 4, "n_unowned": 0, "columns": ["user_id", "start_time", "score"]}]
    time, score = sorted(rows(profile({"stress": stress})), key=lambda r: r["column_name"], reverse=True)
    assert time == {"table_name": "stress", "column_name": "start_time", "n_rows": 4, "n_filled": 3, "n_times": 2,
                    "samples": ["2024-01-01", "junk", "2024-01-02"],
                    "times": ["2024-01-01 00:00:00", "2024-01-02 00:00:00"]}
    assert score["n_times"] is None and score["times"] == [] and score["samples"] == ["5", "7", "x" * 80 + "…"]


def test_keep_last_of_a_dominant_key(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 > 0, F.col("id")).alias("k"), F.col("id").alias("v"), F.lit("t").alias("t"))
    kept = keep_last(df, ["k"], ["v"])
    assert kept.count() == 2001 and kept.where("k is null").first()["v"] == 2997
    assert kept.columns == ["k", "v", "t"]


def test_any_number_of_layouts(spark):
    """20,001 headers of one type, each with its columns in another order."""
    cells = spark.range(20001).select(
        F.concat(F.lit("/in/"), "id").alias("export_dir"), F.col("id").cast("string").alias("below"),
        F.lit("f.csv").alias("file_name"), F.posexplode(F.array(
            F.array(F.lit(STRESS), F.lit("1")),
            F.when(F.col("id") % 2 == 0, F.array(F.lit("x.start_time"), F.lit("x.score"), F.concat(F.lit("x.c"), "id")))
            .otherwise(F.array(F.concat(F.lit("x.c"), F.col("id") % 7), F.lit("x.score"), F.lit("x.start_time"))),
            F.when(F.col("id") % 2 == 0, F.array(F.lit("2024-01-01"), F.lit("5"), F.lit("z")))
            .otherwise(F.array(F.lit("z"), F.lit("5"), F.lit("2024-01-01"))))).alias("position", "cells"))
    described = export.describe_rows(cells.withColumn("position", F.col("position").cast("long")))
    headers = plan.header_table(described)
    found = plan.columns_by_table(headers)["stress"][STRESS]
    assert len(found) == 2 + 10001 + 3 and set(found[:3]) == {"c1", "c3", "c5"}
    table = plan.build_table(described, headers, {STRESS: ["start_time", "score", "c3"]}, plan.spec_of(STRESS), None)
    assert table.where("score = 5 and start_time = timestamp_ntz'2024-01-01'").count() == 20001
    assert table.where("c3 = 'z'").count() == sum(i % 7 == 3 for i in range(1, 20001, 2))


def test_blank_id_is_unknown(spark, tmp_path, root, rows):
    csv(root, STRESS, ["start_time", "score"], ["2024-01-01,1"])
    csv(root, "", ["a"], ["1"], name="blank")
    found = tables(spark, tmp_path)
    assert sorted(found) == ["stress", "unknown"] and found["unknown"].first()["a"] == "1"


def test_persons_are_not_merged(spark, tmp_path, rows):
    """A dated folder above the root, a root below a blob folder, nested exports, an archive."""
    columns = ["start_time", "score"]
    top = tmp_path / "backup_all_20240101" / "jsons" / "exports"
    for i, person in enumerate(("anna", "bob", "team/cleo", "team/dan", "x_eve_20240101000000/data/part")):
        csv(top / person, STRESS, columns, [f"2024-01-01,{i}"])
    csv(top / "anna" / "jsons" / STRESS, STRESS, columns, ["2024-01-01,99"], name="no_table")
    assert [(r["user_id"], r["export_ts"], r["score"]) for r in rows(ingested(spark, top, tmp_path / "a"), "user_id")] == [
        ("anna", None, 0.0), ("bob", None, 1.0), ("eve", "20240101000000", 4.0), ("team/cleo", None, 2.0), ("team/dan", None, 3.0)]
    one = tmp_path / "device_fay_20240101000000"
    csv(one, STRESS, columns, ["2024-01-01,6"])
    assert [r["user_id"] for r in rows(ingested(spark, one, tmp_path / "b"))] == ["fay"]
    zip_of(one, tmp_path / "zips" / "old_all_20200101" / "gus.zip")
    assert [r["user_id"] for r in rows(ingested(spark, tmp_path / "zips", tmp_path / "c", archives=True))] == ["fay"]
    with zipfile.ZipFile(tmp_path / "zips" / "hal.zip", "w") as archive:
        archive.write(one / f"{STRESS}.csv", f"{STRESS}.csv")
    assert [r["user_id"] for r in rows(ingested(spark, tmp_path / "zips", tmp_path / "d", archives=True), "user_id")] == [
        "fay", "hal"]


def ingested(spark, root, out, **options):
    ingest(spark, str(root), str(out), **options).collect()
    return read_table(spark, str(out), "stress")


def test_failed_ingest_leaves_no_stage(spark, tmp_path, root, monkeypatch):
    csv(root, STRESS, ["start_time", "score"], ["2024-01-01,1"])
    before = set(glob.glob(f"{spark.conf.get('spark.checkpoint.dir')}/vitalgrid-*"))

    def fail(*args):
        raise RuntimeError("no table today")

    monkeypatch.setattr(plan, "build_table", fail)
    with pytest.raises(RuntimeError):
        ingest(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    assert set(glob.glob(f"{spark.conf.get('spark.checkpoint.dir')}/vitalgrid-*")) == before


def test_metrics_keep_their_profiles(spark, tmp_path, root):
    out = str(tmp_path / "out")
    csv(root, f"{TRACKED}sleep", ["start_time", "end_time", "sleep_duration"], ["2024-01-01 23:00,2024-01-02 06:00,420"])
    tables(spark, tmp_path)
    profiles = spark.createDataFrame([("anna", None, None, None, 600)],
                                     "user_id string, sex string, hr_max double, hr_rest double, target_sleep_min int")
    assert load_metrics(spark, out).first()["sleep_debt"] == 60.0
    assert load_metrics(spark, out, profiles=profiles).first()["sleep_debt"] == 180.0
    tables(spark, tmp_path)  # read again: the profiles stay
    assert load_metrics(spark, out).first()["sleep_debt"] == 180.0
    assert load_metrics(spark, out, MetricParams(sleep_debt_window=1, target_sleep_min=500)).first()["sleep_debt"] == 180.0
    other = profiles.withColumn("target_sleep_min", F.lit(430))
    assert load_metrics(spark, out, profiles=other).first()["sleep_debt"] == 10.0
    assert "_metrics" not in read_tables(spark, out)


def test_cells_of_records(spark, rows):
    records = ['a,b', '"x, ""y""\nz",2,,', ',,', '"",1', 'open "quote",2', '" kept ",', 'one']
    frame = spark.createDataFrame([(i, r) for i, r in enumerate(records)], "i int, r string")
    found = [r["c"] for r in rows(frame.select("i", export.record_cells(F.col("r")).alias("c")), "i")]
    assert found == [["a", "b"], ['x, "y"\nz', "2"], [], [None, "1"], ['open "quote"', "2"], [" kept "], ["one"]]


def test_files_of_events(spark, tmp_path, monkeypatch):
    """Files written by tasks lie and read as those of Spark's writer, of persons without id too; more persons come beside."""
    events = [(i, "2024-01-05 08:00:00", u, kind, 1.0, '{"k": "é"}')
              for i, (u, kind) in enumerate([(1, "view"), (1, "error"), (2, "view"), (None, "view"), (None, "error"), (4, "click"), (2, "view")] * 3)]
    spark.createDataFrame(events, "event_id long, ts string, user_id long, event_type string, value double, props string").withColumn(
        "ts", F.col("ts").cast("timestamp_ntz")).write.parquet(f"{tmp_path}/events.parquet")

    def lines(root):
        found = {}
        for file in sorted(Path(root).rglob("part-*.txt")):
            found.setdefault(str(file.parent.relative_to(root)), []).append(file.read_bytes())
        return found

    begun = []
    save = DataFrameWriter.text
    monkeypatch.setattr(DataFrameWriter, "text", lambda self, *a, **k: begun.append(a) or save(self, *a, **k))
    own = bindings.export_files(spark, str(tmp_path))
    assert not begun
    monkeypatch.setattr(bindings.re, "match", lambda *a: None)
    theirs = bindings.export_files(spark, str(tmp_path))
    monkeypatch.undo()
    assert lines(own) == lines(theirs) and len(lines(own)) == 5
    assert not [f for f in Path(own).rglob(".*") if not f.name.endswith(".crc")]
    one = bindings.export_files(spark, str(tmp_path), "user_id = 1")
    both = bindings.export_files(spark, str(tmp_path), "user_id = 2", one)
    assert both == one and set(lines(both)) == {k for k in lines(own) if "HIVE" not in k}
