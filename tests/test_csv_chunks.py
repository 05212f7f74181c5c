"""Large CSV files in chunks, long cells, wide files, roots written in any way."""

from __future__ import annotations

import csv
import io
import os
import random
import re
import time
import zipfile

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from vitalgrid import ingest
from vitalgrid.functions.names import names_of
from vitalgrid.sources import csv_chunks, export
from vitalgrid.sources.tables import read_table

STRESS = "com.samsung.shealth.stress"


def write(folder, text, name="a.csv"):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_bytes(text if isinstance(text, bytes) else text.encode())
    return folder / name


def read(spark, root):
    found = export.read_export_rows(spark, str(root)).collect()
    return sorted(((r["export_dir"], r["file_name"], r["row_no"], r["part"], r["cells"]) for r in found), key=lambda r: r[:3])


def plain(text):
    """The records of a file by the standard reader, blank cells as null, blank ones at the end cut."""
    out = []
    for row in csv.reader(io.StringIO(text, newline="")):
        if row:
            while row and not row[-1]:
                row.pop()
            out.append([c or None for c in row])
    return out


def some_text(rng, rows):
    cells = ["", "1", "two words", '"quoted"', '"a, b"', '"say ""hi"""', '"two\nlines"', '"x\r\ny"', '"\n"', '""', '5" disk', 'é中',
             '"' + "long, " * 30 + '"', '"{""k"": [1,\n2,\n3]}"', '"tail" after']
    lines = [",".join(rng.choice(cells) for _ in range(rng.randint(1, 6))) for _ in range(rows)]
    return f"{STRESS},1\nx.a,x.b,x.c\n" + rng.choice(["\n", "\r\n"]).join(lines) + rng.choice(["", "\n", "\r\n"])


@pytest.fixture
def small_chunks(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {n: spark.conf.get(n) for n in names}

    def chosen(size):
        for n in names:
            spark.conf.set(n, str(size))

    yield chosen
    for n, v in before.items():
        spark.conf.set(n, v)


@pytest.mark.parametrize("size", [61, 300, 3000])
def test_chunks_give_the_rows_of_one_task(spark, tmp_path, small_chunks, size):
    """Chunks that begin anywhere: in quoted cells, in headers, at line ends; rows in the order of the file."""
    rng = random.Random(size)
    texts = {f"device_p{i}_20240101000000": some_text(rng, rng.choice([0, 3, 60])) for i in range(8)}
    texts["device_q_20240101000000"] = f'{STRESS},1\n"x.a\n{"long header " * 20}",x.b\n"' + "in one cell\n" * 80 + '",2\n3,4\n'
    texts["device_r_20240101000000"] = f"{STRESS},1\n"
    texts["device_s_20240101000000"] = ""
    for name, text in texts.items():
        write(tmp_path / name, text)
    whole = read(spark, tmp_path)
    small_chunks(size)
    parts = read(spark, tmp_path)
    assert [(r[0], r[3], r[4]) for r in parts] == [(r[0], r[3], r[4]) for r in whole]
    for name, text in texts.items():
        own = [r for r in parts if r[0].endswith(name)]
        assert [r[4] for r in own] == plain(text)[1:]
        assert [r[3] for r in own[:1]] == ["header"] * bool(own) and {r[3] for r in own[1:]} <= {"data"}
    lines = spark.read.option("lineSep", "\n").text(f"{tmp_path}/device_q_20240101000000")
    assert size > 500 or lines.rdd.getNumPartitions() > 1


def test_records_of_lines_are_few_arrays():
    """Records of several lines side by side, and the rows of small files, are handed on together."""
    lines = pa.array([x for i in range(500) for x in (f'{i},"b', 'c"')])
    found = csv_chunks._Chunk(0, False).records(lines)
    assert [(len(t), piece) for t, _, piece in found] == [(500, csv_chunks.WHOLE)]
    assert found[0][0][499].as_py() == '499,"b\nc"' and found[0][1].tolist() == list(range(0, 1000, 2))
    small = [pa.RecordBatch.from_pydict({"record": [str(i)] * 30}) for i in range(1000)]
    together = list(csv_chunks._together(iter(small)))
    assert len(together) <= 4 and [x for b in together for x in b["record"].to_pylist()] == [str(i) for i in range(1000) for _ in range(30)]


def test_many_folders_are_few_tasks(spark, tmp_path):
    """Neither listing nor reading takes a task for each folder."""
    for i in range(200):
        write(tmp_path / f"device_p{i}_20240101000000", f"{STRESS},1\nx.a\n{i}\n")
    spark.sparkContext.setJobGroup("listing", "folders")
    found = export.list_export_files(spark, str(tmp_path))
    rows = export.read_export_rows(spark, str(tmp_path))
    assert {r["user_id"] for r in found.collect()} == {f"p{i}" for i in range(200)} and rows.count() == 400
    tracker = spark.sparkContext.statusTracker()
    stages = [s for job in tracker.getJobIdsForGroup("listing") for s in tracker.getJobInfo(job).stageIds]
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert stages and max(tracker.getStageInfo(s).numTasks for s in stages if tracker.getStageInfo(s)) <= 8 * 4


def test_files_since_a_time(spark, tmp_path):
    for i in range(3):
        file = write(tmp_path / f"device_p{i}_20240101000000", f"{STRESS},1\nx.a\n{i}\n")
        os.utime(file, (1_700_000_000 + i, 1_700_000_000 + i))
    written = {r["user_id"]: r["written"] for r in export.list_export_files(spark, str(tmp_path)).collect()}
    found = export.read_export_rows(spark, str(tmp_path), since=written["p1"]).collect()
    assert {r["user_id"] for r in found} == {"p1", "p2"}


def test_many_chunks_are_joined(spark, tmp_path, small_chunks, monkeypatch):
    """More chunks of large files than each task is told of."""
    text = some_text(random.Random(5), 200)
    write(tmp_path / "device_p_20240101000000", text)
    small_chunks(200)
    monkeypatch.setattr(csv_chunks, "TOLD_CHUNKS", 3)
    assert [r[4] for r in read(spark, tmp_path)] == plain(text)[1:]


def test_states_of_lines():
    for line, outside, inside in [("a,b", False, True), ('"a', True, False), ('a,"b', True, False), ('a"b', False, False),
                                  ('x","y', True, True), ('"a""', True, False), ('""', False, True), ('""""', False, True), ('a,""', False, False),
                                  ('5" disk,"open', True, False), ('"a" b,c', False, False), ("", False, True)]:
        assert csv_chunks.ends_open(line.encode(), False) == outside, line
        after = csv_chunks.ends_open(line.encode(), True)
        one = list(csv.reader(io.StringIO(f'"begin\n{line}\nend', newline="")))
        assert after == (len(one) == 1), line


def test_chunk_of_lines():
    lines = pa.array(['a,"b', "c", 'd",e', "f", 'g,"h'])
    chunk = csv_chunks._Chunk(100, False)
    found = chunk.records(lines) + chunk.rest(False)
    assert [(t.to_pylist(), at.tolist(), piece) for t, at, piece in found] == [
        (["f"], [104], csv_chunks.WHOLE), (['a,"b\nc\nd",e'], [101], csv_chunks.WHOLE), (['g,"h'], [105], csv_chunks.BEGIN)]
    inside = csv_chunks._Chunk(0, True)
    found = inside.records(pa.array(["x", 'y",z', "w"])) + inside.rest(False)
    assert [(t.to_pylist(), np.asarray(at).tolist(), piece) for t, at, piece in found] == [
        (["w"], [2], csv_chunks.WHOLE), (['x\ny",z'], [0], csv_chunks.END)]


def cell_of(spark, tmp_path, body):
    root = tmp_path / f"device_{abs(hash(body)) % 10 ** 6}_20240101000000"
    write(root, f"{STRESS},1\nx.start_time,x.note,x.score\n{body}\n")
    return [r[4] for r in read(spark, root)][1:]


def test_long_cells(spark, tmp_path):
    """Cells of megabytes: quoted with doubled quotes, commas and line breaks, unquoted, and one that is never closed."""
    json = '{""k"": [1, 2],\n""t"": ""' + "x" * 40 + '""},\n'
    began = time.time()
    many = json * (10_000_000 // len(json))
    assert cell_of(spark, tmp_path, f'2024-01-01,"{many}",5') == [["2024-01-01", many.replace('""', '"'), "5"]]
    assert cell_of(spark, tmp_path, f"2024-01-01,{'y' * 1_000_000},6") == [["2024-01-01", "y" * 1_000_000, "6"]]
    assert cell_of(spark, tmp_path, f'2024-01-01,"{"z" * 3000},7') == [["2024-01-01", "z" * 3000 + ",7"]]
    assert cell_of(spark, tmp_path, '2024-01-01,"open,8\n2024-01-02,b,9') == [["2024-01-01", "open,8\n2024-01-02,b,9"]]
    assert time.time() - began < 60


def test_wide_files(spark, tmp_path, rows):
    """5,000 columns, folder and archive alike; names and places are worked out once for each header."""
    names = ["start_time", "score", *[f"c{i}" for i in range(4996)], "c7", "C7"]
    line = "2024-01-01,7," + ",".join(str(i) for i in range(4998))
    write(tmp_path / "in" / "device_a_20240101000000", f"{STRESS},1\n" + ",".join(f"x.{n}" for n in names) + f"\n{line}\n", "s.csv")
    began = time.time()
    ingest(spark, str(tmp_path / "in"), str(tmp_path / "out")).collect()
    assert time.time() - began < 90
    found = rows(read_table(spark, str(tmp_path / "out"), "stress"))[0]
    assert (found["score"], found["c4995"], found["c7_2"], found["C7_3"]) == (7.0, "4995", "4996", "4997")
    (tmp_path / "zips").mkdir()
    with zipfile.ZipFile(tmp_path / "zips" / "device_a_20240101000000.zip", "w") as archive:
        archive.write(tmp_path / "in" / "device_a_20240101000000" / "s.csv", "s.csv")
    ingest(spark, str(tmp_path / "zips"), str(tmp_path / "z"), archives=True).collect()
    assert rows(read_table(spark, str(tmp_path / "z"), "stress"))[0] == found


def test_names_are_linear_in_the_width():
    began = time.time()
    found = names_of([f"a.b{i % 5}.c{i % 50_000}" for i in range(200_000)])
    assert time.time() - began < 5 and len(set(found)) == 200_000
    assert names_of(["a.b.start_time", "a.time", "x.value", "Stage", "STAGE", "user_id", " ", None, "z", "", None]) == [
        "start_time", "a_time", "x_value", "Stage", "STAGE_2", "user_id_2", "", "_2", "z"]


@pytest.mark.parametrize(("root", "path", "below"), [
    ("/home/b", "file:///home/b/p/f.csv", "p/f.csv"), ("/home/a/../b", "file:///home/b/p/f.csv", "p/f.csv"),
    ("/home/./b/", "file:/home/b/p/f.csv", "p/f.csv"), ("/data/*/in", "file:///data/x_all_20240101/in/p/f.csv", "p/f.csv"),
    ("/data/{a,b}/in?", "file:///data/b/in2/p/f.csv", "p/f.csv"), ("/data/[ab]c", "/data/bc/f.csv", "f.csv"),
    ("s3a://bucket/exports", "s3a://bucket/exports/p/f.csv", "p/f.csv"), ("hdfs://host:1/", "hdfs://host:1/p/f.csv", "p/f.csv"),
    ("./exports", "hdfs://h/user/me/exports/p/f.csv", "p/f.csv"), ("../exports/", "hdfs://h/user/exports/p/f.csv", "p/f.csv"),
    ("/a,b (1)+", "file:///a,b (1)+/p/f.csv", "p/f.csv"), ("/x/exports", "file:///x/exports/x/exports/f.csv", "x/exports/f.csv"),
])
def test_roots(spark, root, path, below):
    pattern = csv_chunks.root_pattern(root)
    assert re.sub(pattern, "", path, count=1) == below
    assert spark.range(1).select(F.regexp_replace(F.lit(path), pattern, "")).first()[0] == below


def test_roots_of_exports(spark, tmp_path, monkeypatch):
    """A dated folder above the root names no person, however the root is written."""
    top = tmp_path / "backup_all_20240101"
    write(top / "in" / "anna", f"{STRESS},1\nx.start_time,x.score\n2024-01-01,1\n")
    monkeypatch.chdir(tmp_path)
    for i, root in enumerate((f"{top}/in", "./backup_all_20240101/in", f"{tmp_path}/backup_*/in", f"{top}/in/../in", "backup_all_20240101/in/.")):
        if "./" in root or root.startswith("backup"):
            if not os.path.samefile(root, top / "in"):
                continue
            if spark.range(1).count() and not _reads(spark, root):  # the JVM keeps the folder it began in
                continue
        people = {r["user_id"] for r in export.read_export_rows(spark, root).collect()}
        assert people == {"anna"}, (i, root)


def _reads(spark, root):
    try:
        return spark.read.option("recursiveFileLookup", True).text(root).count() > 0
    except Exception:
        return False
