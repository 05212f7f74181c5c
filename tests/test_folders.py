"""Mounted folders: tasks list and read them as Spark's readers would, and the driver knows no file."""

from __future__ import annotations

import gzip
import os
import random
import shutil

import pyarrow.parquet as pq
import pytest

from vitalgrid.plans.ingest import stage_rows
from vitalgrid.sources import csv_chunks, export, folders
from vitalgrid.sources.blobs import attach_blobs

STRESS = "com.samsung.shealth.stress"


def write(folder, data, name="a.csv"):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_bytes(data if isinstance(data, bytes) else data.encode())
    return folder / name


@pytest.fixture
def tree(tmp_path):
    """Folders and files of every kind, most of them in the way."""
    root = tmp_path / "ex ports+%"
    top = f"{STRESS},1\nx.a,x.b\n"
    for i in range(30):
        write(root / f"device_p{i}_20240101000000", top + "".join(f'{j},"say ""{j}"",\n two"\n' for j in range(i)))
    write(root / "year=2024" / "month=1" / "_day=2" / "device_deep_20240101000000", top + "1,2\n\n\r\n3,4")
    write(root / "year=2024" / "month=1" / "_day=2" / "device_deep_20240101000000" / "more", top + "5,6\n", "b.csv")
    write(root / "device_marked_20240101000000", b"\xef\xbb\xbf" + top.replace("\n", "\r\n").encode() + b'1,"2\r\n3"\r\n4,"open\r\n5')
    write(root / "device_bytes_20240101000000", top.encode() + b"\xff\xfe,1\n\x00,2\n")
    write(root / "device_top_20240101000000", top, "only_header.csv")
    write(root / "device_top_20240101000000", f"{STRESS},1\n", "only_meta.csv")
    write(root / "device_top_20240101000000", "\n\n" + top + "7,8\n", "blank_begin.csv")
    write(root / "device_top_20240101000000", '"meta\n' + top + '7,"8\n', "open_meta.csv")
    for name in ("empty.csv", ".hidden.csv", "_hidden.csv", "_metadata.csv", "x.csv._COPYING_", "x.CSV", "notes.txt", "a.csv.gz"):
        write(root / "device_top_20240101000000", "" if name == "empty.csv" else top + "hid,den\n", name)
    write(root / "_hidden_20240101", top)
    write(root / "device_top_20240101000000" / ".x", top)
    blobs = root / "device_p1_20240101000000" / "jsons" / STRESS
    write(blobs, '{"k": 1}', "b.json")
    write(blobs, gzip.compress(b'{"k": 2}'), "c.json")
    write(blobs, top, "no_rows.csv")
    write(root / "é中_x", top + "9,9\n")
    elsewhere = tmp_path / "elsewhere"
    write(elsewhere / "device_linked_20240101000000", top + "a,b\n")
    (root / "link").symlink_to(elsewhere)
    (root / "broken.csv").symlink_to(tmp_path / "nothing")
    (root / "linked.csv").symlink_to(elsewhere / "device_linked_20240101000000" / "a.csv")
    return root


def everything(spark, root, rows_only):
    rows = [tuple(r) for r in export.read_export_rows(spark, root).collect()]
    if rows_only:
        return [sorted(rows, key=repr)]
    files = [tuple(r) for r in export.list_export_files(spark, root).collect()]
    blobs = export.read_export_blobs(spark, root)
    content = [(r["path"], bytes(r["content"])) for r in blobs.read(blobs.names).collect()]
    # Java names letters beyond ASCII as its locale says
    plain = [sorted((r for r in found if str(r).isascii() or "device_" in str(r)), key=repr) for found in (rows, files, content)]
    assert all(plain)
    return plain


@pytest.mark.parametrize(("size", "few"), [(None, 0), (300, 1000)])
def test_tasks_read_what_spark_reads(spark, tree, monkeypatch, size, few):
    """Whole files, and files in chunks of a few bytes, give the rows, files and blobs that Spark's readers give."""
    shutil.rmtree(tree / "é中_x")
    monkeypatch.setattr(folders, "FEW_ENTRIES", few)
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {n: spark.conf.get(n) for n in names}
    try:
        for n in names if size else ():
            spark.conf.set(n, str(size))
        found = everything(spark, str(tree), size is not None)
        monkeypatch.setattr(folders, "mounted", lambda *a: None)
        expected = everything(spark, str(tree), size is not None)
    finally:
        for n, v in before.items():
            spark.conf.set(n, v)
    if size:  # positions of chunks only grow
        expected[0], found[0] = (sorted(repr((*r[:4], *r[5:])) for r in x) for x in (expected[0], found[0]))
    for now, then in zip(found, expected):
        assert ([r for r in now if r not in then], [r for r in then if r not in now]) == ([], [])
        assert now == then
    assert all(f"_{p}_" in repr(found[0]) for p in ("p1", "deep", "marked", "linked"))


def test_names_beyond_ascii(spark, tree):
    assert "é中_x" in {r["user_id"] for r in export.read_export_rows(spark, str(tree)).collect()}


@pytest.mark.parametrize("until", [1, 3, 1000])
def test_folders_are_dealt_out(spark, tree, monkeypatch, until):
    """However few folders the first task looks for, all files are found, each once."""
    whole = sorted(os.path.join(at, name) for at, _, names in os.walk(tree) for name in names if name == "a.csv" and "/_hid" not in at and "/.x" not in at)
    few = folders.list_files(spark, [str(tree)], folders.name_pattern("a.csv")).collect()
    monkeypatch.setattr(folders, "FIRST_FOLDERS", until)
    monkeypatch.setattr(folders, "FEW_ENTRIES", 30)
    found = folders.list_files(spark, [str(tree)], folders.name_pattern("a.csv")).collect()
    assert sorted(folders.local(r["path"]) for r in found if "/link/" not in r["path"]) == whole and sorted(few) == sorted(found)


def test_the_driver_knows_no_file(spark, tree, monkeypatch):
    """Frames of rows, files and blobs hold no list of files; with one the driver's memory grew with each file and folder."""
    root = str(tree)
    monkeypatch.setattr(folders, "FEW_ENTRIES", 10)
    blobs = export.read_export_blobs(spark, root)
    for frame in (export.read_export_rows(spark, root), export.list_export_files(spark, root), blobs.names, blobs.read(blobs.names)):
        assert frame.inputFiles() == [] and frame.count()


def test_other_stores_are_left_to_spark(spark, tree, tmp_path):
    found = folders.mounted(spark, str(tree))
    assert found == str(tree) and folders.mounted(spark, f"file://{tree}/../{tree.name}") == found
    assert folders.mounted(spark, f"{tmp_path}/*") is None and folders.mounted(spark, f"{tmp_path}/absent") is None
    shutil.copytree(tree / "device_p1_20240101000000", tmp_path / "plain" / "device_p1_20240101000000")
    spark.sparkContext._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.store.link./in", f"file://{tmp_path}/plain")
    assert folders.mounted(spark, "viewfs://store/in") is None and folders.mounted(spark, "s3a://bucket/in") is None
    assert {r["user_id"] for r in export.list_export_files(spark, "viewfs://store/in").collect()} == {"p1"}
    assert export.read_export_rows(spark, "viewfs://store/in").count() == 2
    assert not csv_chunks.PLAIN_FILES.match("*.gz") and not csv_chunks.PLAIN_FILES.match("{a,b}.csv")


def test_many_small_files_are_few_batches(tmp_path):
    """Rows of small files are put together without arrays of each file: a file took more than a millisecond."""
    import pyarrow as pa

    paths = [folders.SCHEME + str(write(tmp_path / f"device_p{i}_20240101000000", f'{STRESS},1\nx.a\n{i}\n"a\nb"\n')) for i in range(2000)]
    found = list(csv_chunks._small_files(iter([pa.RecordBatch.from_pydict({"path": paths})]), csv_chunks.root_pattern(str(tmp_path))))
    assert len(found) == 1 and found[0].num_rows == 6000
    rows = pa.Table.from_batches(found).to_pylist()
    assert [(r["user_id"], r["row_no"], r["part"], r["record"]) for r in rows[:6]] == [
        ("p0", 1, "header", "x.a"), ("p0", 2, "data", "0"), ("p0", 3, "data", '"a\nb"'),
        ("p1", 1, "header", "x.a"), ("p1", 2, "data", "1"), ("p1", 3, "data", '"a\nb"')]


def test_whole_records_are_those_of_chunks():
    import pyarrow as pa

    rng = random.Random(3)
    pieces = [b"a", b",", b'"', b'""', b"\n", b"\r\n", b"\r", b'",', b',"']
    for _ in range(3000):
        data = b"".join(rng.choice(pieces) for _ in range(rng.randint(1, 30)))
        chunk = csv_chunks._Chunk(0, False)
        parts = chunk.records(folders._lines_of(data)) + chunk.rest(True)
        expected = sorted((int(p), t.as_py().rstrip("\r").encode()) for texts, at, _ in parts for t, p in zip(texts, at))
        texts, at = csv_chunks.whole_records(data)
        assert list(zip(at, texts)) == [r for r in expected if r[1]], data


def test_only_the_blobs_meant_are_read(spark, tree):
    """Names are compared first; a file that no cell means is not opened."""
    root = str(tree)
    blobs = export.read_export_blobs(spark, root)
    seen = []
    read = blobs.read
    rows = spark.createDataFrame(
        [(f"file:{root}/device_p1_20240101000000", "a.csv", i, STRESS, c) for i, c in enumerate(["b", "c.json", "absent", None])],
        "export_dir string, file_name string, row_no long, datatype_id string, cell string")

    def watched(paths):
        seen.append(sorted(r["path"].rpartition("/")[2] for r in paths.collect()))
        return read(paths)

    found = attach_blobs(rows, "cell", blobs._replace(read=watched)).orderBy("row_no").collect()
    assert [r["cell_json"] for r in found] == ['{"k":1}', '{"k":2}', None, None] and seen == [["b.json", "c.json"]]


def test_staged_files_are_read_by_several_tasks(spark, tmp_path):
    """A staged file holds several groups of rows: with one a table was the work of one task."""
    noise = "concat_ws('', transform(sequence(1, 10), i -> sha2(cast(id * 100 + i as string), 256)))"
    rows = spark.range(0, 30_000, 1, 1).selectExpr(
        "'u' as user_id", "'1' as export_ts", "'/d' as export_dir", "'f' as file_name", "id as row_no", "'data' as part",
        "'t' as datatype_id", "'1' as version", "1L as header_id", f"array({noise}) as cells")
    staged = stage_rows(rows, str(tmp_path / "rows"))
    assert staged.count() == 30_000
    groups = [pq.ParquetFile(folders.local(f).replace("//", "/")).num_row_groups for f in staged.inputFiles()]
    assert len(groups) == 1 and groups[0] > 1
