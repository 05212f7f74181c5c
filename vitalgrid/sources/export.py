"""Reading export folders and archives into positional rows of text cells.

Each CSV file starts with a metadata line (type id, version), then a header line, then data rows
that may be longer or shorter than the header and whose quoted cells may hold line breaks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitalgrid.shipping import LISTING_TASKS, few_listing_tasks, in_few_tasks
from vitalgrid.sources import folders
from vitalgrid.sources.csv_chunks import (
    BLOB_FOLDER, FILE_COLUMNS, header_id, person_of, read_records, root_pattern, type_of)

CELL_SCHEMA = "export_dir string, below string, file_name string, position long, cells array<string>"
ARCHIVE_BATCH_ROWS = 5000
#: larger files do not fit one cell of a table
BINARY_FILE_LIMIT = 2 ** 31 - 1
#: header and data rows of files; ``row_no`` grows along a file, equal headers have one ``header_id``
ROW_SCHEMA = ("user_id string, export_ts string, export_dir string, file_name string, row_no long, part string, "
              "datatype_id string, version string, header_id long, cells array<string>")


def file_path() -> Column:
    """Decoded path of the file a row comes from."""
    encoded = F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))
    return F.url_decode(encoded)


def below_root(path: Column, root: str) -> Column:
    """The part of ``path`` below ``root``: what lies above says nothing about an export."""
    return F.regexp_replace(path, root_pattern(root), "")


def _folder_of(path: Column) -> Column:
    return F.regexp_replace(path, r"/?[^/]*$", "")


def _in_blob_folder(below: Column) -> Column:
    return F.concat(F.lit("/"), below).contains(f"/{BLOB_FOLDER}/")


def record_cells(record: Column) -> Column:
    """The cells of one CSV record, however many: quoted ones without their quotes, blank ones null,
    blank ones at the end left out. What follows closed quotes belongs to the cell; open ones take the rest."""
    # with a comma before it every cell is a match of its own, an empty first one too; possessive groups are
    # loops, where others would recurse once for each character of a cell
    split = F.regexp_extract_all(F.concat(F.lit(","), record), F.lit(r'(?s),("(?:[^"]++|"")*+(?:"[^,]*+|\z)|[^,]*+)'), 1)
    cells = F.transform(split, lambda c: F.when(
        c.startswith('"'), F.replace(F.regexp_replace(c, r'(?s)^"((?:[^"]++|"")*+)"?', "$1"), F.lit('""'), F.lit('"'))
    ).otherwise(c))
    cells = F.transform(cells, lambda c: F.when(c != "", c))
    return without_blank_end(cells)


def without_blank_end(cells: Column) -> Column:
    filled = F.transform(cells, lambda c, i: F.when(c.isNotNull(), i + 1))
    return F.slice(cells, F.lit(1), F.coalesce(F.array_max(filled), F.lit(0)))


def read_export_rows(
    spark: SparkSession, root: str, files: str = "*.csv", within: list[str] | None = None, since: int | None = None,
) -> DataFrame:
    """Every row of every CSV file below ``root``, blob folders aside: see ``ROW_SCHEMA``.

    Rows may be of any width and cells of any length. A large file is many read tasks, although quoted cells
    may hold line breaks (see :mod:`vitalgrid.sources.csv_chunks`). A cell whose quotes are not closed
    takes the rest of its file. ``within`` names folders below the root if only their files are wanted,
    ``since`` the time in microseconds from which on files were written that are.
    """
    return read_records(spark, root, files, within, since).select(*FILE_COLUMNS, record_cells(F.col("record")).alias("cells"))


def _members(content) -> Iterator[tuple[str, object]]:
    """Members of a ZIP archive as open streams; a member that points outside of it fails the job."""
    import zipfile

    with zipfile.ZipFile(content) as archive:
        for info in archive.infolist():
            parts = info.filename.replace("\\", "/").split("/")
            if ".." in parts or info.filename.startswith("/"):
                raise ValueError(f"unsafe path in archive: {info.filename!r}")
            if not info.is_dir():
                with archive.open(info) as member:
                    yield info.filename, member


def _opened(path: str, content: bytes | None):
    """A seekable stream of an archive; one too large for a cell is read in place."""
    import io

    if content is not None:
        return io.BytesIO(content)
    from pyarrow import fs

    files, inner = fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))
    return files.open_input_file(inner)


def _archive_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    import csv
    import io

    csv.field_size_limit(2 ** 31 - 1)
    names = [*FILE_COLUMNS, "cells"]
    for batch in batches:
        for path, below, content in zip(batch["path"], batch["below"], batch["content"]):
            for member, data in _members(_opened(path, content)):
                if not member.endswith(".csv") or f"/{BLOB_FOLDER}/" in f"/{member}":
                    continue
                folder, _, name = f"{path}/{member}".rpartition("/")
                person = person_of(folder, f"{below}/{member}".rpartition("/")[0])
                lines = io.TextIOWrapper(data, "utf-8-sig", errors="replace", newline="")
                chunk, about = [], ()
                for position, cells in enumerate(row for row in csv.reader(lines) if row):
                    if position == 0:
                        about = type_of(cells)
                        continue
                    if position == 1:
                        about = (*about, header_id(repr(cells)))
                    while cells and not cells[-1]:
                        cells.pop()
                    part = "header" if position == 1 else "data"
                    chunk.append((*person, folder, name, position, part, *about, [c or None for c in cells]))
                    if len(chunk) == ARCHIVE_BATCH_ROWS:
                        yield pd.DataFrame(chunk, columns=names)
                        chunk = []
                if chunk:
                    yield pd.DataFrame(chunk, columns=names)


def _archive_blobs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for path, content in zip(batch["path"], batch["content"]):
            for member, data in _members(_opened(path, content)):
                if f"/{BLOB_FOLDER}/" in f"/{member}":
                    yield pd.DataFrame({"path": [f"{path}/{member}"], "content": [data.read()]})


def _archives(spark: SparkSession, root: str) -> DataFrame:
    """``path, below, content``; the content of archives beyond the limit is null, and tasks read them
    by their path, which then must be of a store that Arrow knows."""
    with few_listing_tasks(spark):
        files = (
            spark.read.format("binaryFile").option("recursiveFileLookup", True)
            .option("pathGlobFilter", "*.zip").load(root)
        )
    path = file_path().alias("path")
    small = files.where(F.col("length") < BINARY_FILE_LIMIT).select(path, "content")
    large = files.where(F.col("length") >= BINARY_FILE_LIMIT).select(
        path, F.lit(None).cast("binary").alias("content"))
    return small.unionByName(large).select(
        "path", below_root(F.col("path"), root).alias("below"), "content")


def read_archive_rows(spark: SparkSession, root: str) -> DataFrame:
    """As ``read_export_rows``, from ZIP archives below ``root``; nothing is unpacked to disk."""
    return _archives(spark, root).mapInPandas(_archive_rows, ROW_SCHEMA)


def read_archive_blobs(spark: SparkSession, root: str) -> DataFrame:
    return _archives(spark, root).mapInPandas(_archive_blobs, "path string, content binary")


@F.pandas_udf(T.StringType())
def _person(export_dir: pd.Series, below: pd.Series) -> pd.Series:
    return pd.Series([person_of(*folders)[0] for folders in zip(export_dir, below)], dtype=object)


def list_export_files(spark: SparkSession, root: str, files: str = "*.csv") -> DataFrame:
    """``file, user_id, export_dir, stamp, written, path`` of every CSV file and blob below ``root``, from listings alone.

    ``file`` is the path below the root; a file that was written again has another ``stamp``. ``written`` is in microseconds.
    """
    mounted = folders.mounted(spark, root)
    if mounted is not None:
        listed = folders.list_files(spark, [mounted])
    else:
        with few_listing_tasks(spark):
            listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
        listed = in_few_tasks(listed.select(
            file_path().alias("path"), F.col("length").alias("size"), F.unix_micros("modificationTime").alias("written")), LISTING_TASKS)
    found = listed.select("path", F.xxhash64("size", "written").alias("stamp"), "written")
    pattern = folders.name_pattern(files)
    placed = found.withColumn("file", below_root(F.col("path"), root))
    blob = _in_blob_folder(F.col("file"))

    def folder(path: str) -> Column:  # of a blob: the folder that its blob folder lies in
        return F.when(blob, F.regexp_replace(path, f"(^|/){BLOB_FOLDER}/.*$", "")).otherwise(_folder_of(F.col(path)))

    return placed.where(blob | F.regexp_extract("file", "[^/]*$", 0).rlike(pattern)).select(
        "file", _person(folder("path"), folder("file")).alias("user_id"), folder("path").alias("export_dir"), "stamp", "written",
        "path")


class Blobs(NamedTuple):
    """Files in blob folders: ``path`` of each, and what gives ``path, content`` of those among some distinct paths."""
    names: DataFrame
    read: Callable[[DataFrame], DataFrame]


def blobs_of(files: DataFrame) -> Blobs:
    """Of a frame that has ``path, content``."""
    return Blobs(files.select("path"), lambda paths: files.join(paths, "path", "left_semi"))


def read_export_blobs(
    spark: SparkSession, root: str, within: list[str] | None = None, listed: DataFrame | None = None,
) -> Blobs:
    """The files in blob folders below ``root``, or of some folders there; ``listed`` has the ``path`` of them all where known."""
    mounted = folders.mounted(spark, root)
    if mounted is not None:
        if listed is None:
            listed = folders.list_files(spark, [mounted] if within is None else within)
        names = listed.where(_in_blob_folder(below_root(F.col("path"), root))).select("path")
        return Blobs(names, lambda paths: paths.mapInArrow(folders.contents, "path string, content binary"))
    with few_listing_tasks(spark):
        listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(within or root)
    return blobs_of(
        listed.withColumn("decoded", file_path())
        .where(_in_blob_folder(below_root(F.col("decoded"), root)))
        .select(F.col("decoded").alias("path"), "content")
    )


def _about_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for r in batch.to_pylist():
            rows.append({"dir": r["export_dir"], "name": r["file_name"], "first": r["header_position"],
                         **dict(zip(("user_id", "export_ts"), person_of(r["export_dir"], r["below"]))),
                         **dict(zip(("datatype_id", "version"), type_of(r["meta"] or []))),
                         "header_id": header_id(repr(r["header"]))})
        text, number = pa.string(), pa.int64()
        yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([
            ("dir", text), ("name", text), ("first", number), ("user_id", text), ("export_ts", text), ("datatype_id", text),
            ("version", text), ("header_id", number)]))


def describe_rows(cells: DataFrame) -> DataFrame:
    """Rows of cells (``CELL_SCHEMA``) with what the first two rows of their file and its folder say: ``ROW_SCHEMA``.

    Two rows of each file and task are shuffled to find the files' first ones; what they say meets the other
    rows by the name of the file. The first row itself is dropped.
    """
    in_file = Window.partitionBy("export_dir", "file_name").orderBy("position")
    top = cells.withColumn("_n", F.row_number().over(in_file)).where("_n <= 2")
    files = top.groupBy("export_dir", "file_name").agg(
        F.first("below").alias("below"), F.min_by("cells", "position").alias("meta"), F.max_by("cells", "position").alias("header"),
        F.max("position").alias("header_position"), F.count("*").alias("rows")).where("rows = 2")
    about = files.mapInArrow(_about_files, "dir string, name string, first long, user_id string, export_ts string, "
                             "datatype_id string, version string, header_id long")
    known = cells.join(about, (F.col("export_dir") == F.col("dir")) & (F.col("file_name") == F.col("name")))
    part = F.when(F.col("position") == F.col("first"), "header").otherwise("data")
    return known.where("position >= first").select(
        "user_id", "export_ts", "export_dir", "file_name", F.col("position").alias("row_no"), part.alias("part"),
        "datatype_id", "version", "header_id", "cells")
