"""Mounted folders, listed and read by tasks.

Spark's readers list all files on the driver, which holds a few hundred bytes of each of them and of each folder as long as the
frame lives. Where folders are mounted, as local ones are, tasks walk them, and of many files none is known to the driver. The files found,
their paths, lengths and times are those that Spark's readers would find.
"""

from __future__ import annotations

import os
import re
from collections import deque
from collections.abc import Iterator
from itertools import islice
from urllib.parse import quote

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalgrid.shipping import LISTING_TASKS

#: files with their length in bytes and time of writing in microseconds; folders still to be listed have neither
LISTED = "path string, size long, written long"
#: files and folders that the driver looks at to know whether there are more: so few are not dealt out
FEW_ENTRIES = 1000
FEW_BYTES = 64 << 20
#: folders that the first task looks for before they are dealt out; those in them are dealt out again, and each is then walked
#: with all below it
FIRST_FOLDERS = 1000
#: tasks for each core that walk folders
WALKING_TASKS = 2
SCHEME = "file:"
BATCH_ROWS, BATCH_BYTES = 10_000, 4_000_000
_LOCAL = ("org.apache.hadoop.fs.LocalFileSystem", "org.apache.hadoop.hive.ql.io.ProxyLocalFileSystem")
_BYTE_ORDER_MARK = b"\xef\xbb\xbf"


def mounted(spark: SparkSession, root: str) -> str | None:
    """The path of a mounted folder; None for other stores, globs and what is no folder, which Spark's readers know."""
    if set(root) & set("{}[]*?\\") or re.match(r"(?!file:)[A-Za-z][A-Za-z0-9+.-]*:", root):
        return None
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    store = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if store.getClass().getName() not in _LOCAL:
        return None
    folder = store.makeQualified(path).toUri().getPath()
    return folder if os.path.isdir(folder) else None


def local(path: str) -> str:
    return path.removeprefix(SCHEME)


def _hidden(name: str) -> bool:
    """Names that Spark's readers leave out, of files and of folders."""
    return name.startswith(".") or (name.startswith("_") and "=" not in name) or name.endswith("._COPYING_")


def _entries(folder: str, name_pattern: re.Pattern | None) -> Iterator[tuple[str, int | None, int | None]]:
    """``LISTED`` of the folders and filled files in a folder; links are followed, those that lead nowhere left out."""
    with os.scandir(folder) as found:
        for entry in found:
            name = entry.name
            if _hidden(name) or not (name.isascii() or _is_text(name)):
                continue
            if entry.is_dir():
                yield SCHEME + entry.path, None, None
            elif name_pattern is None or name_pattern.match(name):
                try:
                    stat = entry.stat()
                except FileNotFoundError:
                    continue
                if stat.st_size:
                    yield SCHEME + entry.path, stat.st_size, stat.st_mtime_ns // 1_000_000 * 1000


def _is_text(name: str) -> bool:
    try:
        name.encode()
    except UnicodeEncodeError:
        return False
    return True


def _listed(batches: Iterator[pa.RecordBatch], pattern: str | None, until: int | None) -> Iterator[pa.RecordBatch]:
    """Files as they are, and in place of each folder what it holds: with all folders below, or ``until`` so many
    folders are known, which are then given."""
    name_pattern = pattern and re.compile(pattern, re.S)
    types = (pa.string(), pa.int64(), pa.int64())

    def walked(folder: str) -> Iterator[tuple[str, int | None, int | None]]:
        todo, first = deque([folder]), True
        while todo and (first or until is None or len(todo) < until):
            # level by level to know many soon, else down first to know few
            for row in _entries(local(todo.pop() if until is None else todo.popleft()), name_pattern):
                if row[1] is None and (until is None or len(todo) < until):
                    todo.append(row[0])
                else:
                    yield row
            first = False
        yield from ((rest, None, None) for rest in todo)

    found = (row for batch in batches for given in zip(*[c.to_pylist() for c in batch.columns])
             for row in ([given] if given[1] is not None else walked(given[0])))
    while rows := list(islice(found, BATCH_ROWS)):
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], names=["path", "size", "written"])


def name_pattern(files: str) -> str:
    """A glob of names, of ``*`` and ``?``, as pattern."""
    return "^" + re.escape(files).replace(r"\*", ".*").replace(r"\?", ".") + "$"


def _few(folders: list[str], pattern: str | None) -> list[tuple[str, int, int]] | None:
    """``LISTED`` of the files below folders that hold few entries; None of others."""
    name_pattern, todo, files, seen = pattern and re.compile(pattern, re.S), [local(f) for f in folders], [], 0
    while todo:
        for row in _entries(todo.pop(), None):
            seen += 1
            if seen > FEW_ENTRIES:
                return None
            if row[1] is None:
                todo.append(local(row[0]))
            elif name_pattern is None or name_pattern.match(os.path.basename(row[0])):
                files.append(row)
    return files


def list_files(spark: SparkSession, folders: list[str], pattern: str | None = None) -> DataFrame:
    """``LISTED`` of the files below mounted folders, none inside another, dealt out evenly; ``pattern`` is one of names."""
    few, cores = _few(folders, pattern), spark.sparkContext.defaultParallelism
    if few is not None:
        found = spark.createDataFrame(few, LISTED)
        return found if sum(f[1] for f in few) < FEW_BYTES else found.repartition(LISTING_TASKS * cores, "path")
    found = spark.createDataFrame([(SCHEME + local(f), None, None) for f in folders], LISTED)
    for until, tasks in ((FIRST_FOLDERS, WALKING_TASKS), (1, WALKING_TASKS), (None, LISTING_TASKS)):
        found = found.mapInArrow(lambda b, until=until: _listed(b, pattern, until), LISTED).repartition(tasks * cores, "path")
    return found


def chunks_of(listed: DataFrame, size: int) -> DataFrame:
    """``path, block, size`` of the parts of files, each of ``size`` bytes, dealt out evenly."""
    tasks = LISTING_TASKS * listed.sparkSession.sparkContext.defaultParallelism
    begins = F.sequence(F.lit(0).cast("long"), F.col("size") - 1, F.lit(size).cast("long"))
    return listed.select("path", F.explode(begins).alias("block"), "size").repartition(tasks, "path", "block")


LINES = "value string, path string, block long, size long, last boolean"


def chunk_lines(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """The lines that begin in chunks of files (``path, block, size``), as Spark's text reader gives them, paths encoded."""
    for batch in batches:
        for path, block, size in zip(*[batch.column(c).to_pylist() for c in ("path", "block", "size")]):
            end = min(block + length, size)
            same = [quote(path, safe="/:"), block, size, end == size]
            with open(local(path), "rb") as file:
                at = _first_line(file, block, end)
                while at < end:
                    data = file.read(min(BATCH_BYTES, end - at))
                    if not data:
                        break
                    if not data.endswith(b"\n"):
                        data += file.readline()
                    begin, at = at, at + len(data)
                    lines = _lines_of(data.removeprefix(_BYTE_ORDER_MARK) if begin == 0 else data)
                    n = len(lines)
                    columns = [pa.array([v] * n, t) for v, t in zip(same, (pa.string(), pa.int64(), pa.int64(), pa.bool_()))]
                    yield pa.RecordBatch.from_arrays([lines, *columns], names=["value", "path", "block", "size", "last"])


def _first_line(file, block: int, end: int) -> int:
    """Where the first line begins that begins in this chunk; the end of the chunk if none does."""
    if block == 0:
        return 0
    file.seek(block - 1)
    while file.tell() < end:
        if file.readline(min(BATCH_BYTES, end - file.tell())).endswith(b"\n"):
            return file.tell()
    return end


def _lines_of(data: bytes) -> pa.Array:
    raw = np.frombuffer(data, np.uint8)
    breaks = np.flatnonzero(raw == 10)
    ends = breaks if data.endswith(b"\n") else np.append(breaks, len(raw))
    offsets = np.append(0, ends - np.arange(len(ends))).astype(np.int32)
    kept = np.delete(raw, breaks).tobytes()
    return pa.Array.from_buffers(pa.string(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(kept)])


def read_whole(path: str) -> bytes:
    with open(local(path), "rb") as file:
        return file.read().removeprefix(_BYTE_ORDER_MARK)


def contents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``path, content`` of files, some megabytes at once."""
    def batch_of(rows: list[tuple[str, bytes]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([p for p, _ in rows], pa.string()), pa.array([c for _, c in rows], pa.binary())], names=["path", "content"])

    held, size = [], 0
    for batch in batches:
        for path in batch.column("path").to_pylist():
            with open(local(path), "rb") as file:
                content = file.read()
            if held and size + len(content) > BATCH_BYTES:
                yield batch_of(held)
                held, size = [], 0
            held.append((path, content))
            size += len(content)
    if held:
        yield batch_of(held)
