"""CSV files of any size read in chunks, although quoted cells may hold line breaks.

Tasks read mounted folders themselves (see :mod:`vitalgrid.sources.folders`), small files whole; elsewhere Spark's text reader
deals out lines. A chunk is what one task reads of one file. Whether a chunk begins inside a
quoted cell depends on all before it. A line maps that state to the state after it, so a chunk is a
function of two states, and a scan along the chunks of a file (a few numbers each) tells where every chunk
begins. Only files of several chunks take part in that first pass; others are read once. Records that
cross chunks are put together from their pieces, which are all that is shuffled.
"""

from __future__ import annotations

import csv
import hashlib
import os
import posixpath
import re
from collections.abc import Iterator
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vitalgrid.shipping import READING_TASKS, few_listing_tasks, in_few_tasks
from vitalgrid.sources import folders

#: what is known of each record; ``row_no`` grows along a file
FILE_COLUMNS = ("user_id", "export_ts", "export_dir", "file_name", "row_no", "part", "datatype_id", "version", "header_id")
RECORDS = ("user_id string, export_ts string, export_dir string, file_name string, row_no long, part string, "
           "datatype_id string, version string, header_id long, piece int, record string")
#: a record by itself, or the beginning, a middle part or the end of one that crosses chunks
WHOLE, BEGIN, MIDDLE, END = range(4)
#: what is known of the chunks of large files
CHUNKS = ("path string, block long, after_outside boolean, after_inside boolean, meta string, header string, "
          "header_position long")
TOLD = {"inside": "boolean", "datatype_id": "string", "version": "string", "header_id": "long", "header_position": "long"}
#: chunks of large files of which each task is told; more of them are joined
TOLD_CHUNKS = 100_000
#: names of files that Spark's text reader takes as they are, not as compressed ones, whatever the rest of the name
PLAIN_FILES = re.compile(r"[^\[\]{}\\]*\.(?:csv|txt)$")
#: files of mounted folders are read whole up to so many times what Spark takes for the opening of a file
READ_AT_ONCE = 4
#: rows and bytes of small files that a task hands on at once
BATCH_ROWS, BATCH_BYTES = 10_000, 4_000_000
BLOB_FOLDER = "jsons"
#: stands for a blank type id
NO_ID = "unknown"

#: a line that ends inside a quoted cell: whole cells, then an open one. Nothing here goes back or recurses.
_OPEN = re.compile(rb'(?:(?:"(?:[^"]++|"")*+"[^,]*+|(?!")[^,]*+),)*+"(?:[^"]++|"")*+\Z')


def ends_open(line: bytes, inside: bool) -> bool:
    """Whether the next line begins inside a quoted cell, if this one does so or not."""
    return _OPEN.match(b'"' + line if inside else line) is not None


# ---- what a file says of itself -----------------------------------------------------------------

def root_pattern(root: str) -> str:
    """Matches the part of a full path down to ``root``, however the root is spelled: with or without scheme and host,
    relative, with a glob, with ``.`` and ``..``."""
    inner = re.match(r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/]*)?(.*)$", root, re.S)[1] or "/"

    def translated(path: str) -> str:
        path = posixpath.normpath(path).strip("/")
        if path == ".":
            return ""
        path = re.sub(r"^(?:\.\./?)+", "", path)
        special = {"*": "[^/]*", "?": "[^/]", "[": "[", "]": "]", "-": "-"}
        special |= {"{": "(?:", "}": ")", ",": "|"} if "{" in path else {}
        return "".join(special.get(c) or (c if c.isalnum() or c in "/_" else f"\\{c}") for c in path)

    begin = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/]*)?/*"
    if inner.startswith("/"):
        return begin + (translated(inner) + "(?:/|$)" if translated(inner) else "")
    # below the folder this program works in, or else below some other
    return f"{begin}(?:{translated(os.path.abspath(inner))}|(?:.*?/)?{translated(inner) or 'a^'})(?:/|$)"


def person_of(export_dir: str, below: str) -> tuple[str, str | None]:
    """Person and time of an export, from the folders below the root.

    The deepest folder or archive named ``word_<person>_<digits>`` tells; without one the folders as a
    whole name the person, so that two persons never become one. Files that lie in the root itself
    belong to the root's folder. Folders named ``name=value``, as partitioned writers do, count by their value.
    """
    folders = re.sub(r"(?i)\.zip(?=/|$)", "", below or export_dir.rpartition("/")[2])
    folders = re.sub(r"(^|/)\w+=", r"\1", folders)
    named = re.findall(r"(?:^|/)[A-Za-z]+_([^/]+)_(\d{8,})(?=/|$)", folders)
    return named[-1] if named else (folders, None)


def type_of(meta: list[str]) -> tuple[str, str | None]:
    """Type id and version from the cells of a file's first line; a blank id reads as ``unknown``."""
    cells = [(c or "").replace("﻿", "").strip(" ") for c in meta[:2]] + ["", ""]
    return cells[0] or NO_ID, cells[1] or None


def header_id(header: str) -> int:
    """A number for a header line: equal lines have equal numbers."""
    return int.from_bytes(hashlib.blake2b(header.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)


def _text(cell: pa.Scalar) -> str:
    return cell.cast(pa.binary()).as_py().decode("utf-8", "replace")


def cells_of(record: str) -> list[str]:
    return next(csv.reader([record.replace("\0", "")]), [])


class _Place:
    """Where a file lies: its folders, name and person; None for files of blob folders."""

    def __init__(self, pattern: str):
        self.root, self.known = re.compile(pattern), {}

    def __call__(self, encoded: str) -> tuple[str, str, str | None, str] | None:
        if encoded not in self.known:
            self.known[encoded] = self.of(unquote(encoded))
        return self.known[encoded]

    def of(self, path: str) -> tuple[str, str, str | None, str] | None:
        inside = self.root.sub("", path, count=1)
        folder, _, name = path.rpartition("/")
        below = inside.rpartition("/")[0]
        blob = f"/{BLOB_FOLDER}/" in f"/{inside}"
        return None if blob else (*person_of(folder, below), folder, name)


# ---- lines to records ---------------------------------------------------------------------------

def _stretches(batch: pa.RecordBatch) -> Iterator[tuple[int, int]]:
    """Rows of one chunk that lie side by side."""
    path = pc.dictionary_encode(batch.column("path")).indices.to_numpy()
    block = batch.column("block").to_numpy()
    cuts = np.flatnonzero((np.diff(path) != 0) | (np.diff(block) != 0)) + 1
    yield from zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows])


def _strings(texts: list[bytes]) -> pa.Array:
    return pa.array(texts, pa.binary()).view(pa.string())


def _by_size(records: list[tuple[bytes, int]]) -> Iterator[list[tuple[bytes, int]]]:
    """Records side by side, of ``BATCH_BYTES`` or one record."""
    part, size = [], 0
    for record in records:
        if part and size + len(record[0]) > BATCH_BYTES:
            yield part
            part, size = [], 0
        part.append(record)
        size += len(record[0])
    if part:
        yield part


def _together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Small batches as fewer ones; the order of rows stays."""
    held, rows, size = [], 0, 0
    for batch in batches:
        more = batch.column("record").nbytes
        if held and (rows + batch.num_rows > BATCH_ROWS or size + more > BATCH_BYTES):
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, rows, size = [], 0, 0
        held.append(batch)
        rows, size = rows + batch.num_rows, size + more
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


class _Chunk:
    """Puts the lines of a chunk together to records."""

    def __init__(self, block: int, inside: bool):
        # a line that begins where a chunk ends is read with that chunk
        self.next, self.inside = block + (block > 0), inside
        self.held: list[bytes] = []
        self.held_at, self.piece = self.next, MIDDLE if inside else WHOLE

    def records(self, lines: pa.Array) -> list[tuple[pa.Array, np.ndarray, int]]:
        """Texts, positions and kind of what ends in these lines. Positions grow along a file: a line takes
        a byte at least, so a chunk has fewer lines than bytes."""
        first, n = self.next, len(lines)
        self.next += n
        quoted = np.flatnonzero(pc.count_substring(lines, '"').to_numpy(zero_copy_only=False))
        if not len(quoted) and not self.inside:
            return [(lines, first + np.arange(n), WHOLE)]
        whole, done = np.ones(n, bool), []
        raw = lines.cast(pa.binary())
        start = 0  # of the record that is open
        for i in quoted.tolist():
            before, self.inside = self.inside, ends_open(raw[i].as_py(), self.inside)
            if before:
                whole[start:i + 1] = False
                if not self.inside:
                    done.append(self._close(raw.slice(start, i + 1 - start).to_pylist()))
            elif self.inside:
                whole[i] = False
                start, self.held_at, self.held, self.piece = i, first + i, [], WHOLE
            if before and self.inside:
                continue
        if self.inside:
            whole[start:] = False
            self.held += raw.slice(start).to_pylist()
        keep = np.flatnonzero(whole)
        out = [(lines.take(pa.array(keep)), first + keep, WHOLE)] if len(keep) else []
        for kind in (WHOLE, END):  # many records of few lines are one array
            ended = [(text, at) for text, at, piece in done if piece == kind]
            out += [(_strings([text for text, _ in part]), np.array([at for _, at in part]), kind) for part in _by_size(ended)]
        return out

    def _close(self, lines: list[bytes]) -> tuple[bytes, int, int]:
        text, at = b"\n".join([*self.held, *lines]), self.held_at
        piece = END if self.piece == MIDDLE else WHOLE
        self.held, self.piece = [], WHOLE
        return text, at, piece

    def rest(self, last: bool) -> list[tuple[pa.Array, np.ndarray, int]]:
        """What is open at the end of the chunk; at the end of the file it is a record."""
        if not self.inside:
            return []
        piece = self.piece if self.piece == MIDDLE else BEGIN
        if last:
            piece = END if piece == MIDDLE else WHOLE
        return [(_strings([b"\n".join(self.held)]), np.array([self.held_at]), piece)]


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each chunk the state after it if it begins outside or inside a quoted cell, and the first two records of a
    file if the first chunk has both."""
    now, rows = None, []

    def row(first: list) -> dict:
        path, block, outside, inside, chunk, top = first
        found = top if block == 0 and len(top) > 1 else [(None, None)] * 2
        return {"path": path, "block": block, "after_outside": outside, "after_inside": inside,
                "meta": found[0][1], "header": found[1][1], "header_position": found[1][0]}

    for batch in batches:
        for i, j in _stretches(batch):
            path, block = batch.column("path")[i].as_py(), batch.column("block")[i].as_py()
            if now is None or (now[0], now[1]) != (path, block):
                rows += [row(now)] if now else []
                now = [path, block, False, True, _Chunk(block, False), []]
            lines = batch.column("value").slice(i, j - i)
            if block == 0 and len(now[5]) < 2:
                ended = [(at[k], texts[k]) for texts, at, _ in now[4].records(lines) for k in range(min(len(at), 1000))]
                ended = [(int(p), t.cast(pa.binary()).as_py().rstrip(b"\r").decode("utf-8", "replace"))
                         for p, t in sorted(ended, key=lambda r: r[0])]
                now[5] = [*now[5], *[r for r in ended if r[1]]][:2]
            for k in np.flatnonzero(pc.count_substring(lines, '"').to_numpy(zero_copy_only=False)).tolist():
                line = lines[k].cast(pa.binary()).as_py()
                same = now[2] == now[3]
                now[2] = ends_open(line, now[2])
                now[3] = now[2] if same else ends_open(line, now[3])
    rows += [row(now)] if now else []
    if rows:
        yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([
            ("path", pa.string()), ("block", pa.int64()), ("after_outside", pa.bool_()), ("after_inside", pa.bool_()),
            ("meta", pa.string()), ("header", pa.string()), ("header_position", pa.int64())]))


def _records(batches: Iterator[pa.RecordBatch], pattern: str, raw: bool) -> Iterator[pa.RecordBatch]:
    """Records of the lines with what their file says; ``raw``: every record as data, its path as folder."""
    place, chunk, now, about, seen = _Place(pattern), None, None, None, 0

    def emit(parts) -> Iterator[pa.RecordBatch]:
        nonlocal about, seen
        alone = not raw and now["datatype_id"] is None  # a file of one chunk
        if alone and seen < 2 and len(parts) > 1:  # in their order, since the first two say what the file is
            texts, at = pa.concat_arrays([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
            order = np.argsort(at)
            parts = [(texts.take(pa.array(order)), at[order], WHOLE)]
        for texts, at, piece in parts:
            texts = pc.ascii_rtrim(texts, characters="\r") if piece in (WHOLE, END) else texts
            if piece == WHOLE:  # blank lines are no records
                filled = np.flatnonzero(pc.binary_length(texts).to_numpy(zero_copy_only=False) > 0)
                texts, at = texts.take(pa.array(filled)), at[filled]
            kinds = np.full(len(at), "data", object)
            if alone:
                while seen < 2 and len(at):
                    if seen == 0:
                        about = type_of(cells_of(_text(texts[0])))
                        texts, at = texts.slice(1), at[1:]
                    else:
                        about = (*about, header_id(_text(texts[0])))
                        yield from rows(texts.slice(0, 1), at[:1], piece, ["header"])
                        texts, at = texts.slice(1), at[1:]
                    seen += 1
            elif not raw:
                about = (now["datatype_id"], now["version"], now["header_id"])
                kinds = np.where(at == now["header_position"], "header", "data")
                kept = np.flatnonzero(at >= now["header_position"])
                texts, at, kinds = texts.take(pa.array(kept)), at[kept], kinds[kept]
            yield from rows(texts, at, piece, kinds[:len(at)])

    def rows(texts, at, piece, kinds) -> Iterator[pa.RecordBatch]:
        n = len(at)
        if not n:
            return
        where = (now["path"], None, now["path"], None) if raw else place(now["path"])
        said = (None, None, None) if raw else about
        same = [pa.array([v] * n, t) for v, t in zip((*where, *said), [pa.string()] * 6 + [pa.int64()])]
        yield pa.RecordBatch.from_arrays(
            [*same[:4], pa.array(at, pa.int64()), pa.array(list(kinds), pa.string()), *same[4:],
             pa.array(np.full(n, piece, np.int32)), texts],
            names=[*FILE_COLUMNS, "piece", "record"])

    for batch in batches:
        for i, j in _stretches(batch):
            found = {c: batch.column(c)[i].as_py() for c in batch.schema.names if c != "value"}
            if now is None or (now["path"], now["block"]) != (found["path"], found["block"]):
                if chunk is not None:
                    yield from emit(chunk.rest(now["last"]))
                now, about, seen = found, None, 0
                chunk = None if not raw and place(now["path"]) is None else _Chunk(now["block"], bool(now["inside"]))
            if chunk is not None:
                yield from emit(chunk.records(batch.column("value").slice(i, j - i)))
    if chunk is not None:
        yield from emit(chunk.rest(now["last"]))


def whole_records(data: bytes) -> tuple[list[bytes], list[int]]:
    """The records of a whole file and their positions, blank ones left out: what ``_Chunk`` finds, without arrays."""
    lines = data.split(b"\n")
    if not lines[-1]:
        lines.pop()
    texts, at = lines, list(range(len(lines)))
    if b'"' in data:
        texts, at, i, n = [], [], 0, len(lines)
        while i < n:
            start, text = i, lines[i]
            i += 1
            if b'"' in text and ends_open(text, False):
                while i < n and not (b'"' in lines[i] and not ends_open(lines[i], True)):
                    i += 1
                i = min(i + 1, n)
                text = b"\n".join(lines[start:i])
            texts.append(text)
            at.append(start)
    if b"\r" in data:
        texts = [text.rstrip(b"\r") for text in texts]
    if not all(texts):
        at = [p for text, p in zip(texts, at) if text]
        texts = [text for text in texts if text]
    return texts, at


class _Rows:
    """Records of many files, handed on together; what is the same in a file is told once."""

    def __init__(self):
        self.files, self.counts, self.texts, self.at, self.headers, self.size = [], [], [], [], [], 0

    def add(self, about: tuple, texts: list[bytes], at: list[int], header: bool) -> None:
        if header:
            self.headers.append(len(self.at))
        self.files.append(about)
        self.counts.append(len(texts))
        self.texts += texts
        self.at += at
        self.size += sum(map(len, texts))

    def full(self) -> bool:
        return len(self.at) >= BATCH_ROWS or self.size >= BATCH_BYTES

    def batch(self) -> pa.RecordBatch:
        of_file = pa.array(np.repeat(np.arange(len(self.files)), self.counts))
        same = [pa.array([f[k] for f in self.files], pa.string() if k < 6 else pa.int64()).take(of_file) for k in range(7)]
        kinds = np.zeros(len(self.at), np.int8)
        kinds[self.headers] = 1
        out = pa.RecordBatch.from_arrays(
            [*same[:4], pa.array(self.at, pa.int64()), pa.array(["data", "header"]).take(pa.array(kinds)), *same[4:],
             pa.array(np.full(len(self.at), WHOLE, np.int32)), _strings(self.texts)],
            names=[*FILE_COLUMNS, "piece", "record"])
        self.__init__()
        return out


def _small_files(batches: Iterator[pa.RecordBatch], pattern: str) -> Iterator[pa.RecordBatch]:
    """Records of files, each read whole: as ``_records`` of files of one chunk."""
    place, rows, types, numbers = _Place(pattern), _Rows(), {}, {}

    def known(cache: dict, text: bytes, of) -> object:
        if text not in cache:
            if len(cache) >= BATCH_ROWS:
                cache.clear()
            cache[text] = of(text.decode("utf-8", "replace"))
        return cache[text]

    for batch in batches:
        for path in batch.column("path").to_pylist():
            where = place.of(path)
            if where is None:
                continue
            texts, at = whole_records(folders.read_whole(path))
            if len(texts) < 2:
                continue
            about = (*where, *known(types, texts[0], lambda meta: type_of(cells_of(meta))), known(numbers, texts[1], header_id))
            for i in range(1, len(texts), BATCH_ROWS):
                rows.add(about, texts[i:i + BATCH_ROWS], at[i:i + BATCH_ROWS], i == 1)
                if rows.full():
                    yield rows.batch()
    if rows.at:
        yield rows.batch()


def _joined(table: pa.Table) -> pa.Table:
    """The records of a file that cross its chunks, from their pieces."""
    rows, out, open_ = sorted(table.to_pylist(), key=lambda r: r["row_no"]), [], None
    for r in rows:
        if r["piece"] == BEGIN:
            open_ = r
        elif open_ is not None:
            open_["record"] += "\n" + r["record"]
            if r["piece"] == END:
                out.append(open_)
                open_ = None
    for r in [*out, *([open_] if open_ else [])]:
        r["record"] = r["record"].rstrip("\r")
    return pa.Table.from_pylist([*out, *([open_] if open_ else [])], schema=table.schema)


def _states(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whether each chunk of a file begins inside a quoted cell; a row has all chunks of a file."""
    for batch in batches:
        out = []
        for path, chunks in zip(batch.column("path").to_pylist(), batch.column("chunks").to_pylist()):
            inside = False
            for c in sorted(chunks, key=lambda c: c["block"]):
                out.append((path, c["block"], inside))
                inside = c["after_inside"] if inside else c["after_outside"]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[k] for r in out], t) for k, t in enumerate((pa.string(), pa.int64(), pa.bool_()))],
            names=["path", "block", "inside"])


def _said(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        types = [type_of(cells_of(m)) for m in batch.column("meta").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("path"), pa.array([t[0] for t in types], pa.string()), pa.array([t[1] for t in types], pa.string()),
             pa.array([header_id(h) for h in batch.column("header").to_pylist()], pa.int64()), batch.column("header_position")],
            names=["path", "datatype_id", "version", "header_id", "header_position"])


def read_records(
    spark: SparkSession, root: str, files: str, within: list[str] | None = None, since: int | None = None,
) -> DataFrame:
    """``RECORDS`` of all CSV files below ``root``, blob folders aside; ``piece`` is always ``WHOLE``.

    ``within`` names folders below the root, none inside another, if only their files are wanted; ``since`` is a time in
    microseconds if only files written then or later are, which the listing tells.
    """
    pattern = root_pattern(root)
    folder = folders.mounted(spark, root) if PLAIN_FILES.match(files) else None
    if folder is not None:
        listed = folders.list_files(spark, [folder] if within is None else within, folders.name_pattern(files))
        if since is not None:
            listed = listed.where(F.col("written") >= since)
        listed = listed.persist(StorageLevel.DISK_ONLY)  # what is small and what is large are two reads of it
        chunk = min(READ_AT_ONCE * _bytes(spark, "spark.sql.files.openCostInBytes"), _bytes(spark, "spark.sql.files.maxPartitionBytes"))
        largest = listed.agg(F.max("size")).first()[0] or 0
        found = listed.where(F.col("size") <= chunk).select("path").mapInArrow(lambda b: _small_files(b, pattern), RECORDS)
        if largest <= chunk:
            return found
        lines = folders.chunks_of(listed.where(F.col("size") > chunk), chunk).mapInArrow(lambda b: folders.chunk_lines(b, chunk), folders.LINES)
        return found.unionByName(_records_of(lines, lines, pattern))
    meta = F.col("_metadata")
    with few_listing_tasks(spark):
        scan = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", files).option("lineSep", "\n").text(within or root)
    if since is not None:
        scan = scan.where(meta["file_modification_time"] >= F.timestamp_micros(F.lit(since)))
    lines = scan.select(
        "value", meta["file_path"].alias("path"), meta["file_block_start"].alias("block"), meta["file_size"].alias("size"),
        (meta["file_block_start"] + meta["file_block_length"] >= meta["file_size"]).alias("last"))
    # no file up to this size is ever dealt out in parts, and the listing leaves such files out of the first pass
    never = min(_bytes(spark, "spark.sql.files.openCostInBytes"), _bytes(spark, "spark.sql.files.maxPartitionBytes"))
    large = lines.where((F.col("size") > never) & ~((F.col("block") == 0) & F.col("last")))
    return _records_of(in_few_tasks(lines, READING_TASKS), large, pattern)


def _records_of(lines: DataFrame, large: DataFrame, pattern: str) -> DataFrame:
    """``RECORDS`` of lines of files, of which ``large`` has those of files of several chunks."""
    told = _told(large, pattern)
    number = told.count()
    if not number:
        lines = lines.withColumns({c: F.lit(None).cast(t) for c, t in TOLD.items()})
        return lines.mapInArrow(lambda b: _together(_records(b, pattern, False)), RECORDS)
    if number <= TOLD_CHUNKS:
        lines = lines.join(F.broadcast(told), ["path", "block"], "left")
    else:  # dealt out anew, and brought in order again
        lines = lines.withColumn("line", F.monotonically_increasing_id()).join(told, ["path", "block"], "left").repartition(
            "path", "block").sortWithinPartitions("path", "block", "line").drop("line")
    found = lines.mapInArrow(lambda b: _together(_records(b, pattern, False)), RECORDS)
    pieces = found.where(F.col("piece") != WHOLE).groupBy("export_dir", "file_name").applyInArrow(_joined, RECORDS)
    return found.where(F.col("piece") == WHOLE).unionByName(pieces.withColumn("piece", F.lit(WHOLE)))


def _told(large: DataFrame, pattern: str) -> DataFrame:
    """``path, block`` and what ``TOLD`` lists of the chunks of large files."""
    chunks = large.select("value", "path", "block").mapInArrow(_chunks, CHUNKS).persist()
    state = chunks.groupBy("path").agg(F.collect_list(F.struct("block", "after_outside", "after_inside")).alias("chunks")).mapInArrow(
        _states, "path string, block long, inside boolean")
    first = chunks.where("block = 0").select("path", "meta", "header", "header_position")
    known = first.where("header is not null")
    late = first.where("header is null").select("path")
    if not late.isEmpty():  # two records do not fit the first chunk: they are taken from the file's records
        lines = large.join(F.broadcast(late), "path").join(F.broadcast(state), ["path", "block"]).withColumn(
            "line", F.monotonically_increasing_id())
        found = lines.mapInArrow(lambda b: _together(_records(b, pattern, True)), RECORDS)
        pieces = found.where(F.col("piece") != WHOLE).groupBy("export_dir").applyInArrow(_joined, RECORDS)
        both = found.where(F.col("piece") == WHOLE).unionByName(pieces).select(
            F.col("export_dir").alias("path"), "row_no", "record")
        top = both.withColumn("n", F.row_number().over(Window.partitionBy("path").orderBy("row_no"))).where("n <= 2")
        known = known.unionByName(top.groupBy("path").agg(
            F.min_by("record", "row_no").alias("meta"), F.max_by("record", "row_no").alias("header"),
            F.max("row_no").alias("header_position")))
    said = known.mapInArrow(_said, "path string, datatype_id string, version string, header_id long, header_position long")
    return state.join(said, "path")


def _bytes(spark: SparkSession, name: str) -> int:
    text = spark.conf.get(name).strip().lower()
    number, unit = re.match(r"(\d+)\s*([kmgt]?)b?$", text).groups()
    return int(number) * 1024 ** " kmgt".index(unit or " ")
