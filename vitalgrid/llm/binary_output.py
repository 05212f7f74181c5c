"""Token ids in a binary file format with fixed-width bit packing.

A shard file holds the ids of a run of documents in ascending ``doc_id``, each id in the fewest bits
that the vocabulary needs. Layout, all numbers little-endian:

* header of 32 bytes: magic ``VGTOK1``, bits to an id (uint16), ids to a block (uint32), number of ids
  (uint64), number of blocks (uint32), number of documents (uint64)
* document table: ``doc_id`` of each document (int64, the least number for null), then its number of
  ids (uint32)
* block offsets: byte offset of each block in the payload, and the payload's length (uint64)
* payload: blocks of packed ids, first id in the lowest bits; each block starts at a byte

A block unpacks with a few numpy calls, without a loop over ids, and any range of ids is read by
seeking to its blocks.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vitalgrid.llm.common import in_ranges, range_points, shuffle_tasks, stored
from vitalgrid.llm.tokens import default_vocabulary, text_slices, word_tokenizer

MAGIC = b"VGTOK1"
HEADER = struct.Struct("<6sHIQIQ")
BLOCK_IDS = 65_536
#: a shard closes at the first document that takes it to so many ids
SHARD_IDS = 8_000_000
NULL_ID = -2 ** 63
#: ids read back at once
READ_IDS = 2_000_000
MANIFEST = "bucket int, shard int, path string, docs long, ids long"


def bits_for(vocabulary: int) -> int:
    return max(1, int(vocabulary - 1).bit_length())


def pack_bits(ids: np.ndarray, bits: int) -> bytes:
    """Ids below ``2 ** bits``, packed without gaps, first id in the lowest bits."""
    if bits in (8, 16, 32):
        return ids.astype(f"<u{bits // 8}").tobytes()
    spread = (ids[:, None].astype(np.uint64) >> np.arange(bits, dtype=np.uint64)) & np.uint64(1)
    return np.packbits(spread.astype(np.uint8).ravel(), bitorder="little").tobytes()


def unpack_bits(data: bytes, bits: int, count: int) -> np.ndarray:
    """The ``count`` ids of a packed block: each from the bytes it touches, all at once."""
    if bits in (8, 16, 32):
        return np.frombuffer(data, f"<u{bits // 8}", count).astype(np.uint32)
    raw = np.frombuffer(data + bytes(8), np.uint8)
    at = np.arange(count, dtype=np.int64) * bits
    value = np.zeros(count, np.uint64)
    for i in range((bits + 14) // 8):
        value |= raw[(at >> 3) + i].astype(np.uint64) << np.uint64(8 * i)
    return ((value >> (at & 7).astype(np.uint64)) & np.uint64((1 << bits) - 1)).astype(np.uint32)


def write_shard(file, doc_ids: list[int | None], lengths: list[int], ids: np.ndarray, bits: int,
                block: int = BLOCK_IDS) -> None:
    blocks = [pack_bits(ids[i:i + block], bits) for i in range(0, len(ids), block)]
    offsets = np.concatenate([[0], np.cumsum([len(b) for b in blocks])]).astype("<u8")
    file.write(HEADER.pack(MAGIC, bits, block, len(ids), len(blocks), len(lengths)))
    file.write(np.array([NULL_ID if d is None else d for d in doc_ids], "<i8").tobytes())
    file.write(np.asarray(lengths, "<u4").tobytes())
    file.write(offsets.tobytes())
    for packed in blocks:
        file.write(packed)


class Shard:
    """Reads a shard file; only the tables are kept in memory."""

    def __init__(self, file):
        self.file = file
        magic, self.bits, self.block, self.ids, blocks, docs = HEADER.unpack(file.read(HEADER.size))
        if magic != MAGIC:
            raise ValueError("not a token shard")
        self.doc_ids = np.frombuffer(file.read(8 * docs), "<i8")
        self.lengths = np.frombuffer(file.read(4 * docs), "<u4").astype(np.int64)
        self.offsets = np.frombuffer(file.read(8 * (blocks + 1)), "<u8").astype(np.int64)
        self.payload = HEADER.size + 12 * docs + 8 * (blocks + 1)
        self.starts = np.cumsum(self.lengths) - self.lengths

    def read(self, start: int, count: int) -> np.ndarray:
        """Ids ``start`` to ``start + count`` of the shard; opens only the blocks that hold them."""
        if start < 0 or count < 0 or start + count > self.ids:
            raise IndexError("beyond the shard")
        parts = []
        for b in range(start // self.block, -(-(start + count) // self.block) if count else 0):
            self.file.seek(self.payload + int(self.offsets[b]))
            data = self.file.read(int(self.offsets[b + 1] - self.offsets[b]))
            held = min(self.block, self.ids - b * self.block)
            first = max(start - b * self.block, 0)
            parts.append(unpack_bits(data, self.bits, held)[first:start + count - b * self.block])
        return np.concatenate(parts) if parts else np.zeros(0, np.uint32)

    def document(self, number: int) -> np.ndarray:
        return self.read(int(self.starts[number]), int(self.lengths[number]))


def full_address(spark: SparkSession, folder: str) -> str:
    """The folder with the scheme of the store that Spark keeps it in, learned from a table written there."""
    spark.range(1).write.parquet(f"{folder}/address")
    return spark.read.parquet(f"{folder}/address").inputFiles()[0].rpartition("/address/")[0]


def _open(path: str, mode: str):
    """A file in the shared store; Arrow's file systems must know its scheme."""
    from pyarrow import fs

    place, inner = fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))
    if mode == "w":
        place.create_dir(inner.rpartition("/")[0], recursive=True)
        return place.open_output_stream(inner)
    return place.open_input_file(inner)


def _write_shards(
    batches: Iterator[pa.RecordBatch], folder: str, vocabulary: str, shard_ids: int
) -> Iterator[pa.RecordBatch]:
    """Rows come ordered by bucket and id; yields a manifest row for each shard written.

    Names are fresh for each attempt; only those of attempts that ended get into the manifest.
    """
    tokenizer = word_tokenizer(vocabulary)
    bits = bits_for(tokenizer.vocabulary)
    bucket, shard, held = None, 0, 0
    runs: list[np.ndarray] = []
    doc_ids: list[int | None] = []
    lengths: list[int] = []

    def close() -> pa.RecordBatch:
        path = f"{folder}/{bucket:06d}-{shard:06d}-{uuid.uuid4().hex}.tok"
        with _open(path, "w") as file:
            write_shard(file, doc_ids, lengths, np.concatenate(runs), bits)
        return pa.RecordBatch.from_arrays(
            [pa.array([bucket], pa.int32()), pa.array([shard], pa.int32()), pa.array([path]),
             pa.array([len(lengths)]), pa.array([held])],
            names=["bucket", "shard", "path", "docs", "ids"])

    for batch in text_slices(batches, "text"):
        buckets, owners = (c.to_pylist() for c in batch.columns[:2])
        ids, counts = tokenizer.encode(batch.column(2))
        at = 0
        for own, doc_id, n in zip(buckets, owners, counts.tolist()):
            if lengths and (own != bucket or held >= shard_ids):
                yield close()
                shard = shard + 1 if own == bucket else 0
                runs, doc_ids, lengths, held = [], [], [], 0
            bucket = own
            runs.append(ids[at:at + n])
            doc_ids.append(doc_id)
            lengths.append(n)
            at += n
            held += n
    if lengths:
        yield close()


def write_tokens(
    docs: DataFrame, folder: str, vocabulary: str | None = None, shard_ids: int = SHARD_IDS,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Tokenize and write all texts below ``folder`` in ascending id; gives the manifest.

    The manifest (``bucket, shard, path, docs, ids, start``) lists the shards with the number of ids
    before each. Ids must be integers. Null and empty text give the end id alone; a null ``doc_id``
    comes first; repeated rows are documents of their own; an empty table gives no shards; other columns
    are ignored. Texts are shuffled once, to ranges of ids cut from a bounded sketch, and streamed
    in order; a task holds one shard of ids.
    """
    vocabulary = vocabulary or default_vocabulary()
    folder = full_address(docs.sparkSession, folder)
    points = range_points(docs, id_col, 2 * shuffle_tasks(docs.sparkSession))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    ordered = in_ranges(rows, "doc_id", points).select("bucket", "doc_id", "text").repartitionById(len(points) + 1, "bucket").sortWithinPartitions("bucket", "doc_id", "text")
    manifest = stored(ordered.mapInArrow(
        lambda batches: _write_shards(batches, folder, vocabulary, shard_ids), MANIFEST), "token-manifest")
    # ids before each bucket: one number for each bucket, and these are some to a task slot
    totals = {r["bucket"]: r["n"] for r in manifest.groupBy("bucket").agg(F.sum("ids").alias("n")).collect()}
    before, held = [], 0
    for b in range(len(points) + 1):
        before.append(held)
        held += totals.get(b, 0)
    in_bucket = Window.partitionBy("bucket").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bucket_start = F.get(F.array(*[F.lit(n).cast("long") for n in before]), F.col("bucket"))
    return manifest.withColumn("start", bucket_start + F.coalesce(F.sum("ids").over(in_bucket), F.lit(0)))


def _read_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, start in zip(*(c.to_pylist() for c in batch.columns)):
            with _open(path, "r") as file:
                shard = Shard(file)
                first = 0
                while first < len(shard.lengths):
                    # as many documents as hold READ_IDS ids, one at least
                    upto = int(np.searchsorted(shard.starts, shard.starts[first] + READ_IDS))
                    upto = max(upto, first + 1)
                    part = slice(first, upto)
                    lengths = shard.lengths[part]
                    ids = shard.read(int(shard.starts[first]), int(lengths.sum())).astype("<u4")
                    runs = [ids[e - n:e].tobytes() for e, n in zip(np.cumsum(lengths).tolist(), lengths.tolist())]
                    doc_ids = shard.doc_ids[part]
                    yield pa.RecordBatch.from_arrays([
                        pa.array(doc_ids, mask=doc_ids == NULL_ID), pa.array(start + shard.starts[part]),
                        pa.array(lengths), pa.array(runs, pa.binary()),
                    ], names=["doc_id", "start", "n_tokens", "ids"])
                    first = upto


def read_tokens(manifest: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` of every document from the shards of a manifest.

    ``ids`` are little-endian unsigned 32-bit numbers, ``start`` the number of ids before the document.
    """
    tasks = shuffle_tasks(manifest.sparkSession)
    return manifest.select("path", "start").repartition(2 * tasks).mapInArrow(
        _read_shards, "doc_id long, start long, n_tokens long, ids binary")
