"""Packing by power-of-two decomposition.

A document of n tokens is cut into full pieces of ``MAX_LENGTH`` tokens and one piece for each binary
digit of the rest. Every piece is a sequence of its own: no sequence crosses documents, and since
all lengths are powers of two, nothing is padded. Equal lengths form a bucket, from which batches of
one shape are drawn.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalgrid.llm.common import handing_back
from vitalgrid.llm.tokens import default_vocabulary, text_slices, word_tokenizer

MAX_LENGTH = 2048
PIECES = "doc_id {id}, start long, length long, doc_tokens long, ids binary"
#: pieces handed back at once
ROWS = 20_000


def binary_pieces(lengths: np.ndarray, most: int = MAX_LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document number, start and length of the pieces of documents of these lengths, in order.

    ``most`` is a power of two. Pieces of a document fall in length.
    """
    whole, rest = np.divmod(lengths, most)
    powers = most >> np.arange(1, most.bit_length())
    # one column of full pieces, then one for each power of two in the rest
    count = np.column_stack([whole, (rest[:, None] & powers) > 0]).astype(np.int64)
    doc = np.repeat(np.arange(len(lengths)), count.sum(1))
    size = np.repeat(np.tile(np.concatenate([[most], powers]), len(lengths)), count.ravel())
    ends = np.cumsum(size)
    first = np.concatenate([[0], np.cumsum(lengths)])[doc]
    return doc, ends - size - first, size


def _pieces_of(batches: Iterator[pa.RecordBatch], vocabulary: str, most: int) -> Iterator[pa.RecordBatch]:
    tokenizer = word_tokenizer(vocabulary)
    for batch in text_slices(batches, "text"):
        ids, lengths = tokenizer.encode(batch.column(1))
        doc, start, size = binary_pieces(lengths, most)
        # the pieces cover the ids without a gap, so their ends are the offsets of one binary column
        data = pa.py_buffer(ids.astype("<u4").tobytes())
        ends = np.concatenate([[0], np.cumsum(size * 4)])
        for at in range(0, len(doc), ROWS):
            rows = slice(at, at + ROWS)
            offsets = ends[at:at + ROWS + 1]
            column = pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [
                None, pa.py_buffer((offsets - offsets[0]).astype("<i4").tobytes()),
                data.slice(int(offsets[0]), int(offsets[-1] - offsets[0]))])
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array(doc[rows])), pa.array(start[rows]), pa.array(size[rows]),
                pa.array(lengths[doc[rows]]), column,
            ], names=["doc_id", "start", "length", "doc_tokens", "ids"])


def pack(docs: DataFrame, vocabulary: str | None = None, most: int = MAX_LENGTH,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each piece: ``doc_id, start, length, doc_tokens, ids, sequence_id, offset``.

    ``ids`` holds little-endian unsigned 32-bit ids. Null text is empty and gives the end id alone, as
    does empty text; null ids are kept; repeated rows are documents of their own with their own
    sequences; an empty table gives no rows; other columns are ignored. A long text becomes many
    rows. Nothing is shuffled, and what a task lost is computed again alike: a sequence's number is
    its input partition and its place there.
    """
    vocabulary = vocabulary or default_vocabulary()
    if most & (most - 1):
        raise ValueError("the longest piece must be a power of two")
    chosen = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    pieces = chosen.mapInArrow(
        lambda batches: handing_back(_pieces_of(batches, vocabulary, most)),
        PIECES.format(id=dict(chosen.dtypes)["doc_id"]))
    return pieces.select(
        "*", F.monotonically_increasing_id().alias("sequence_id"), F.lit(0).cast("long").alias("offset"))


def write_buckets(packed: DataFrame, path: str) -> None:
    """Store packed pieces in one folder for each length, so that a reader draws batches of one shape."""
    packed.write.partitionBy("length").parquet(path)
