"""Document fingerprints by Order MinHash.

The elements of a text are its k-mers of ``K`` code points, each with the number of its occurrence. Of
the elements that fall to a component, the ``TUPLE`` smallest by hash are selected, put back into text
order, and their k-mers hashed to one number. Texts agree in a component only if they share both the
k-mers and their order, so the share of equal components follows edit distance and not just content.

Components share one hash function: its leading bits deal the elements to components, and the rest ranks
them, so a text is hashed once however many components there are. Where fewer than ``TUPLE`` elements
fell to a component (short texts) it is filled up by a second hash over all elements.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalgrid.llm.common import in_ranges, range_points, shuffle_tasks
from vitalgrid.llm.near_dedup import mix64

K = 8
TUPLE = 2
COMPONENTS = 64
_DEAL = np.uint64(64 - (COMPONENTS - 1).bit_length())
_ODD = np.uint64(0x9E3779B97F4A7C15)
#: expected elements of a component that are looked at before all are
LOOKED_AT = 16
EDITED = ("doc_id {id}, n_chars long, edited_sha256 string, fingerprint string, "
          "edited_fingerprint string, near_edited double, near_next double")


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)


def kmer_hashes(codes: np.ndarray) -> np.ndarray:
    """A hash for each run of ``K`` code points; a shorter text is one run."""
    if len(codes) < K:
        codes = np.concatenate([codes, np.zeros(K - len(codes), np.uint64)])
    hashes, width = codes + np.uint64(1), 1
    while width < K:  # K is a power of two: runs of twice the width from two neighbours
        hashes = hashes[:-width] * (_ODD + np.uint64(2 * width)) + hashes[width:]
        width *= 2
    return mix64(hashes)


def _elements(kmers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the occurrence-numbered k-mers, and the position of each."""
    bits = np.uint64(max(1, int(len(kmers)).bit_length()))
    low = (np.uint64(1) << bits) - np.uint64(1)
    # sorted by k-mer, then position: occurrences of a k-mer lie side by side in text order
    order = np.sort((kmers & ~low) | np.arange(len(kmers), dtype=np.uint64))
    at = (order & low).astype(np.int64)
    same = np.concatenate([[False], (order[1:] >> bits) == (order[:-1] >> bits)])
    elements = kmers[at]
    if same.any():
        number = np.arange(len(at))
        number = number - np.maximum.accumulate(np.where(same, 0, number))
        elements = elements + number.astype(np.uint64) * _ODD
    return mix64(elements ^ _ODD), at


def _selected(elements: np.ndarray) -> np.ndarray:
    """Rows of the elements selected for each component, ``TUPLE`` to a row (fewer if the text has fewer)."""
    rank = elements & ((np.uint64(1) << _DEAL) - np.uint64(1))
    share = LOOKED_AT * COMPONENTS / len(elements)
    for most in (share, 2.0):
        chosen = np.flatnonzero(rank < np.uint64(most * float(1 << int(_DEAL)))) if most < 1 else np.arange(len(elements))
        chosen = chosen[np.argsort(elements[chosen])]
        bounds = np.searchsorted(elements[chosen] >> _DEAL, np.arange(COMPONENTS + 1, dtype=np.uint64))
        found = np.diff(bounds)
        if most >= 1 or found.min() >= TUPLE:
            break
    width = min(TUPLE, len(elements))
    rows = chosen[np.minimum(bounds[:-1, None] + np.arange(width), len(chosen) - 1)]
    for c in np.flatnonzero(found < width):
        own = chosen[bounds[c]:bounds[c + 1]]
        second = mix64(elements ^ np.uint64((int(c) + 1) * 0xC2B2AE3D27D4EB4F % 2 ** 64))
        second[own] = 0  # what fell here stays selected
        rows[c] = np.argpartition(second, width - 1)[:width] if width < len(elements) else np.arange(width)
    return rows


def fingerprint(text: str | None) -> np.ndarray:
    """``COMPONENTS`` numbers of 32 bits; all zero for a text without characters."""
    if not text:
        return np.zeros(COMPONENTS, np.uint32)
    kmers = kmer_hashes(code_points(text))
    elements, at = _elements(kmers)
    places = np.sort(at[_selected(elements)], axis=1)  # back in text order
    folded = np.full(COMPONENTS, places.shape[1], np.uint64)
    for i in range(places.shape[1]):
        folded = mix64(folded * _ODD + kmers[places[:, i]])
    return (folded >> np.uint64(32)).astype(np.uint32)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of equal components: 1 for equal texts."""
    return float(np.count_nonzero(a == b)) / COMPONENTS


def as_text(print_: np.ndarray) -> str:
    return print_.astype(">u4").tobytes().hex()


def _prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [as_text(fingerprint(t.as_py())) for t in batch.column(1)]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.string())],
                                         names=["doc_id", "fingerprint"])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, fingerprint`` (hex) of every row, without a shuffle.

    Null and empty texts have the fingerprint of zeros; equal texts have equal fingerprints; repeated
    rows and null ids are kept; an empty table gives no rows; other columns are ignored.
    """
    chosen = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return chosen.mapInArrow(_prints, f"doc_id {dict(chosen.dtypes)['doc_id']}, fingerprint string")


def edited_text(text: str, following: str) -> str:
    """The last half of ``text`` (rounded down) replaced by as many first code points of another."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def _with_next(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come in order, the last one a guest that only serves as the next of the one before."""
    before = None
    rows: list[tuple] = []
    kind = None

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        ids, *rest = zip(*rows)
        names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
        return pa.RecordBatch.from_arrays([pa.array(ids, kind), *map(pa.array, rest)], names=names)

    for batch in batches:
        kind = batch.column(0).type
        for id_, guest, text in zip(*(batch.column(i) for i in range(3))):
            id_, guest, text = id_.as_py(), guest.as_py(), text.as_py() or ""
            own = fingerprint(text)
            if before and not before[1]:
                edited = edited_text(before[2], text)
                changed = fingerprint(edited)
                rows.append((
                    before[0], len(before[2]), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(),
                    as_text(before[3]), as_text(changed), likeness(before[3], changed), likeness(before[3], own)))
            before = (id_, guest, text, own)
        if rows:
            yield batch_of(rows)
            rows = []


def compare_with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each text's fingerprint against that of the next document and of itself with that one's beginning
    in place of its last half.

    Next is the one with the next smaller id; after the smallest comes the largest. Null ids come last,
    rows that share an id in the order of a hash of their texts. Null text is empty. One row for each
    row; an empty table gives none; other columns are ignored.

    Rows are dealt to ranges of ids (cut from a bounded sketch; any cut gives the same result) and
    streamed in order. The first row of each range goes to the range before it as well.
    """
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    points = range_points(rows, "doc_id", 2 * shuffle_tasks(docs.sparkSession))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    # the first row of each range: one for each range
    heads = {r["bucket"]: r["head"] for r in in_ranges(rows.select("doc_id", "tie"), "doc_id", points).groupBy("bucket").agg(
        F.max(F.struct("doc_id", "tie")).alias("head")).collect()}
    filled = sorted(heads)
    to = {b: filled[(i + 1) % len(filled)] for i, b in enumerate(filled)}
    listed = docs.sparkSession.createDataFrame(
        [(b, heads[b]["doc_id"], heads[b]["tie"], to[b]) for b in filled],
        f"head_bucket int, head_id {dict(rows.dtypes)['doc_id']}, head_tie long, guest_of int")
    marked = in_ranges(rows, "doc_id", points).join(F.broadcast(listed), F.col("bucket") == F.col("head_bucket"), "left")
    is_head = F.col("doc_id").eqNullSafe(F.col("head_id")) & (F.col("tie") == F.col("head_tie"))
    own = F.struct(F.col("bucket").alias("to"), F.lit(False).alias("guest"))
    guest = F.struct(F.col("guest_of").alias("to"), F.lit(True).alias("guest"))
    placed = marked.select("doc_id", "text", "tie", F.explode(
        F.when(is_head, F.array(own, guest)).otherwise(F.array(own))).alias("place"))
    ordered = placed.select("doc_id", "place.guest", "text", "place.to", "tie").repartitionById(
        len(points) + 1, "to").sortWithinPartitions(
        "to", "guest", F.col("doc_id").desc_nulls_last(), F.col("tie").desc())
    return ordered.select("doc_id", "guest", "text").mapInArrow(
        _with_next, EDITED.format(id=dict(rows.dtypes)["doc_id"]))
