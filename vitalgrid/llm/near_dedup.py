"""Near-duplicates by b-bit MinHash.

Each text becomes the set of its five-word shingles, and the set a signature of ``MINIMA`` minima. Whole
minima make the bands, whose equal values nominate candidates. Of each minimum only the low ``BITS``
bits are kept, packed into words; the bits in which two signatures differ, corrected for chance
collisions, estimate the similarity of a candidate pair and discard the hopeless ones. Pairs that
remain are confirmed on full shingle sets, so a link is exact; what can be lost is a pair that no band
nominates (at most ``MISSED`` at the threshold, whatever the threshold: number and length of the bands
follow from it) or whose estimate errs by ``MARGIN`` standard deviations.

Groups are never expanded into all pairs. Equal sets are one node. Sets that share bands are brought together in
blocks of bounded size (see :mod:`vitalgrid.llm.families`), whose signatures are compared by numpy; sets already
known to be connected are not compared, and no pair leaves its block unless it connects two components.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitalgrid.llm.common import handing_back, stored, unused_names
from vitalgrid.llm.families import blobs, linking_pairs, named_components
from vitalgrid.llm.ngrams import mix64, ngram_sets, set_names
from vitalgrid.llm.tokens import text_slices

WORDS = 5
#: similarity that links, in hundredths
PERCENT = 85
#: a pair at the threshold shares no band with at most this probability
MISSED = 1e-6
#: minima that bands may take
MOST_MINIMA = 288
BITS = 2
#: standard deviations below the threshold at which an estimate discards a pair
MARGIN = 4.5
#: texts sketched at once
SLICE_BYTES = 1_000_000
_ODD = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Banding:
    """Bands of whole minima, and the signature that all minima make."""

    rows: int  # minima of a band
    bands: int
    minima: int

    @property
    def signature(self) -> list[str]:
        """Columns of the signature words of 64 bits."""
        return [f"s{i}" for i in range(-(-self.minima * BITS // 64))]


@lru_cache
def banding(percent: int, least_minima: int = 252) -> Banding:
    """The longest bands by which pairs at the threshold are missed with at most ``MISSED``.

    Raises ``ValueError`` for a threshold that ``MOST_MINIMA`` minima cannot cover.
    """
    if not 0 < percent <= 100:
        raise ValueError(f"a similarity of {percent} % is not above 0 and at most 100")
    for rows in range(16, 0, -1):
        alike = (percent / 100) ** rows
        bands = math.ceil(math.log(MISSED) / math.log1p(-alike)) if alike < 1 else 1
        if rows * bands <= MOST_MINIMA:
            return Banding(rows, bands, max(least_minima, rows * bands))
    raise ValueError(f"{MOST_MINIMA} minima do not find pairs that are {percent} % alike")


BAND_ROWS, BANDS, MINIMA = banding(PERCENT).rows, banding(PERCENT).bands, banding(PERCENT).minima
SIGNATURE = len(banding(PERCENT).signature)


def shingle_hashes(text: str | None, words: int = WORDS) -> np.ndarray:
    """Distinct hashes of the text's shingles, ascending.

    Words are runs of anything but ASCII white space, A-Z lower-cased. A text of fewer words is one
    shingle; a text without words has none.
    """
    return ngram_sets(pa.array([text], pa.string()), words)[0]


@lru_cache
def _multipliers(number: int) -> np.ndarray:
    return np.random.default_rng(20240501).integers(0, 2 ** 31, number, dtype=np.uint32) * np.uint32(2) + np.uint32(1)


def minima(shingles: np.ndarray, number: int = MINIMA) -> np.ndarray:
    """Smallest value of each of the hash functions over a set; sets of any size in slices."""
    values = (shingles >> np.uint64(32)).astype(np.uint32) ^ shingles.astype(np.uint32)
    least = np.full(number, 2 ** 32 - 1, np.uint32)
    for i in range(0, len(values), 512):
        np.minimum(least, np.multiply.outer(_multipliers(number), values[i:i + 512]).min(1), out=least)
    return least


def scrambled(least: np.ndarray) -> np.ndarray:
    """Minima mixed with the number of their lane, so that unequal ones agree in their low bits by chance in
    each lane anew: low bits of the minima themselves follow from the low bits of the values in all lanes alike."""
    return mix64(least.astype(np.uint64) + np.arange(1, least.shape[-1] + 1, dtype=np.uint64) * _ODD)


def packed_bits(least: np.ndarray) -> np.ndarray:
    """The low bits of each minimum, side by side in words of 64 bits (rows of minima to rows of words)."""
    number = least.shape[-1]
    words = -(-number * BITS // 64)
    lanes = np.zeros((*least.shape[:-1], words * 64 // BITS), np.uint64)
    lanes[..., :number] = least & least.dtype.type((1 << BITS) - 1)
    lanes = lanes.reshape(*least.shape[:-1], words, 64 // BITS)
    shifts = np.arange(64 // BITS, dtype=np.uint64) * np.uint64(BITS)
    return np.bitwise_or.reduce(lanes << shifts, axis=-1)


def band_keys(least: np.ndarray, plan: Banding = banding(PERCENT)) -> np.ndarray:
    """One 64-bit key for each band from the whole minima of its rows."""
    rows = least[..., :plan.rows * plan.bands].reshape(
        *least.shape[:-1], plan.bands, plan.rows).astype(np.uint64)
    key = np.broadcast_to(np.arange(1, plan.bands + 1, dtype=np.uint64), rows.shape[:-1]) * _ODD
    for i in range(plan.rows):
        key = mix64(key + rows[..., i])
    return key


DESCRIBED = "doc_id {id}, uid long, text_hash long, key long, n int, bits binary, bands array<long>"


def _sketches(batches: Iterator[pa.RecordBatch], plan: Banding) -> Iterator[pa.RecordBatch]:
    for batch in text_slices(batches, "text", SLICE_BYTES):
        tokens, number = ngram_sets(batch.column("text"), WORDS)
        names, ends = set_names(tokens, number), np.cumsum(number)
        # copies in a slice are sketched once
        _, first, copy = np.unique(names, return_index=True, return_inverse=True)
        least = np.zeros((len(first), plan.minima), np.uint32)
        for i, row in enumerate(first.tolist()):
            if number[row]:
                least[i] = minima(tokens[ends[row] - number[row]:ends[row]], plan.minima)
        bits, bands = packed_bits(scrambled(least))[copy], band_keys(least, plan)[copy]
        n = batch.num_rows
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(2), batch.column(3), pa.array(names), pa.array(number.astype(np.int32)),
             blobs(bits.ravel(), np.arange(n + 1) * bits.shape[1]),
             pa.ListArray.from_arrays(pa.array(np.arange(0, n * plan.bands + 1, plan.bands, dtype=np.int32)),
                                      pa.array(bands.view(np.int64).ravel()))],
            names=["doc_id", "uid", "text_hash", "key", "n", "bits", "bands"])


def sketches(docs: DataFrame, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text",
             row_col: str | None = None) -> DataFrame:
    """Name and size of the shingle set, packed signature and band keys of every row; ``uid`` is its ``row_col``."""
    uid = F.lit(None).cast("long") if row_col is None else F.col(row_col)
    chosen = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), uid.alias("uid"))
    plan = banding(percent)
    return chosen.withColumn("text_hash", F.xxhash64("text")).mapInArrow(
        lambda batches: handing_back(_sketches(batches, plan)), DESCRIBED.format(id=dict(chosen.dtypes)["doc_id"]))


# ---- estimates from packed bits ----------------------------------------------------------------

def unequal_lanes(left: str, right: str, percent: int = PERCENT) -> Column:
    """How many minima differ in their kept bits, by bit counts over the packed words."""
    total = None
    ones = sum(1 << (i * BITS) for i in range(64 // BITS))
    mask = F.lit(ones if ones < 2 ** 63 else ones - 2 ** 64).cast("long")
    for name in banding(percent).signature:
        differing = F.col(f"{left}.{name}").bitwiseXOR(F.col(f"{right}.{name}"))
        folded = differing
        for b in range(1, BITS):
            folded = folded.bitwiseOR(F.shiftrightunsigned(differing, b))
        n = F.bit_count(folded.bitwiseAND(mask))
        total = n if total is None else total + n
    return total


def estimated_similarity(left: str, right: str, percent: int = PERCENT) -> Column:
    """Share of equal lanes, corrected for lanes that are equal by chance."""
    chance, number = 0.5 ** BITS, float(banding(percent).minima)
    return (F.lit(1.0) - unequal_lanes(left, right, percent) / F.lit(number) - F.lit(chance)) / F.lit(1 - chance)


def least_estimate(percent: int = PERCENT) -> float:
    """An estimate below this discards a pair: ``MARGIN`` standard deviations under the threshold."""
    chance, similar = 0.5 ** BITS, percent / 100
    equal = similar + (1 - similar) * chance
    return similar - MARGIN * (equal * (1 - equal) / banding(percent).minima) ** 0.5 / (1 - chance)


class SignatureIndex:
    """The sets of a block by their packed signatures."""

    def __init__(self, table: pa.Table, percent: int):
        self.percent, self.lanes, self.floor = percent, banding(percent).minima, least_estimate(percent)
        self.bits, self.sets = self.probes(table)
        self.sizes = np.array([len(s) for s in self.sets], np.int64)
        #: what a probe takes in a search, in numbers
        self.cells = max(1, self.bits.size)
        # places of each set's tokens among all tokens of the block
        self.vocabulary, at = np.unique(np.concatenate(self.sets), return_inverse=True)
        self.places = np.split(at, np.cumsum(self.sizes)[:-1])
        self.seen = np.zeros(len(self.vocabulary), bool)

    def probes(self, table: pa.Table) -> tuple[np.ndarray, list[np.ndarray]]:
        bits = np.frombuffer(b"".join(table.column("bits").to_pylist()), np.uint64)
        return bits.reshape(table.num_rows, -1), [np.frombuffer(t.as_py(), np.uint64) for t in table.column("tokens")]

    def _estimates(self, bits: np.ndarray) -> np.ndarray:
        """Similarity of each probe to each set: equal lanes, corrected for those that are equal by chance."""
        differing = bits[:, None] ^ self.bits[None]
        for b in range(1, BITS):
            differing |= differing >> np.uint64(b)
        ones = np.uint64(sum(1 << (i * BITS) for i in range(64 // BITS)))
        unequal = np.bitwise_count(differing & ones).sum(-1, dtype=np.int64)
        chance = 0.5 ** BITS
        return (1 - unequal / self.lanes - chance) / (1 - chance)

    def search(self, probes, some: np.ndarray, own: np.ndarray | None, group: np.ndarray, sets_group: np.ndarray):
        """Places of linked probes and sets that are not in one group; ``some`` of the probes are searched.

        Sizes and estimates discard pairs, full sets confirm the others.
        """
        bits, tokens = probes
        sizes = np.array([len(tokens[i]) for i in some], np.int64)
        small, large = np.minimum(sizes[:, None], self.sizes), np.maximum(sizes[:, None], self.sizes)
        fits = (small * 100 >= large * self.percent) & (group[:, None] != sets_group) & (
            self._estimates(bits[some]) >= self.floor)
        if own is not None:
            fits[np.arange(len(some)), own] = False
        found_probe, found_set = [], []
        for k in np.flatnonzero(fits.any(1)).tolist():
            mine = tokens[some[k]]
            at = np.minimum(np.searchsorted(self.vocabulary, mine), len(self.vocabulary) - 1)
            at = at[self.vocabulary[at] == mine]
            self.seen[at] = True
            for j in np.flatnonzero(fits[k]).tolist():
                shared = int(np.count_nonzero(self.seen[self.places[j]]))
                if shared * 100 >= (sizes[k] + self.sizes[j] - shared) * self.percent:
                    found_probe.append(k)
                    found_set.append(j)
            self.seen[at] = False
        return np.array(found_probe, np.int64), np.array(found_set, np.int64)


def near_groups(
    docs: DataFrame, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text",
    row_col: str | None = None,
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs``.

    Texts are linked if ``100 * intersection >= percent * union`` of their shingle sets; a component is
    all that links reach, named by its smallest ``doc_id``, which is the one kept. Null and empty texts
    have no shingles and are linked with nothing. Rows with equal sets (told apart by 64-bit sums), repeated rows
    among them, share a component. Null ids count as larger than all others; a component of nothing else has a null name
    and its rows are kept. Of rows that repeat an id and a text all are kept or none. An empty table
    gives no rows; other columns are ignored. A link at the threshold is missed with a probability of at
    most ``MISSED`` by the bands; a ``percent`` that they cannot cover so raises ``ValueError``. ``row_col``
    is a column of distinct numbers of the rows, which the result then has too, as ``uid``.
    """
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    described = stored(sketches(docs, percent, id_col, text_col, row_col), "sketches")
    sets = described.where("n > 0").groupBy("key").agg(F.first(F.struct("n", "bits", "bands")).alias("s"))
    leading = sets.select("key", "s.n", "s.bits", F.col("s.bands").alias("leading"))
    links = linking_pairs(texts, described, leading, WORDS, percent, lambda table: SignatureIndex(table, percent))
    named = named_components(described, links)
    rows = described.select("doc_id", "uid", "n", F.col("key").alias("_key"))
    joined = rows.join(named, (F.col("_key") == F.col("key")) & (F.col("n") > 0), "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return joined.select("doc_id", F.col("n").cast("long").alias("n_shingles"), component.alias("component_id"),
                         F.col("doc_id").eqNullSafe(component).alias("kept"), *(["uid"] if row_col else []))


def keep_one(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` that stay, one for each component, with all their columns.

    Rows are taken by themselves, whatever ids they share: of rows that repeat an id each stays if it is
    in the component of that name. ``docs`` is stored once with numbers of its rows.
    """
    row, = unused_names(docs, "row_number")
    numbered = stored(docs.withColumn(row, F.monotonically_increasing_id()), "numbered-rows")
    kept = near_groups(numbered, percent, row_col=row).where("kept").select(F.col("uid").alias(row))
    return numbered.join(kept, row, "left_semi").select(*docs.columns)
