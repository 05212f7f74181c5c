"""N-gram Jaccard join over prefix trees, exact over 64-bit hashes of n-grams.

1. *Shared tokens.* A token is an n-gram's hash, a set is named by a 64-bit sum over its tokens. Tokens meet by value;
   a token of one set only links nothing. All tokens have one global order: those no other set has, then by
   the power of two below the number of sets that have them, then by value. A set of ``n`` tokens
   shares ``least = ceil(percent * n / 100)`` of them with any set it is linked to, so two linked sets share
   one of the first ``n - least + 1`` tokens of each: their *leading* tokens. Sets whose leading tokens are
   all their own are out. Of sets above ``SMALL`` tokens only a fixed part of all tokens is dealt out; no
   more than ``n - least`` of those can be missing from a partner either, so the same bound holds in that part.
2. *Families.* Sets that share leading tokens are brought together in blocks (see :mod:`vitalgrid.llm.families`). Every
   block is a prefix tree (:class:`PrefixTree`) that its sets, and sets of other blocks which share a leading
   token with it, are searched in.

Components, not pairs, are the result: within a family each set is tied to its component, whatever the
number of pairs. Everything is bounded by blocks, by ``BUCKET_TOKENS`` and by one text.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitalgrid.llm.common import shuffle_tasks, stored
from vitalgrid.llm.families import TreeIndex, blobs, linking_pairs, named_components, named_sets
from vitalgrid.llm.tokens import text_slices

WORDS = 5
PERCENT = 80
#: sets of up to a quarter more than so many tokens deal out all tokens, larger ones those whose three low bits are below
#: PART; a set above SMALL has too few of these for the bound with a probability below 1e-10
SMALL, PART = 320, 3
#: from this similarity on the part is large enough
PART_PERCENT = 80
#: tokens of a map-side run, and of a bucket in which tokens meet
RUN_TOKENS, BUCKET_TOKENS = 2_000_000, 2_000_000
#: a token of one set in so many is frequent: at most as many as so many times the tokens of a mean set
FREQUENT_SHARE = 1000
FREQUENT_LEAST = 2000
FREQUENT_CLASS = 63


def in_part(tokens: np.ndarray) -> np.ndarray:
    return (tokens & np.uint64(7)) < np.uint64(PART)


def _deals_all(n: int, percent: int) -> bool:
    return percent < PART_PERCENT or 4 * n <= 5 * SMALL


def _deals_part(n: int, percent: int) -> bool:
    return percent >= PART_PERCENT and n >= SMALL


class _Run:
    """Distinct sets of one task, gathered up to ``RUN_TOKENS`` tokens."""

    def __init__(self):
        self.clear()

    def clear(self) -> None:
        self.sets: dict[int, np.ndarray] = {}
        self.about: list[tuple[int, int, int]] = []
        self.tokens = 0

    def add(self, key: int, tokens: np.ndarray, percent: int) -> None:
        if key not in self.sets:
            part = tokens[in_part(tokens)]
            self.sets[key] = dealt = tokens if _deals_all(len(tokens), percent) else part
            self.about.append((key, len(tokens), len(part)))
            self.tokens += len(dealt)

    def flat(self) -> tuple[np.ndarray, np.ndarray]:
        """All tokens, and the number of the set of each."""
        sets = list(self.sets.values())
        return np.concatenate(sets), np.repeat(np.arange(len(sets)), list(map(len, sets)))


DESCRIBED = "doc_id {id}, text_hash long, key long, n int, tokens array<long>, sets array<int>"


def _described(batches: Iterator[pa.RecordBatch], words: int, percent: int) -> Iterator[pa.RecordBatch]:
    """A row for each document, and one for each run with its frequent tokens and their numbers of sets."""
    names, run, id_type = ["doc_id", "text_hash", "key", "n", "tokens", "sets"], _Run(), None

    def frequent() -> pa.RecordBatch:
        found, times = np.unique(run.flat()[0], return_counts=True)
        often = times >= 8
        run.clear()
        return pa.RecordBatch.from_arrays(
            [pa.nulls(1, id_type), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int32()),
             pa.array([found[often].view(np.int64)], pa.list_(pa.int64())),
             pa.array([times[often].astype(np.int32)], pa.list_(pa.int32()))], names=names)

    for batch in text_slices(batches, "text"):
        id_type, found = batch.schema.field(0).type, list(named_sets(batch, words))
        for key, tokens in found:
            if len(tokens):
                run.add(key, tokens, percent)
        n = len(found)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(2), pa.array([k for k, _ in found], pa.int64()),
             pa.array([len(t) for _, t in found], pa.int32()), pa.nulls(n, pa.list_(pa.int64())), pa.nulls(n, pa.list_(pa.int32()))], names=names)
        if run.tokens >= RUN_TOKENS:
            yield frequent()
    if run.tokens:
        yield frequent()


DEALT = "bucket int, frequent boolean, keys binary, n binary, n_part binary, tokens binary, owners binary"


def _dealt(batches, words: int, percent: int, buckets: int, frequent: np.ndarray) -> Iterator[pa.RecordBatch]:
    """For each run and bucket its tokens, ascending, and the sets they are of."""
    run = _Run()

    def row(bucket: int, heavy: bool, about: np.ndarray, tokens: np.ndarray, owner: np.ndarray) -> dict:
        listed, owner = np.unique(owner, return_inverse=True)
        # bytes of equal weight side by side: leading ones are nearly constant and shrink in the shuffle
        planes = tokens.view(np.uint8).reshape(-1, 8).T
        held = about[listed]
        return {"bucket": bucket, "frequent": heavy, "keys": held[:, 0].tobytes(), "n": held[:, 1].astype(np.int32).tobytes(),
                "n_part": held[:, 2].astype(np.int32).tobytes(), "tokens": planes.tobytes(),
                "owners": owner.astype(np.uint16 if len(listed) <= 65536 else np.uint32).tobytes()}

    def rows() -> Iterator[pa.RecordBatch]:
        about = np.array(run.about, np.int64)
        tokens, owner = run.flat()
        heavy = np.isin(tokens, frequent)
        light = np.argsort(tokens[~heavy], kind="stable")
        dealt, dealt_owner = tokens[~heavy][light], owner[~heavy][light]
        bucket = ((dealt >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
        cuts = np.searchsorted(bucket, np.arange(buckets + 1).astype(np.uint64))
        made = [row(b, False, about, dealt[i:j], dealt_owner[i:j])
                for b, (i, j) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist())) if i < j]
        if heavy.any():
            made.append(row(int(about[0, 0]) % buckets, True, about, tokens[heavy], owner[heavy]))
        run.clear()
        for i in range(0, len(made), 64):
            yield pa.RecordBatch.from_pylist(made[i:i + 64], schema=pa.schema([
                ("bucket", pa.int32()), ("frequent", pa.bool_()),
                *[(c, pa.binary()) for c in ("keys", "n", "n_part", "tokens", "owners")]]))

    for batch in text_slices(batches, "text"):
        for key, tokens in named_sets(batch, words):
            if len(tokens):
                run.add(key, tokens, percent)
        if run.tokens >= RUN_TOKENS:
            yield from rows()
    if run.tokens:
        yield from rows()


SHARED = "key long, bucket int, n int, n_part int, tokens binary, classes binary"


def _by_set(bucket: int, keys, n, n_part, tokens, classes, owner) -> pa.RecordBatch:
    """A row for each set with its tokens; ``owner`` is the place of a token's set in ``keys``."""
    order = np.argsort(owner, kind="stable")
    listed, cuts = np.unique(owner[order], return_index=True)
    cuts = np.append(cuts, len(order))
    return pa.RecordBatch.from_arrays(
        [pa.array(keys[listed]), pa.array(np.full(len(listed), bucket, np.int32)), pa.array(n[listed]), pa.array(n_part[listed]),
         blobs(tokens[order], cuts), blobs(classes[order].astype(np.uint8), cuts)],
        names=["key", "bucket", "n", "n_part", "tokens", "classes"])


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of the tokens of one bucket those of several sets, by set, with the class of their number of sets."""
    found, passed, base, bucket = [], set(), 0, 0
    for batch in batches:
        for r in batch.to_pylist():
            bucket = r["bucket"]
            keys = np.frombuffer(r["keys"], np.int64)
            n, n_part = (np.frombuffer(r[c], np.int32) for c in ("n", "n_part"))
            tokens = np.ascontiguousarray(np.frombuffer(r["tokens"], np.uint8).reshape(8, -1).T).view(np.uint64).ravel()
            wide = len(r["owners"]) // max(1, len(tokens))
            owner = np.frombuffer(r["owners"], np.uint16 if wide == 2 else np.uint32).astype(np.int64)
            if r["frequent"]:  # counted already; of copies in many runs one row is enough
                new = np.array([k not in passed for k in keys.tolist()])[owner]
                passed.update(keys.tolist())
                if new.any():
                    yield _by_set(-1, keys, n, n_part, tokens[new], np.full(int(new.sum()), FREQUENT_CLASS), owner[new])
            else:
                found.append((keys, n, n_part, tokens, owner + base))
                base += len(keys)
    if not found:
        return
    keys, n, n_part, tokens, owner = (np.concatenate([f[i] for f in found]) for i in range(5))
    found.clear()
    order = np.argsort(tokens, kind="stable")
    same = tokens[order[1:]] == tokens[order[:-1]]
    order = order[np.append(same, False) | np.insert(same, 0, False)] if len(order) else order
    tokens, owner = tokens[order], owner[order]
    # copies of a set in several runs are one set
    key = keys[owner]
    order = np.lexsort((key, tokens))
    once = np.ones(len(order), bool)
    once[1:] = (tokens[order[1:]] != tokens[order[:-1]]) | (key[order[1:]] != key[order[:-1]])
    tokens, owner = tokens[order[once]], owner[order[once]]
    _, at, times = np.unique(tokens, return_inverse=True, return_counts=True)
    several = times[at] > 1
    if several.any():
        # the first place of each key stands for it
        _, first, place = np.unique(keys, return_index=True, return_inverse=True)
        classes = np.log2(times[at[several]]).astype(np.int64)
        yield _by_set(bucket, keys, n, n_part, tokens[several], classes, first[place[owner[several]]])


def _leading(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """The leading tokens that each set shares with others; sets without any are left out."""
    for batch in batches:
        rows = []
        for r in batch.to_pylist():
            tokens = np.frombuffer(b"".join(p["tokens"] for p in r["parts"]), np.uint64)
            classes = np.frombuffer(b"".join(p["classes"] for p in r["parts"]), np.uint8)
            tokens = tokens[np.lexsort((tokens, classes))]
            may_lack = r["n"] - math.ceil(r["n"] * percent / 100)
            lead: list[np.ndarray] = []
            if _deals_all(r["n"], percent):
                lead.append(tokens[:max(0, may_lack + 1 - (r["n"] - len(tokens)))])
            if _deals_part(r["n"], percent):
                part = tokens[in_part(tokens)]
                lead.append(part[:max(0, may_lack + 1 - (r["n_part"] - len(part)))])
            held = np.unique(np.concatenate(lead)) if lead else np.zeros(0, np.uint64)
            if len(held):
                rows.append((r["key"], r["n"], held.view(np.int64)))
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int32()),
             pa.array([r[2] for r in rows], pa.list_(pa.int64()))], names=["key", "n", "leading"])


def _leading_tokens(texts: DataFrame, described: DataFrame, words: int, percent: int) -> DataFrame:
    """``key, n, leading`` of every set that may be linked with another."""
    documents = described.where("n is not null")
    dealt = F.when(F.lit(percent < PART_PERCENT) | (F.col("n") * 4 <= 5 * SMALL), F.col("n")).otherwise(
        F.col("n") * F.lit(PART / 8)).cast("double")
    about = documents.agg(F.count("*").alias("rows"), F.coalesce(F.sum(dealt), F.lit(0.0)).alias("tokens")).first()
    buckets = max(shuffle_tasks(texts.sparkSession), math.ceil(about["tokens"] / BUCKET_TOKENS))
    often = max(FREQUENT_LEAST, about["rows"] // FREQUENT_SHARE)
    found = described.where("tokens is not null").select(
        F.explode(F.arrays_zip("tokens", "sets")).alias("t")).groupBy("t.tokens").agg(
        F.sum("t.sets").alias("sets")).where(F.col("sets") >= often).select("tokens").collect()
    frequent = np.sort(np.array([r[0] for r in found], np.int64).view(np.uint64))
    met = texts.mapInArrow(lambda b: _dealt(b, words, percent, buckets, frequent), DEALT).repartitionById(
        buckets, "bucket").mapInArrow(_shared, SHARED)
    # one row for each set and bucket before the rows of a set are brought together
    once = met.repartition("key").groupBy("key", "bucket").agg(F.first(F.struct("n", "n_part", "tokens", "classes")).alias("r"))
    by_set = once.groupBy("key").agg(
        F.first("r.n").alias("n"), F.first("r.n_part").alias("n_part"),
        F.collect_list(F.struct("r.tokens", "r.classes")).alias("parts"))
    return by_set.mapInArrow(lambda b: _leading(b, percent), "key long, n int, leading array<long>")


def ngram_groups(docs: DataFrame, percent: int = PERCENT, words: int = WORDS, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs``.

    Texts are linked if ``100 * intersection >= percent * union`` of their sets of n-grams (``words`` words
    each, A-Z lower-cased; a shorter text is one n-gram). A component is all that links reach, named by its
    smallest ``doc_id``. Null and empty texts and those without words have no n-grams and are linked with
    nothing. Equal sets, repeated rows among them, are one set. Null ids count as larger than all others; a
    component of nothing else has a null name. An empty table gives no rows; other columns are ignored.
    Sets and n-grams are told apart by 64-bit hashes. The texts are read twice, and those of sets that may
    be linked are shuffled once.
    """
    if not 0 < percent <= 100:
        raise ValueError(f"a similarity of {percent} % is not above 0 and at most 100")
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    described = stored(texts.withColumn("text_hash", F.xxhash64("text")).mapInArrow(lambda b: _described(b, words, percent),
                                        DESCRIBED.format(id=dict(texts.dtypes)["doc_id"])), "described-sets")
    leading = stored(_leading_tokens(texts, described, words, percent).withColumn("bits", F.lit(b"")), "leading-tokens")
    links = linking_pairs(texts, described, leading, words, percent, lambda table: TreeIndex(table, percent))
    named = named_components(described, links)
    component: Column = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    documents = described.where("n is not null").select("doc_id", "n", F.col("key").alias("_key"))
    return documents.join(named, (F.col("_key") == F.col("key")) & (F.col("n") > 0), "left").select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"), component.alias("component_id"))
