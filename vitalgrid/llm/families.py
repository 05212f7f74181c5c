"""Linking similar sets, family by family, in blocks of bounded size.

Sets that share a leading token elect the one with the smallest name; each set lives with the leader that most
of its leading tokens elect. Small families share a block, large ones are split by size, and each part also
gets the leader. Within a block sets already known to be connected are not compared. Across blocks only leading
tokens are looked at whose sets are in several blocks and not connected; there all sets but those of the token's
largest component are searched in the other blocks. So components come out whole, whatever the number of
pairs, and no group is gathered in one place.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalgrid.llm.common import stored
from vitalgrid.llm.components import components
from vitalgrid.llm.ngrams import ngram_sets, set_names
from vitalgrid.llm.prefix_tree import Groups, PrefixTree
from vitalgrid.llm.tokens import text_slices

#: tokens in a block, each set counting SET_WEIGHT tokens more
BLOCK_WEIGHT, SET_WEIGHT = 200_000, 100
#: numbers held by a search
CELLS = 1_000_000


def named_sets(batch: pa.RecordBatch, words: int) -> Iterator[tuple[int, np.ndarray]]:
    """Name and n-grams of each text: a 64-bit sum over the set, 0 for an empty one, and ascending hashes."""
    tokens, number = ngram_sets(batch.column("text"), words)
    yield from zip(set_names(tokens, number).tolist(), np.split(tokens, np.cumsum(number)[:-1]))


def blobs(flat: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """One binary cell for each stretch of ``flat``."""
    data = np.ascontiguousarray(flat)
    return pa.Array.from_buffers(pa.binary(), len(cuts) - 1, [
        None, pa.py_buffer((np.asarray(cuts) * data.itemsize).astype("<i4").tobytes()), pa.py_buffer(data.tobytes())])


def _blocks(leading: DataFrame) -> DataFrame:
    """``key, n, home, block, split, leads`` of the sets that share a leading token with another.

    ``home`` is the leader a set lives with, ``split`` whether its family is spread over several blocks,
    ``leads`` whether the set leads such a family.
    """
    held = leading.select("key", "n", F.explode("leading").alias("token"))
    elected = held.groupBy("token").agg(F.min("key").alias("leader"), F.count("*").alias("members")).where("members > 1")
    votes = held.join(elected.select("token", "leader"), "token").groupBy("key", "n", "leader").agg(F.count("*").alias("votes"))
    homes = stored(votes.groupBy("key", "n").agg(F.max_by("leader", F.struct("votes", -F.col("leader"))).alias("home"))
                   .withColumn("class", F.floor(F.log(1.1, F.col("n"))).cast("int")), "homes")
    weight = F.sum(F.col("n") + F.lit(SET_WEIGHT)).cast("double")
    of_class = homes.groupBy("home", "class").agg(weight.alias("class_weight"))
    of_home = of_class.groupBy("home").agg(F.sum("class_weight").alias("home_weight"))
    packs = math.ceil((homes.agg(weight.alias("w")).first()["w"] or 0) / BLOCK_WEIGHT)
    sized = homes.join(of_class, ["home", "class"]).join(of_home, "home")
    large = F.col("home_weight") > BLOCK_WEIGHT
    part = F.pmod(F.xxhash64("key"), F.ceil(F.col("class_weight") / BLOCK_WEIGHT))
    placed = sized.select("key", "n", "home", F.when(large, F.xxhash64("home", "class", part)).otherwise(
        F.pmod(F.xxhash64("home"), F.lit(max(1, packs)))).alias("block"), large.alias("split"))
    leaders = placed.where("split").select(F.col("home").alias("key"), F.lit(True).alias("leads")).distinct()
    return placed.join(leaders, "key", "left").withColumn("leads", F.coalesce("leads", F.lit(False)))


SET_COLUMNS = ("key", "home", "block", "split", "leads", "bits")


def _sets(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    for batch in text_slices(batches, "text"):
        found = list(named_sets(batch, words))
        # texts of equal hash may differ
        right = [i for i, (key, wanted) in enumerate(zip((k for k, _ in found), batch.column("key").to_pylist())) if key == wanted]
        cuts = np.cumsum([0, *[len(found[i][1]) for i in right]])
        flat = np.concatenate([np.zeros(0, np.uint64), *[found[i][1] for i in right]])
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(c).take(pa.array(right, pa.int64())) for c in SET_COLUMNS], blobs(flat, cuts)],
            names=[*SET_COLUMNS, "tokens"])


def _examples(described: DataFrame) -> DataFrame:
    """``key, _id, _hash, copies``: a row of ``docs`` for each set, one that is repeated least often."""
    rows = described.where("n > 0").groupBy("key", "doc_id", "text_hash").agg(F.count("*").alias("copies"))
    best = rows.groupBy("key").agg(F.min(F.struct("copies", "text_hash", "doc_id")).alias("best"))
    return best.select("key", F.col("best.doc_id").alias("_id"), F.col("best.text_hash").alias("_hash"), "best.copies")


def _sets_of(texts: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """``key, home, block, split, leads, bits, tokens``: each set made once more, from the text of its example."""
    def made(of: DataFrame) -> DataFrame:
        # never by broadcast: the number of sets has no bound
        found = texts.join(of.hint("merge"), F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_hash")))
        return found.select("text", *SET_COLUMNS).mapInArrow(
            lambda b: _sets(b, words), "key long, home long, block long, split boolean, leads boolean, bits binary, tokens binary")

    repeated = wanted.where("copies > 1")
    if repeated.isEmpty():
        return made(wanted)
    return made(wanted.where("copies = 1")).unionAll(made(repeated).dropDuplicates(["key"]))


class TreeIndex:
    """The sets of a block as a prefix tree."""

    def __init__(self, table: pa.Table, percent: int):
        self.tree = PrefixTree(self.probes(table), percent)
        #: what a probe takes in a search, in numbers
        self.cells = len(self.tree.parent)

    def probes(self, table: pa.Table) -> list[np.ndarray]:
        return [np.frombuffer(t.as_py(), np.uint64) for t in table.column("tokens")]

    def search(self, probes, some: np.ndarray, own: np.ndarray | None, group: np.ndarray, sets_group: np.ndarray):
        """Places of linked probes and sets that are not in one group; ``some`` of the probes are searched."""
        return self.tree.search([probes[i] for i in some], own, group, sets_group)


def _distinct(table: pa.Table) -> pa.Table:
    keys = table.column("key").to_numpy()
    return table.take(pa.array(np.unique(keys, return_index=True)[1]))


def _within(table: pa.Table, index) -> pa.Table:
    """``key, block, label``: sets of a block that are connected have one label, the name of one of them.

    Where the leader of a split family is among them it gives the label, so that labels agree across its blocks.
    """
    guests = _distinct(table.filter(pc.field("guest")))
    own = _distinct(table.filter(~pc.field("guest")))
    guests = guests.filter(pa.array(~np.isin(guests.column("key").to_numpy(), own.column("key").to_numpy())))
    both = pa.concat_tables([own, guests])
    keys = both.column("key").to_numpy()
    found_in = index(both)
    probes = found_in.probes(both)
    groups = Groups(np.arange(len(keys)))
    leads = np.isin(keys, np.unique(own.column("home").to_numpy()[own.column("split").to_numpy(zero_copy_only=False)]))
    # leaders first; few at first, since what they connect is not searched again
    order, at, step = np.argsort(~leads, kind="stable"), 0, 1
    while at < len(order):
        step = max(1, min(4 * step, CELLS // found_in.cells))
        some = order[at:at + step]
        probe, found = found_in.search(probes, some, some, groups.of[some], groups.of)
        groups.merge(some[probe], found)
        at += step
    label = np.full(len(keys), np.iinfo(np.int64).max)
    np.minimum.at(label, groups.of, keys)
    led = np.full(len(keys), np.iinfo(np.int64).max)
    np.minimum.at(led, groups.of[leads], keys[leads])
    label = np.where(led < np.iinfo(np.int64).max, led, label)[groups.of]
    n = own.num_rows
    pa.default_memory_pool().release_unused()  # the worker goes on with other blocks and stages
    return pa.table({"key": keys[:n], "block": own.column("block"), "label": label[:n]})


def _across(table: pa.Table, index) -> pa.Table:
    """Links between probes and sets of a block, enough to connect all components that linked pairs connect."""
    own, guests = (_distinct(table.filter(f)) for f in (~pc.field("guest"), pc.field("guest")))
    if not own.num_rows or not guests.num_rows:
        return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
    found_in = index(own)
    probes = found_in.probes(guests)
    names, labels = np.unique(np.concatenate([own.column("label").to_numpy(), guests.column("label").to_numpy()]),
                              return_inverse=True)
    groups = Groups(np.arange(len(names)))
    own_label, label = labels[:own.num_rows], labels[own.num_rows:]
    own_keys, keys = own.column("key").to_numpy(), guests.column("key").to_numpy()
    left, right, at = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], 0
    step = max(1, min(256, CELLS // found_in.cells))
    while at < len(keys):
        some = np.arange(at, min(at + step, len(keys)))
        probe, found = found_in.search(probes, some, None, groups.of[label[some]], groups.of[own_label])
        groups.merge(label[some[probe]], own_label[found])
        left.append(keys[some[probe]])
        right.append(own_keys[found])
        at += step
    pa.default_memory_pool().release_unused()
    return pa.table({"a": np.concatenate(left), "b": np.concatenate(right)})


def linking_pairs(texts: DataFrame, described: DataFrame, leading: DataFrame, words: int, percent: int, index) -> DataFrame:
    """Pairs ``a, b`` of names of sets that connect all linked sets.

    ``described`` has ``doc_id, text_hash, key, n`` of each text of ``texts`` (``doc_id, text``), ``leading`` has ``key, n, leading``
    of each set that may be linked with another, and ``bits`` for the index; linked sets share one of their
    leading tokens. ``index(table)`` makes the search structure of a block (see :class:`TreeIndex`).
    """
    placed = _blocks(leading).join(leading.select("key", "bits"), "key")
    wanted = stored(placed.join(_examples(described), "key"), "placed-sets")
    sets = stored(_sets_of(texts, wanted, words), "token-sets")
    columns = ["key", "home", "block", "split", "bits", "tokens", "guest"]
    own = sets.withColumn("guest", F.lit(False)).select(columns)
    # the leader of a split family is a guest in each of its blocks
    parts = wanted.where("split").select("home", "block").distinct()
    leaders = sets.where("leads").select("key", "bits", "tokens").join(parts, F.col("key") == F.col("home")).select(
        "key", "home", "block", F.lit(True).alias("split"), "bits", "tokens", F.lit(True).alias("guest"))
    labels = stored(own.unionAll(leaders.select(columns)).groupBy("block").applyInArrow(
        lambda t: _within(t, index), "key long, block long, label long"), "labels")

    held = leading.join(labels, "key").select("key", "n", "block", "label", F.explode("leading").alias("token"))
    unsettled = held.groupBy("token").agg(
        F.min("label").alias("l0"), F.max("label").alias("l1"), F.min("block").alias("b0"), F.max("block").alias("b1"),
    ).where("l0 != l1 and b0 != b1").select("token")
    open_ = stored(held.join(unsettled, "token"), "open-tokens")
    tied = labels.where("key != label").select(F.col("key").alias("a"), F.col("label").alias("b"))
    if open_.isEmpty():
        return tied
    largest = open_.groupBy("token", "label").agg(F.count("*").alias("members")).groupBy("token").agg(
        F.max_by("label", F.struct("members", "label")).alias("largest"))
    places = open_.groupBy("token", "block").agg(
        F.min("n").alias("n0"), F.max("n").alias("n1"), F.min("label").alias("l0"), F.max("label").alias("l1"))
    probes = open_.join(largest, "token").where("label != largest").select(
        "token", "key", "n", F.col("block").alias("own_block"), "label").join(places, "token").where(
        (F.col("block") != F.col("own_block")) & ~((F.col("l0") == F.col("label")) & (F.col("l1") == F.col("label")))
        & (F.col("n") * 100 >= F.col("n0") * percent) & (F.col("n1") * 100 >= F.col("n") * percent))
    probes = stored(probes.select("key", "label", "block").distinct(), "probes")
    # a block searched by many is searched in several tasks
    weights = leading.select("key", (F.col("n") + F.lit(SET_WEIGHT)).alias("w"))
    slots = probes.join(weights, "key").groupBy("block").agg(F.ceil(F.sum("w") / BLOCK_WEIGHT).alias("slots"))
    trees = labels.join(slots, "block").select(
        "key", "label", "block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slots") - 1)).alias("slot"),
        F.lit(False).alias("guest"))
    guests = probes.join(slots, "block").select(
        "key", "label", "block", F.pmod(F.xxhash64("key", "block"), "slots").alias("slot"), F.lit(True).alias("guest"))
    needed = trees.unionAll(guests).join(sets.select("key", "bits", "tokens"), "key")
    found = stored(needed.groupBy("block", "slot").applyInArrow(
        lambda t: _across(t, index), "a long, b long"), "links")
    return tied.unionAll(found)


def named_components(described: DataFrame, links: DataFrame) -> DataFrame:
    """``key, component_id``: the smallest ``doc_id`` of each set's component."""
    found = components(links)
    sets = described.where("n > 0").groupBy("key").agg(F.min("doc_id").alias("low"))
    placed = stored(sets.join(found, F.col("key") == F.col("node"), "left").select(
        "key", "low", F.coalesce("component", "key").alias("component")), "placed-sets")
    lowest = placed.groupBy("component").agg(F.min("low").alias("component_id"))
    return placed.join(lowest, "component").select("key", "component_id")
