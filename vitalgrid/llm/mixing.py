"""Mixing sources to target weights by systematic sampling.

Every document of a source has the same number of expected copies, target size over source size. Along
a fixed order of the source's documents these are summed; the sum is shifted by one random offset of
the source, and a document is emitted once for each whole number that it crosses. The order goes by
size class first, so that every class is taken in proportion and the taken size comes near its target.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitalgrid.llm.common import WORD_PATTERN, stored, unused_names

#: weights of the sources in the order of their names, repeating
WEIGHTS = (5, 2, 1)
#: a source is taken at most so many times
MAX_REPEATS = 3
#: size classes to a doubling of the size
CLASSES = 8
#: leading hex digits of a document's hash that split a size class for numbering
SPLIT_DIGITS = 2


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def source_targets(
    totals: DataFrame, weights: Sequence[int] = WEIGHTS, max_repeats: int = MAX_REPEATS
) -> DataFrame:
    """``source, source_size`` and each source's ``target``; ``totals`` has one row for each source.

    Sources by code point, null last, weigh ``weights`` in turn and share the sum of all sizes. A target
    stops at ``max_repeats`` times its source's size; the excess goes to the others by weight until
    none is above. That is a common level: ``target = min(cap, level * weight)``. Sources whose cap
    lies lowest for their weight are the capped ones, so one ordered pass finds the level. The
    windows without a key run over one row for each source.
    """
    by_name = Window.partitionBy(F.lit(0)).orderBy(F.col("source").isNull(), "source")
    turn = ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int")
    weighed = totals.withColumns({
        "weight": F.get(F.array(*[F.lit(int(w)) for w in weights]), turn - 1).cast("long"),
        "cap": F.col("source_size") * F.lit(max_repeats)})
    everything = Window.partitionBy(F.lit(0))
    by_cap = everything.orderBy(
        F.col("cap") / F.col("weight"), F.col("source").isNull(), "source")
    before = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    # the level if exactly the sources before this one were capped
    level = F.try_divide(
        F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0)),
        F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    leveled = weighed.withColumn("_level", level.cast("double"))
    open_ = F.col("cap") >= F.col("_level") * F.col("weight")
    # the first source that is not capped gives the level of all
    return leveled.withColumn(
        "_level", F.first(F.when(open_, F.col("_level")), ignorenulls=True).over(
            by_cap.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)),
    ).select(
        "source", "source_size",
        F.least(F.col("cap").cast("double"), F.col("_level") * F.col("weight")).alias("target"))


def _offset(source: Column, seed: int) -> Column:
    """A random number in [0, 1) for each source, the same on every run."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(source, F.lit("\u0000"))).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") / F.lit(2.0 ** 32)


def systematic_copies(
    docs: DataFrame, weights: Sequence[int] = WEIGHTS, max_repeats: int = MAX_REPEATS, seed: int = 0,
    id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", row_col: str | None = None,
) -> DataFrame:
    """``doc_id, source, size, source_size, target, copies`` for every row of ``docs``.

    Size is the number of words; null or empty text has size 0, and a source of nothing but such
    texts has target 0 and no copies. Null is a source of its own. Repeated rows are documents of
    their own. The result depends on the rows alone, not on partitions, except that rows alike in id
    and size may swap their copies. Empty input gives no rows; other columns are ignored. ``row_col`` is a
    column of distinct numbers of the rows, which the result then has too, as ``uid``.

    A source of any size is numbered in parallel: rows are numbered within (source, size class, hash
    prefix), and what the classes and prefixes before them hold is added from a table of counts.
    """
    size = word_count(F.col(text_col))
    # texts are read once; what follows needs some bytes of each document
    sized = stored(docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), size.alias("size"),
        F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")).alias("hash"),
        *([F.col(row_col).alias("uid")] if row_col else []),
    ).withColumns({
        "class": F.floor(F.log2(F.col("size") + F.lit(1.0)) * CLASSES).cast("int"),
        "split": F.substring("hash", 1, SPLIT_DIGITS)}), "mix-sizes")
    cell = ["source", "class", "split"]
    counts = sized.groupBy(*cell).agg(F.count("*").alias("rows"), F.sum("size").alias("words"))
    totals = counts.groupBy("source").agg(F.sum("words").alias("source_size"))
    targets = source_targets(totals, weights, max_repeats)
    along = Window.partitionBy("source").orderBy("class", "split")
    before = counts.withColumn(
        "before", F.coalesce(F.sum("rows").over(
            along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("rows", "words")
    # one row for each cell: what precedes it, and its source's target
    cells = before.alias("b").join(
        targets.alias("t"), F.col("b.source").eqNullSafe(F.col("t.source"))).select(
        F.col("b.source").alias("_source"), F.col("class").alias("_class"),
        F.col("split").alias("_split"), "before", "source_size", "target")
    numbered = sized.withColumn("number", F.row_number().over(
        Window.partitionBy(*cell).orderBy("hash", "doc_id", "size")))
    placed = numbered.join(cells, F.col("source").eqNullSafe(F.col("_source"))
                           & (F.col("class") == F.col("_class")) & (F.col("split") == F.col("_split")))
    expected = F.coalesce(F.try_divide(F.col("target"), F.col("source_size")), F.lit(0.0))
    shift = _offset(F.col("source"), seed)
    end = F.col("before") + F.col("number")
    copies = F.floor(end * expected + shift) - F.floor((end - 1) * expected + shift)
    return placed.select("doc_id", "source", "size", "source_size", "target", copies.alias("copies"),
                         *(["uid"] if row_col else []))


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, max_repeats: int = MAX_REPEATS,
        seed: int = 0) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, with all their columns.

    Each row gets its own number of copies, whatever ids rows share. ``docs`` is stored once with numbers
    of its rows.
    """
    row, copies, copy = unused_names(docs, "row_number", "copies", "copy")
    numbered = stored(docs.withColumn(row, F.monotonically_increasing_id()), "numbered-rows")
    taken = systematic_copies(numbered, weights, max_repeats, seed, row_col=row).where("copies > 0").select(
        F.col("uid").alias(row), F.col("copies").alias(copies))
    return numbered.join(taken, row).withColumn(
        copy, F.explode(F.sequence(F.lit(1), F.col(copies).cast("int")))).select(*docs.columns)
