"""Row-level table operators: keep-last de-duplication, union by name, first filled table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """Of the rows with equal keys keep the one that comes last in ``order``.

    Null keys equal each other. The winner is found by an aggregate that is combined before the
    shuffle, so a key that holds most of the rows (all rows without a time, say) costs each task
    one row; a window would collect that key in one task. ``order`` must be unique per key.
    """
    values = [c for c in df.columns if c not in keys]
    if not values:
        return df.distinct()
    last = df.groupBy(*keys).agg(F.max_by(F.struct(*values), F.struct(*order)).alias("_last"))
    return last.select(*[
        F.col(c) if c in keys else F.col(f"_last.`{c}`").alias(c) for c in df.columns])


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of all frames; columns a frame lacks are null."""
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame, allowMissingColumns=True)
    return result


def first_filled_table(tables: Sequence[DataFrame]) -> DataFrame:
    """For each person the rows of the first table that has any of theirs."""
    positioned = union_by_name([
        table.withColumn("_position", F.lit(i)) for i, table in enumerate(tables)])
    best = positioned.groupBy("user_id").agg(F.min("_position").alias("_best"))
    joined = positioned.join(best, "user_id")
    return joined.where("_position = _best").drop("_position", "_best")
