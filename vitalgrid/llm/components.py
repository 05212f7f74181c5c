"""Connected components of a link table, by alternating minimum stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vitalgrid.llm.common import stored


def _star(pairs: DataFrame, only_smaller: bool) -> DataFrame:
    """Link each node's neighbours to the smallest among them and itself.

    The large star moves larger neighbours, the small star smaller ones. The minimum is a combined
    aggregate and comes back by an equi-join, so a node with very many neighbours is not gathered.
    """
    both = pairs if only_smaller else pairs.unionAll(pairs.select("b", "a").toDF("a", "b"))
    least = both.groupBy("a").agg(F.min("b").alias("least")).select(
        F.col("a").alias("_a"), F.least("least", "a").alias("least"))
    joined = both.join(least, F.col("a") == F.col("_a"))
    if only_smaller:  # a > b in all pairs
        moved = joined.select(F.col("b").alias("a"), F.col("least").alias("b")).unionAll(
            least.select(F.col("_a"), "least"))
    else:
        moved = joined.where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.where("a > b").distinct()


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for each node of ``links(a, b)``; the component is its smallest node.

    Every round is written to the shared folder, which cuts the lineage. The number of rounds grows
    with the logarithm of the longest chain; only counts come to the driver.
    """
    state = links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    state = stored(state.distinct(), "links")
    size = _size(state)
    while size[0]:
        state = stored(_star(_star(state, False), True), "links")
        after = _size(state)
        if after == size:
            break
        size = after
    return state.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(
        state.select("b", "b").distinct())


def _size(pairs: DataFrame) -> tuple:
    """Number of pairs and a digest of all: equal if a round changed nothing."""
    row = pairs.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("h")).first()
    return row["n"], row["h"]
