"""Exact dedup: a tree merge of sorted digest runs.

Every input partition reduces its texts to a run of distinct digests. The runs are merged in rounds:
in each round ``FAN_IN`` neighbouring runs meet, sorted by digest, and become one run, until a single
run is left for each range of the digest space. An entry holds the identifier that stays and the
number of copies, so that a group of copies is one entry of a run however large it is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitalgrid.llm.common import shuffle_tasks, stored, unused_names

#: runs that meet in one merge
FAN_IN = 8
#: digests held by at least one in so many rows are joined by broadcast; there are at most as many
HEAVY_SHARE = 10_000
#: what must agree for texts to count as equal: SHA-256, length and a hash of another family
VERIFIED = ("text_sha256", "n_bytes", "check")


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, uid`` and the verified digest of each row; ``uid`` tells repeated ids apart."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(
        F.col(id_col).alias("doc_id"), F.monotonically_increasing_id().alias("uid"),
        F.sha2(text, 256).alias("text_sha256"), F.octet_length(text).alias("n_bytes"),
        F.xxhash64(text).alias("check"))


def _order(uid: Column) -> Column:
    # the largest identifier stays, null is the smallest; among repeated ids the first row
    return F.struct(F.col("doc_id").alias("id"), (-uid).alias("row"))


def merged_runs(digested: DataFrame, runs: int, fan_in: int = FAN_IN) -> DataFrame:
    """One entry for each distinct text: its digest, ``keep`` (what stays) and ``group_size``.

    ``runs`` is the number of runs at the leaves: rows are dealt to them by ``uid``, whose high bits
    are the input partition. Each range of digests has its own tree, so the last round is as parallel
    as the first, and a task never holds more than Spark's sort has in memory.
    """
    tasks = shuffle_tasks(digested.sparkSession)
    ranges = 4 * tasks  # several to a task, so that tasks come out even
    range_no = F.conv(F.substring("text_sha256", 1, 6), 16, 10).cast("long") * ranges / 2 ** 24
    level = digested.select(
        *VERIFIED, range_no.cast("int").alias("range"),
        F.shiftright("uid", 33).cast("int").alias("run"),
        _order(F.col("uid")).alias("keep"), F.lit(1).cast("long").alias("group_size"))
    # leaf runs: rows of one partition, combined before they leave it
    level = level.groupBy("range", "run", *VERIFIED).agg(
        F.max("keep").alias("keep"), F.sum("group_size").alias("group_size"))
    while runs > 1:
        level = level.withColumn("run", F.floor(F.col("run") / fan_in).cast("int"))
        level = level.repartition(tasks, "range", "run").sortWithinPartitions("range", "run", *VERIFIED)
        level = level.groupBy("range", "run", *VERIFIED).agg(
            F.max("keep").alias("keep"), F.sum("group_size").alias("group_size"))
        runs = -(-runs // fan_in)
    return level.drop("range", "run")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256, uid`` for every row of ``docs``.

    Null text counts as empty. Of equal texts the largest ``doc_id`` stays (a null id only if there is
    no other); where that id is repeated, its first row. Empty input gives no rows; other columns,
    whatever their names, are ignored. The input is read once: its digests are stored.
    """
    spark = docs.sparkSession
    digested = stored(digests(docs, id_col, text_col), "digests")
    size = digested.agg(
        F.count("*").alias("rows"), (F.max(F.shiftright("uid", 33)) + 1).alias("runs")).first()
    merged = stored(merged_runs(digested, size["runs"] or 0), "digest-runs")
    entry = merged.select(
        *VERIFIED, F.col("keep.id").alias("keep_id"), (-F.col("keep.row")).alias("keep_uid"),
        "group_size")
    # heavy groups: at most HEAVY_SHARE digests can each hold that share of all rows
    is_heavy = F.col("group_size") * HEAVY_SHARE >= F.lit(size["rows"])
    large = size["rows"] > HEAVY_SHARE
    heavy = entry.where(is_heavy) if large else entry
    marked = digested.join(F.broadcast(heavy), list(VERIFIED), "left")
    result = marked.where("keep_uid is not null")
    if large:
        light = digested.join(F.broadcast(heavy.select(*VERIFIED)), list(VERIFIED), "left_anti")
        result = result.unionByName(light.join(entry.where(~is_heavy), list(VERIFIED)))
    return result.select(
        "doc_id", "keep_id", "group_size", (F.col("uid") == F.col("keep_uid")).alias("kept"),
        "text_sha256", "uid")


def keep_distinct(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, one for each distinct text, with all their columns.

    Rows are matched by id and digest. Null ids are matched too. Where the id that stays is repeated
    with the same text, one of its rows is taken.
    """
    staying = exact_groups(docs, id_col, text_col).where(F.col("doc_id").eqNullSafe(F.col("keep_id")))
    digest, kept_id, kept_digest, kept_rows = unused_names(docs, "digest", "kept_id", "kept_digest", "kept_rows")
    kept = stored(staying.groupBy("doc_id", "text_sha256").agg(F.count("*").alias("rows")).toDF(
        kept_id, kept_digest, kept_rows), "kept-ids")
    joined = docs.withColumn(digest, F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256)).join(
        kept, F.col(id_col).eqNullSafe(F.col(kept_id)) & (F.col(digest) == F.col(kept_digest)))
    once = joined.where(F.col(kept_rows) == 1).select(*docs.columns)
    if kept.where(F.col(kept_rows) > 1).isEmpty():
        return once
    repeated = joined.where(F.col(kept_rows) > 1).dropDuplicates([kept_id, digest])
    return once.unionByName(repeated.select(*docs.columns))
