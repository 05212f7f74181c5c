"""Stored tables: a folder of versioned Parquet tables that change as a whole or not at all.

A commit writes each of its tables to a folder of its own, ``<root>/<table>/<version>``, and at last one row for each of
them into ``<root>/_commits``. That last file is the commit: until it is there readers see the tables of before,
afterwards all new ones. Folders that no row names are leftovers of writes that failed. One writer at a time.

A table may also consist of buckets, each with a folder of its own, of which a commit replaces some. Its rows' ``about`` is
then the schema that the table has now, whatever columns its older buckets were written with.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitalgrid.sources.csv_chunks import root_pattern

#: ``bucket`` is null for a table that is replaced as a whole; a null ``folder`` stands for nothing
COMMITS = "seq long, table_name string, folder string, about string, bucket int"
#: column that buckets are written by
BUCKET = "_bucket"


def _read_parquet(spark: SparkSession, path: str, **options) -> DataFrame | None:
    """The files below a path, None where there is nothing."""
    try:
        return spark.read.options(**options).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
    return None


def _commit_rows(spark: SparkSession, root: str) -> list:
    try:
        rows = spark.read.schema(COMMITS).option("recursiveFileLookup", True).parquet(f"{root}/_commits").collect()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    # within a commit tables are dropped before others are written
    return sorted(rows, key=lambda r: (r["seq"], r["bucket"] is not None or r["folder"] is not None))


def committed(spark: SparkSession, root: str) -> dict[str, dict]:
    """The current state of each table: ``seq, table_name, folder, about, buckets``; empty for a folder without commits.

    ``buckets`` maps the table's buckets to their folders and is None for a table that is one folder.
    """
    tables: dict[str, dict] = {}
    for row in _commit_rows(spark, root):
        name, bucket = row["table_name"], row["bucket"]
        before = tables.pop(name, None)
        if bucket is None:
            if row["folder"] is not None:
                tables[name] = {**row.asDict(), "buckets": None}
            continue
        held = dict(before["buckets"] or {}) if before else {}
        held.pop(bucket, None)
        if row["folder"] is not None:
            held[bucket] = row["folder"]
        tables[name] = {**row.asDict(), "folder": None, "buckets": held}
    return tables


class Commit:
    """Tables that become visible together. Used as a context: an error leaves everything as it was."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.rows = spark, root, []

    def __enter__(self) -> Commit:
        return self

    def write(self, df: DataFrame, name: str, partitions: Sequence[str] = (), about: str | None = None) -> None:
        folder = f"{name}/{uuid.uuid4().hex}"
        df.write.partitionBy(*partitions).parquet(f"{self.root}/{folder}")
        self.rows.append((name, folder, about, None))

    def write_buckets(self, df: DataFrame, name: str, replaced: Iterable[int]) -> int:
        """Replace some buckets of a table by the rows of ``df``, whose ``BUCKET`` is one of them; gives their number."""
        folder, counted = f"{name}/{uuid.uuid4().hex}", Observation()
        about = df.drop(BUCKET).schema.json()
        filled = df.observe(counted, F.collect_set(BUCKET).alias("buckets"), F.count(F.lit(1)).alias("rows"))
        filled.write.partitionBy(BUCKET).parquet(f"{self.root}/{folder}")
        found = set(counted.get["buckets"])
        self.rows += [
            (name, f"{folder}/{BUCKET}={bucket}" if bucket in found else None, about, bucket) for bucket in sorted(replaced)]
        return counted.get["rows"]

    def drop(self, name: str) -> None:
        self.rows.append((name, None, None, None))

    def reread(self, name: str, schema: T.StructType) -> DataFrame:
        """A table of this commit as it is written."""
        folder = next(row[1] for row in self.rows if row[0] == name)
        return self.spark.read.schema(schema).parquet(f"{self.root}/{folder}")

    def __exit__(self, kind, error, trace) -> None:
        if kind is not None or not self.rows:
            return
        last = max((r["seq"] for r in committed(self.spark, self.root).values()), default=0)
        rows = [(last + 1, *row) for row in self.rows]
        self.spark.createDataFrame(rows, COMMITS).coalesce(1).write.parquet(f"{self.root}/_commits/{uuid.uuid4().hex}")


def write_table(df: DataFrame, root: str, name: str) -> None:
    """Replace the table."""
    with Commit(df.sparkSession, root) as commit:
        commit.write(df, name)


def read_table(
    spark: SparkSession, root: str, name: str, schema: T.StructType | str | None = None,
    buckets: Iterable[int] | None = None,
) -> DataFrame | None:
    """The table; if it does not exist, an empty one of ``schema`` (``None`` without a schema).

    Of a table in buckets only ``buckets`` are read, if given. In a folder without commits a table is the plain
    folder of its name.
    """
    current = committed(spark, root)
    found = None
    if name in current and current[name]["buckets"] is not None:
        held = current[name]["buckets"]
        own = T.StructType.fromJson(json.loads(current[name]["about"]))
        folders = [held[b] for b in sorted(held if buckets is None else set(held) & set(buckets))]
        found = spark.read.schema(own).parquet(*[f"{root}/{f}" for f in folders]) if folders \
            else spark.createDataFrame([], own)
    elif name in current:
        found = _read_parquet(spark, f"{root}/{current[name]['folder']}")
    elif not current:
        found = _read_parquet(spark, f"{root}/{name}")
    return found if found is not None or schema is None else spark.createDataFrame([], schema)


def read_tables(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """All tables below ``root``, without those whose names begin with an underscore."""
    current = committed(spark, root)
    if current:
        return {name: read_table(spark, root, name) for name in sorted(current) if not name.startswith(("_", "."))}
    # plain folders, known by the files below them
    path = F.regexp_replace(F.col("_metadata.file_path"), root_pattern(root), "")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(root)
    names = sorted(r[0] for r in files.select(F.split(path, "/")[0]).distinct().collect())
    return {name: spark.read.parquet(f"{root}/{name}") for name in names if not name.startswith(("_", "."))}


def delete_folder(folder: str) -> bool:
    """Remove a folder with all it holds; False where the store is none that Arrow knows: it is then left."""
    import pyarrow as pa
    from pyarrow import fs

    try:
        files, path = fs.FileSystem.from_uri(folder.replace("s3a://", "s3://", 1))
        files.delete_dir(path)
    except (OSError, pa.ArrowInvalid):
        return False
    return True


def remove_old_versions(spark: SparkSession, root: str) -> list[str]:
    """Remove what past commits of the tables wrote, and give those folders; no reader may still use them."""
    current = set()
    for table in committed(spark, root).values():
        current |= {table["folder"]} if table["buckets"] is None else set(table["buckets"].values())
    old = sorted({r["folder"] for r in _commit_rows(spark, root) if r["folder"]} - current)
    return [folder for folder in old if delete_folder(f"{root}/{folder}")]


def table_listing(tables: dict[str, DataFrame]) -> DataFrame:
    """``table_name, n_rows, n_unowned, columns`` (in order) of each table, in no order.

    Unowned rows have no ``user_id`` and take part in no metric.
    """
    listing = None
    for name, df in sorted(tables.items()):
        columns = F.array(*[F.lit(c) for c in df.columns]).cast("array<string>")
        unowned = F.count_if(F.col("user_id").isNull()) if "user_id" in df.columns else F.count("*")
        row = df.agg(F.count("*").alias("n_rows"), unowned.alias("n_unowned")).select(
            F.lit(name).alias("table_name"), "n_rows", "n_unowned", columns.alias("columns"))
        listing = row if listing is None else listing.unionAll(row)
    return listing
