"""Helpers shared by the corpus operators: shared storage, buckets along an ordered key, heavy keys."""

from __future__ import annotations

import ctypes
import os
import uuid
import zipfile
from bisect import bisect_left
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

#: a word of a text: a run of anything but ASCII white space
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers of the session, once, as a ZIP file that Spark hands out."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    top = Path(__file__).resolve().parents[2]
    path = f"{SparkFiles.getRootDirectory()}/package/vitalgrid.zip"
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with zipfile.ZipFile(path, "w") as archive:
        for file in sorted((top / "vitalgrid").rglob("*.py")):
            archive.write(file, str(file.relative_to(top)))
    context.addPyFile(path)
    _SHIPPED.add(context.applicationId)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder path below the shared folder the cluster names in ``spark.checkpoint.dir``.

    Where that is unset it lies below the warehouse of a local session; a cluster is refused.
    """
    top = spark.conf.get("spark.checkpoint.dir", None)
    if not top:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        top = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_shared"
    return f"{top.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet into the shared folder and read it back: cuts lineage, survives
    lost executors, and computes ``df`` once however often it is read."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unused_names(df: DataFrame, *names: str) -> list[str]:
    """The names, lengthened where the frame has such a column (in any case of letters)."""
    taken = {c.lower() for c in df.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found


def handing_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What a task yields; at its end unused memory is handed back, Arrow's and that of numpy and Python.

    Workers are kept for the tasks to come and wait while the JVM has the memory they would hold on to."""
    try:
        yield from batches
    finally:
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the C library of Linux
        if trim is not None:
            trim(0)


def shuffle_tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def range_points(df: DataFrame, key: str, buckets: int) -> list:
    """At most ``buckets - 1`` ascending values that cut the rows into about equal ranges of ``key``.

    One aggregate with a bounded sketch; the points are all that comes to the driver. Equal inputs
    give equal points only up to the sketch, so results must not depend on them.
    """
    if buckets < 2:
        return []
    shares = [i / buckets for i in range(1, buckets)]
    found = df.agg(F.percentile_approx(key, shares, 10 * buckets).alias("p")).first()["p"]
    return sorted(set(found or []))


def in_ranges(df: DataFrame, key: str, points: list) -> DataFrame:
    """``df`` with ``bucket``: how many of the ascending points lie below ``key``; null is in range 0.

    A binary search in each task, since the number of points grows with the cluster.
    """
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [0 if k is None else bisect_left(points, k) for k in batch.column(key).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found, pa.int32())], names=[*batch.schema.names, "bucket"])

    return df.mapInArrow(place, StructType([*df.schema.fields, StructField("bucket", IntegerType())]))


def crc_remainder(column: str, divisor: int) -> Column:
    """CRC-32 of the column as text, modulo ``divisor``; null counts as empty text."""
    text = F.coalesce(F.col(column).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % divisor
