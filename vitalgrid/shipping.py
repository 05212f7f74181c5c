"""What tasks need from the session: this package, and a folder that all executors share."""

from __future__ import annotations

import os
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession

_SHIPPED: set[str] = set()
#: tasks for each core that list folders or files; by default each folder is a task, and few small files are
LISTING_TASKS = 8
#: tasks for each core that read files: many small files are thousands of tasks otherwise, each of which begins anew in Python
READING_TASKS = 32
_LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


def ship_package(spark: SparkSession) -> None:
    """Hand out the package as a ZIP file, once for each session; tasks that run Python code of it need this
    where it is not installed."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    top = Path(__file__).resolve().parent
    path = f"{SparkFiles.getRootDirectory()}/library/{top.name}.zip"
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with zipfile.ZipFile(path, "w") as archive:
        for file in sorted(top.rglob("*.py")):
            archive.write(file, str(file.relative_to(top.parent)))
    context.addPyFile(path)
    _SHIPPED.add(context.applicationId)


def scratch_folder(spark: SparkSession, name: str, near: str | None = None) -> str:
    """A fresh folder below the shared one the cluster names in ``spark.checkpoint.dir``, else below ``near``, which
    must be shared. Without either it lies below the warehouse of a local session; a cluster is refused."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or (near and f"{near.rstrip('/')}/_staging")
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_shared"
    return f"{shared.rstrip('/')}/vitalgrid-{name}-{uuid.uuid4().hex}"


@contextmanager
def few_listing_tasks(spark: SparkSession) -> Iterator[None]:
    """Frames made of many folders in here are listed by some tasks for each core, instead of up to 10,000 tasks."""
    before = spark.conf.get(_LISTING)
    spark.conf.set(_LISTING, min(int(before), LISTING_TASKS * spark.sparkContext.defaultParallelism))
    try:
        yield
    finally:
        spark.conf.set(_LISTING, before)


def in_few_tasks(df: DataFrame, for_each_core: int) -> DataFrame:
    """The frame with at most so many tasks for each core; what a task reads stays side by side."""
    return df.coalesce(for_each_core * df.sparkSession.sparkContext.defaultParallelism)
