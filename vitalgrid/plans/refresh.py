"""Ingest of what is new: only persons whose export files changed are read, merged and built again.

A ledger beside the tables holds a stamp of every export file. Files that are new, changed or gone name the persons to read,
and their rows replace those of before, since no row of a table depends on files of another person. Tables are stored in buckets of
persons, and only buckets that hold changed persons are written. The result equals that of reading everything anew.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalgrid.params import MetricParams
from vitalgrid.plans.ingest import HEADERS, build_table, columns_by_table, header_table, stage_names, stage_rows
from vitalgrid.plans.metrics import METRICS_TABLE, write_metrics
from vitalgrid.shipping import scratch_folder, ship_package
from vitalgrid.sources import export
from vitalgrid.sources.registry import spec_of_table
from vitalgrid.sources.tables import BUCKET, Commit, committed, delete_folder, read_table

LEDGER, OWN_HEADERS = "_export_files", "_export_headers"
LEDGER_COLUMNS = "file string, user_id string, export_dir string, stamp long, written long"
OWN_HEADERS_COLUMNS = f"user_id string, {HEADERS}"
#: buckets of persons that a store begins with; their number stays
BUCKETS = 64
#: folders that a read names one by one; for more the files of all folders are read that are as new as some file of a changed
#: person, and rows of others dropped
TOLD_FOLDERS = 10_000


def bucket_of(user_id: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(user_id), F.lit(buckets)).cast("int")


def changed_persons(before: DataFrame, now: DataFrame) -> DataFrame:
    """``user_id`` of the persons that have a new file, lack one of before, or have one with another stamp."""
    old, new = (df.select("file", F.struct("user_id", "stamp").alias(name)) for df, name in ((before, "old"), (now, "new")))
    differ = old.join(new, "file", "full").where(~F.col("old").eqNullSafe(F.col("new")))
    return differ.select(F.explode(F.array("old.user_id", "new.user_id")).alias("user_id")).where("user_id is not null").distinct()


def _folders(now: DataFrame, changed: DataFrame) -> list[str] | None:
    """Folders to read for the changed persons, none inside another; None if all are to be read."""
    found = now.join(changed, "user_id", "left_semi").select("export_dir").distinct().limit(TOLD_FOLDERS + 1).collect()
    if len(found) > TOLD_FOLDERS or any(set(r["export_dir"]) & set("*?[]{}\\,") for r in found):
        return None
    outer: list[str] = []
    for folder in sorted((r["export_dir"] for r in found), key=lambda f: f.rstrip("/") + "/"):
        if not outer or not folder.startswith(outer[-1].rstrip("/") + "/"):
            outer.append(folder)
    return outer


def _is_ours(current: dict) -> bool:
    """Whether the tables are those that the ledger tells of: others are replaced as a whole."""
    records = [t for name, t in current.items() if not name.startswith("_") and name != METRICS_TABLE]
    return LEDGER in current and all(t["buckets"] is not None for t in records)


def refresh(
    spark: SparkSession, root: str, out: str, params: MetricParams | None = None, profiles: DataFrame | None = None,
    files: str = "*.csv", buckets: int = BUCKETS,
) -> DataFrame:
    """Bring the tables below ``out`` up to date with the export folders below ``root``.

    As :func:`vitalgrid.plans.ingest.ingest`, but persons without new, changed or vanished files are left as they are. All persons are
    read the first time, for another root, after an ``ingest`` to the same place, and when a column gets another type.
    Tables, ledger and headers are one commit. A ``metrics_daily`` that is there follows for the changed persons, or for all
    if it was not built from the tables of before. Result: ``table_name, rows_written, persons, buckets`` of the
    tables written (of the last two: how many were changed); empty if nothing changed.
    """
    ship_package(spark)
    current = committed(spark, out)
    about = json.loads(current[LEDGER]["about"]) if _is_ours(current) else {}
    known = about.get("root") == root
    buckets = about["buckets"] if known else buckets
    measured = METRICS_TABLE in current
    fresh = known and measured and current[METRICS_TABLE]["seq"] > current[LEDGER]["seq"]
    staging = scratch_folder(spark, "refresh", out)
    try:
        # listed once: files that come later are found the next time
        export.list_export_files(spark, root, files).write.parquet(f"{staging}/files")
        now = spark.read.schema(LEDGER_COLUMNS).parquet(f"{staging}/files")
        listed = spark.read.schema("path string").parquet(f"{staging}/files")
        run = _Refresh(spark, root, out, files, buckets, now, listed)
        report = run.replace(f"{staging}/some", read_table(spark, out, LEDGER)) if known else None
        some = report is not None
        if not some:
            report = run.replace(f"{staging}/all", None)
        if measured and (report or not fresh):
            write_metrics(spark, out, params, profiles, **(
                {"changed": run.changed, "buckets": run.touched} if some and fresh else {}))
        persons = run.changed.count()
    finally:
        delete_folder(staging)
    return spark.createDataFrame(
        [(name, rows, persons, len(run.touched)) for name, rows in report],
        "table_name string, rows_written long, persons long, buckets int")


class _Refresh:
    """One refresh of the tables at ``out`` from the files listed in ``now``."""

    def __init__(self, spark: SparkSession, root: str, out: str, files: str, buckets: int, now: DataFrame, listed: DataFrame):
        self.spark, self.root, self.out, self.files, self.buckets = spark, root, out, files, buckets
        self.now, self.listed = now, listed

    def replace(self, staging: str, before: DataFrame | None) -> list[tuple[str, int]] | None:
        """Replace the rows of persons whose files differ from the ledger ``before`` (None: of all persons).

        Gives the tables with their rows written; None if types changed, so that the other persons' rows cannot stay.
        """
        spark, now = self.spark, self.now
        everyone = before is None
        changed_persons(now.limit(0) if everyone else before, now).write.parquet(f"{staging}/changed")
        self.changed = changed = spark.read.schema("user_id string").parquet(f"{staging}/changed")
        self.touched = sorted(r[0] for r in changed.select(bucket_of(F.col("user_id"), self.buckets)).distinct().collect())
        if not self.touched:
            return []
        staged, headers, blobs = self._staged(staging, everyone)
        tables = {}
        for name, columns in columns_by_table(headers).items():
            table = build_table(staged, headers, columns, spec_of_table(list(columns)), blobs)
            stored = None if everyone else read_table(spark, self.out, name, buckets=self.touched)
            if stored is not None:
                types = {c.lower(): kind for c, kind in table.dtypes}
                if any(types.get(c.lower(), kind) != kind for c, kind in stored.dtypes):
                    return None
                kept = stored.join(changed, "user_id", "left_anti")
                table = table.unionByName(kept, allowMissingColumns=True).select(table.columns)
            tables[name] = table.withColumn(BUCKET, bucket_of(F.col("user_id"), self.buckets)).hint("rebalance", BUCKET)
        with Commit(spark, self.out) as commit:
            for name in committed(spark, self.out):
                if not name.startswith("_") and name != METRICS_TABLE and (everyone or name not in tables):
                    commit.drop(name)
            report = [(name, commit.write_buckets(table, name, self.touched)) for name, table in tables.items()]
            commit.write(spark.read.schema(OWN_HEADERS_COLUMNS).parquet(f"{staging}/own_headers"), OWN_HEADERS)
            commit.write(now, LEDGER, about=json.dumps({"root": self.root, "buckets": self.buckets}))
        return report

    def _staged(self, staging: str, everyone: bool) -> tuple[DataFrame, DataFrame, export.Blobs | None]:
        """Rows of the changed persons, the headers of all persons, and blobs."""
        spark, changed = self.spark, self.changed
        within = None if everyone else _folders(self.now, changed)
        if within == []:  # all that changed is gone
            rows, blobs = spark.createDataFrame([], export.ROW_SCHEMA), None
        else:
            since = {}
            if within is None and not everyone:
                since["since"] = self.now.join(changed, "user_id", "left_semi").agg(F.min("written")).first()[0]
            rows = export.read_export_rows(spark, self.root, self.files, within, **since)
            blobs = stage_names(export.read_export_blobs(spark, self.root, within, self.listed), f"{staging}/blobs")
        if not everyone:
            rows = rows.join(changed, "user_id", "left_semi").select(rows.columns)
        staged = stage_rows(rows, f"{staging}/rows")
        header_table(staged).write.parquet(f"{staging}/headers")
        named = spark.read.schema(HEADERS).parquet(f"{staging}/headers")
        own = staged.where("part = 'header'").select("user_id", "datatype_id", "header_id").distinct() \
            .join(named, ["datatype_id", "header_id"]).select("user_id", *named.columns)
        stored = None if everyone else read_table(spark, self.out, OWN_HEADERS)
        if stored is not None:
            own = own.unionByName(stored.join(changed, "user_id", "left_anti"))
        own.write.parquet(f"{staging}/own_headers")
        headers = spark.read.schema(OWN_HEADERS_COLUMNS).parquet(f"{staging}/own_headers")
        return staged, headers.drop("user_id").dropDuplicates(["datatype_id", "header_id"]), blobs
