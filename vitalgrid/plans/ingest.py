"""Ingest: export folders or archives to typed, de-duplicated tables."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from vitalgrid.functions.clean import (
    EPOCH_MS_BELOW_AT_INGEST, null_tokens_to_null, parse_number, parse_time,
)
from vitalgrid.functions.names import OWN_COLUMNS, header_names
from vitalgrid.operators.dedup import keep_last
from vitalgrid.params import MetricParams
from vitalgrid.plans.metrics import METRICS_TABLE, write_metrics
from vitalgrid.shipping import scratch_folder, ship_package
from vitalgrid.sources import export
from vitalgrid.sources.blobs import ROW_KEY, attach_blobs
from vitalgrid.sources.registry import TableSpec, spec_of, spec_of_table
from vitalgrid.sources.tables import Commit, delete_folder, read_table

#: later rows win: newer export, then file name, then position in the file
LAST_ORDER = ("export_ts", "export_dir", "file_name", "row_no")
#: headers of which each task is told; more of them are joined
TOLD_HEADERS = 10_000
#: bytes of the rows of which a staged file keeps its columns side by side; a task reads one group or more
STAGED_GROUP_BYTES = 4 << 20
HEADERS = "datatype_id string, header_id long, names array<string>"
#: type id -> its column names in order
Columns = dict[str, list[str]]


def stage_rows(rows: DataFrame, staging: str) -> DataFrame:
    """Write rows of files once, split into headers and data and by record type, so that each
    reader opens only what it needs.

    The rebalance evens out the files and lets adaptive execution split a dominant type. Files consist of small groups of
    rows, so that several tasks can read one.
    """
    sized = rows.withColumn("n_cells", F.size("cells"))
    (sized.hint("rebalance", "part", "datatype_id")
     .write.mode("overwrite").option("parquet.block.size", STAGED_GROUP_BYTES).partitionBy("part", "datatype_id").parquet(staging))
    stored = sized.drop("part", "datatype_id").schema
    return rows.sparkSession.read.schema(
        stored.add("part", "string").add("datatype_id", "string")).parquet(staging)


def stage_names(blobs: export.Blobs, staging: str) -> export.Blobs:
    """Write the names of blobs once: every table that refers to some looks for them."""
    blobs.names.write.parquet(staging)
    return blobs._replace(names=blobs.names.sparkSession.read.schema("path string").parquet(staging))


def header_table(staged: DataFrame) -> DataFrame:
    """``datatype_id, header_id, names``: the dictionary of headers, one row for each distinct one of a type.

    Column names are worked out here, once for each header; data rows carry its number.
    """
    distinct = staged.where("part = 'header'").groupBy("datatype_id", "header_id").agg(F.first("cells").alias("cells"))
    return distinct.select("datatype_id", "header_id", header_names("cells").alias("names"))


def _with_headers(rows: DataFrame, headers: DataFrame, about: DataFrame) -> DataFrame:
    """Rows with what ``about`` has of their header; few ``headers`` go to all tasks, more are joined."""
    return rows.join(F.broadcast(about) if headers.count() <= TOLD_HEADERS else about, "header_id")


def _data(staged: DataFrame, datatype_ids: list[str]) -> DataFrame:
    return staged.where((F.col("part") == "data") & F.col("datatype_id").isin(sorted(datatype_ids)))


def columns_by_table(headers: DataFrame) -> dict[str, Columns]:
    """The column names of each table's record types, from any number of different headers.

    One row for each type and column comes to the driver. Columns are in the order of the rightmost
    position that a header gives them.
    """
    named = headers.select("datatype_id", F.posexplode_outer("names").alias("position", "name"))
    found = named.groupBy("datatype_id", "name").agg(F.max("position").alias("position")).collect()
    by_table: dict[str, Columns] = {}
    for row in sorted(found, key=lambda r: (r["datatype_id"], r["position"] or 0, r["name"] or "")):
        columns = by_table.setdefault(spec_of(row["datatype_id"]).table, {}).setdefault(row["datatype_id"], [])
        if row["name"]:
            columns.append(row["name"])
    return dict(sorted(by_table.items()))


def _sources(columns: Columns, spec: TableSpec) -> dict[str, list[str]]:
    """Target column -> the header names it is read from, the new name before the renamed one.

    Names that differ only in case are one column.
    """
    sources: dict[str, dict[str, None]] = {}
    targets: dict[str, str] = {}
    for names in columns.values():
        for name in names:
            target = spec.rename.get(name, name)
            target = targets.setdefault(target.lower(), target)
            sources.setdefault(target, {})[name] = None
    return {t: sorted(names, key=lambda n: n != t) for t, names in sources.items()}


def _places(headers: DataFrame, datatype_ids: list[str], names: list[str]) -> DataFrame:
    """``header_id, places``: where each header has each of the names, -1 where it has not."""
    @F.pandas_udf("array<int>")
    def places(header: pd.Series) -> pd.Series:
        def of(found) -> list[int]:
            at = {name: i for i, name in reversed(list(enumerate(found)))}
            return [at.get(name, -1) for name in names]
        return header.map(of)

    own = headers.where(F.col("datatype_id").isin(datatype_ids)).groupBy("header_id").agg(F.first("names").alias("names"))
    return own.select("header_id", places("names").alias("places"))


def build_table(
    staged: DataFrame, headers: DataFrame, columns: Columns, spec: TableSpec, blobs: export.Blobs | DataFrame | None
) -> DataFrame:
    """Typed and de-duplicated rows of one table; ``columns`` are those of all its record types.

    A cell is taken by its place, which comes with the row's header; names are compared for headers only.
    """
    sources = _sources(columns, spec)
    names = [n for found in sources.values() for n in found]
    number = {n: i for i, n in enumerate(names)}

    def typed(name: str) -> Column:
        # the first of the names that is filled; as text, since a wide table has thousands of these
        cell = F.expr(f"coalesce({', '.join(f'get(filled, {number[n]})' for n in sources[name])})")
        if name in spec.times:
            return parse_time(cell, EPOCH_MS_BELOW_AT_INGEST)
        return parse_number(cell) if name in spec.numbers else cell

    placed = _with_headers(_data(staged, list(columns)), headers, _places(headers, sorted(columns), names)).withColumn(
        "filled", F.transform("places", lambda place: null_tokens_to_null(F.get("cells", place))))
    rows = placed.select(*OWN_COLUMNS, *ROW_KEY, "datatype_id", *[typed(c).alias(c) for c in sources])
    keys = [c for c in spec.times if c in sources]
    if keys:
        rows = keep_last(rows, ["user_id", *keys], LAST_ORDER)
    found = list(sources)
    for name in spec.blobs:
        if name in sources:
            rows = attach_blobs(rows, name, blobs)
            found.append(f"{name}_json")
    return rows.select(*OWN_COLUMNS, *found)


def wide_rows(staged: DataFrame, headers: DataFrame) -> DataFrame:
    """``datatype_id, wide_rows``: data rows with filled cells beyond their header (those cells are cut)."""
    widths = staged.where("part = 'data'").groupBy("datatype_id", "header_id", F.size("cells").alias("n")) \
        .agg(F.count("*").alias("rows")) if "n_cells" not in staged.columns else \
        staged.where("part = 'data'").groupBy("datatype_id", "header_id", F.col("n_cells").alias("n")).agg(F.count("*").alias("rows"))
    known = headers.select("datatype_id", "header_id", F.size("names").alias("width"))
    return widths.join(known, ["datatype_id", "header_id"]).groupBy("datatype_id").agg(
        F.sum(F.when(F.col("n") > F.col("width"), F.col("rows")).otherwise(0)).alias("wide_rows"))


def ingest(
    spark: SparkSession, root: str, out: str, archives: bool = False,
    params: MetricParams | None = None, profiles: DataFrame | None = None, files: str = "*.csv",
) -> DataFrame:
    """Read every export below ``root``, write one table per record type below ``out``.

    With ``archives`` the exports are ZIP files instead of folders. All tables are replaced by one commit, and a
    ``metrics_daily`` that is there is built again from the new tables, with ``params`` and ``profiles``
    or else those it was built with. Result: ``table_name, row_count, wide_rows``.
    """
    ship_package(spark)
    rows = export.read_archive_rows(spark, root) if archives else export.read_export_rows(spark, root, files)
    blobs = export.read_archive_blobs(spark, root) if archives \
        else export.read_export_blobs(spark, root)
    staging = scratch_folder(spark, "ingest", out)
    try:
        staged = stage_rows(rows, f"{staging}/rows")
        header_table(staged).write.parquet(f"{staging}/headers")
        headers = spark.read.schema(HEADERS).parquet(f"{staging}/headers")
        if archives:  # unpack their blobs once, not for each table that refers to some
            blobs.write.parquet(f"{staging}/blobs")
            blobs = spark.read.schema(blobs.schema).parquet(f"{staging}/blobs")
        else:
            blobs = stage_names(blobs, f"{staging}/blobs")
        cut = {r["datatype_id"]: r["wide_rows"] for r in wide_rows(staged, headers).collect()}
        report = []
        with Commit(spark, out) as commit:
            for name, columns in columns_by_table(headers).items():
                counted = Observation(name)
                table = build_table(staged, headers, columns, spec_of_table(list(columns)), blobs)
                commit.write(table.observe(counted, F.count(F.lit(1)).alias("rows")), name)
                report.append((name, counted.get["rows"], sum(cut.get(i, 0) for i in columns)))
    finally:
        delete_folder(staging)
    if read_table(spark, out, METRICS_TABLE) is not None:
        write_metrics(spark, out, params, profiles)
    return spark.createDataFrame(report, "table_name string, row_count long, wide_rows long")
