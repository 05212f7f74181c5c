"""JSON blobs that cells refer to by file name."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitalgrid.functions.json import LOOKS_LIKE_JSON, inline_json, normalized_json
from vitalgrid.sources.export import BLOB_FOLDER, Blobs, blobs_of

ROW_KEY = ("export_dir", "file_name", "row_no")


@F.pandas_udf(T.StringType())
def blob_text(content: pd.Series) -> pd.Series:
    """Text of plain or gzip-compressed blobs; a damaged gzip gives null."""
    import gzip
    import zlib

    def text(raw: bytes) -> str | None:
        if raw is None:
            return None
        if raw[:2] == b"\x1f\x8b":
            try:
                raw = gzip.decompress(raw)
            except (OSError, EOFError, zlib.error):
                return None
        return raw.decode("utf-8", errors="replace")

    return content.map(text)


def _candidates(cell: Column) -> Column:
    """Paths a cell may mean, in the order in which they are tried."""
    text = F.trim(cell)
    base = F.concat(F.col("export_dir"), F.lit(f"/{BLOB_FOLDER}/"))
    typed = F.concat(base, F.col("datatype_id"), F.lit("/"), text)
    return F.array(
        F.when(~text.endswith(".json"), F.concat(typed, F.lit(".json"))),
        typed,
        F.concat(base, text),
    )


def attach_blobs(rows: DataFrame, column: str, blobs: Blobs | DataFrame | None) -> DataFrame:
    """Add ``<column>_json``: the cell's inline JSON or that of the first existing candidate file.

    ``rows`` has ``ROW_KEY`` and ``datatype_id``, a frame of blobs ``path, content``. Which file a cell means is settled by names alone; only
    the content of those files is then read, each once, and decoded before it meets the rows. Rows
    without a reference take no part. All joins are equi-joins that adaptive execution splits when many
    rows share one blob.
    """
    cell = F.col(column)
    inline = inline_json(cell)
    if blobs is None:
        return rows.withColumn(f"{column}_json", inline)
    if isinstance(blobs, DataFrame):
        blobs = blobs_of(blobs)
    is_reference = cell.isNotNull() & (F.trim(cell) != "") & ~cell.rlike(LOOKS_LIKE_JSON)
    references = rows.where(is_reference).select(
        *ROW_KEY, F.posexplode(_candidates(cell)).alias("priority", "path")).where("path is not null")
    best = references.join(blobs.names, "path").groupBy(*ROW_KEY).agg(
        F.min_by("path", "priority").alias("path"))
    texts = blobs.read(best.select("path").distinct()).select(
        "path", normalized_json(blob_text("content")).alias("_blob_json"))
    found = best.join(texts, "path").drop("path")
    return rows.join(found, list(ROW_KEY), "left").withColumn(
        f"{column}_json", F.when(cell.rlike(LOOKS_LIKE_JSON), inline).otherwise(F.col("_blob_json")),
    ).drop("_blob_json")
