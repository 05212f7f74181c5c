"""Record tables derived from the ``events`` test table, one projection per table.

All columns come from integers and times, so any SQL engine derives the same values.
"""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalgrid.shipping import scratch_folder, ship_package
from vitalgrid.sources.export import record_cells

#: table name -> (filter on events, select expressions besides user_id)
PROJECTIONS: dict[str, tuple[str, tuple[str, ...]]] = {
    "heart_rate": (
        "event_type = 'view'",
        ("ts as start_time", "cast(48 + event_id % 90 as double) as bpm")),
    "stress": (
        "event_type = 'click'",
        ("ts as start_time", "cast(event_id % 101 as double) as score")),
    "spo2": (
        "event_type = 'signup'",
        ("ts as start_time", "cast(90 + event_id % 10 as double) as spo2")),
    "body_composition": (
        "event_type = 'signup' and event_id % 3 = 0",
        ("ts as start_time", "70e0 + (event_id % 200) / 10e0 as weight",
         "15e0 + (event_id % 90) / 10e0 as body_fat")),
    "exercise": (
        "event_type = 'purchase'",
        ("ts as start_time",
         "cast((1200 + event_id % 3000) * 1000 as double) as duration",
         "cast(90 + event_id % 80 as double) as mean_hr",
         "cast(110 + event_id % 80 as double) as max_hr",
         "cast(1000 + event_id % 9000 as double) as distance",
         "cast(event_id % 700 as double) as calorie",
         "cast(case event_id % 8 when 0 then 1001 when 1 then 1002 when 2 then 11007"
         " when 3 then 13001 when 4 then 14001 when 5 then 15006 when 6 then 0 else 9999 end"
         " as double) as exercise_type")),
    "sleep": (
        "event_type = 'error'",
        ("ts as start_time",
         "ts + make_dt_interval(0, 0, cast(360 + event_id % 141 as int), 0) as end_time",
         "cast(55 + event_id % 38 as double) as score",
         "cast(70 + event_id % 27 as double) as efficiency")),
    "sleep_stage": (
        "true",
        ("ts as start_time",
         "ts + make_dt_interval(0, 0, cast(20 + event_id % 70 as int), 0) as end_time",
         "cast(1 + event_id % 5 as double) as stage")),
    "steps_daily": (
        "event_type in ('view', 'click')",
        ("ts as day_time", "cast(4000 + event_id % 11001 as double) as steps",
         "cast(event_id % 120 as double) as active_time")),
}


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    condition, columns = PROJECTIONS[name]
    return events(spark, sf_dir).where(condition).selectExpr("user_id", *columns)


def tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: table(spark, sf_dir, name) for name in PROJECTIONS}


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, because engines add in different orders."""
    return df.selectExpr(*[
        f"round({c}, {digits}) as {c}" if kind == "double" else c for c, kind in df.dtypes])


# ---- an export derived from the events, as the device would have written it -------------------

HEART_RATE_ID = "com.samsung.shealth.tracker.heart_rate"
SLEEP_COMBINED_ID = "com.samsung.shealth.sleep_combined"
#: the folder of a null value
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"
TIME_TEXT = "date_format(ts, 'yyyy-MM-dd HH:mm:ss.SSS')"
# without a detour through the session zone
EPOCH_MS = """(unix_date(date(ts)) * 86400000L + hour(ts) * 3600000L + minute(ts) * 60000L
    + bigint(floor(extract(second from ts) * 1000)))"""

#: record -> (metadata line, header line, filter, lines of one event in file order)
EXPORT_RECORDS = {
    "heart_rate": (
        f"{HEART_RATE_ID},7",
        ",".join(f"com.samsung.health.heart_rate.{c}" for c in (
            "start_time", "heart_rate", "comment", "binning_data")),
        "event_type = 'view'",
        # every tenth reading is reported twice, the second report corrects the first; lines end
        # with a comma too many, and comments hold commas and line breaks
        (f"""if(event_id % 10 = 0, concat({TIME_TEXT}, ',1,first,[],'), null)""",
         f"""concat({TIME_TEXT}, ',', 48 + event_id % 90, ',"a, \\n b","',
             replace(props, '"', '""'), '",', if(event_id % 40 = 0, 'a cell too many', ''))"""),
    ),
    "sleep_combined": (
        f"{SLEEP_COMBINED_ID},1",
        ",".join(f"com.samsung.health.sleep_combined.{c}" for c in (
            "start_time", "sleep_score", "efficiency", "sleep_duration")),
        "event_type = 'error'",
        # times as epoch milliseconds
        (f"""concat({EPOCH_MS}, ',', 55 + event_id % 38, ',',
            if(event_id % 7 = 0, 'NaN', string(70 + event_id % 27)), ',', 360 + event_id % 141)""",),
    ),
}


def export_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as lines of export files, one folder for each person and one file for each record type:
    ``below, file_name, position, value``."""
    lines = None
    for record, (meta, header, condition, texts) in EXPORT_RECORDS.items():
        body = events(spark, sf_dir).where(condition).select(
            "user_id", F.posexplode(F.array(*[F.expr(t) for t in texts])).alias("n", "value"),
            (F.col("event_id") * 10 + 10).alias("line")).where("value is not null")
        top = events(spark, sf_dir).where(condition).select("user_id").distinct().select(
            "user_id", F.posexplode(F.array(F.lit(meta), F.lit(header))).alias("n", "value"),
            F.lit(0).cast("long").alias("line"))
        part = top.unionByName(body).select(
            F.concat(F.lit("wear_"), F.col("user_id"), F.lit("_20240131120000")).alias("below"),
            F.lit(f"{record}.csv").alias("file_name"), (F.col("line") + F.col("n")).alias("position"), "value")
        lines = part if lines is None else lines.unionByName(part)
    return lines


def export_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """These lines split into cells as the file reader does."""
    return export_lines(spark, sf_dir).select(
        F.concat(F.lit("/exports/"), "below").alias("export_dir"), "below", "file_name", "position",
        record_cells(F.col("value")).alias("cells"))


def _write_files(batches: Iterator[pa.RecordBatch], root: str, name: str) -> Iterator[pa.RecordBatch]:
    """Write lines that lie side by side by file below a mounted folder, as Spark's text writer places them.

    A file appears when it is whole, under the same name if its task runs again."""
    now, file, done = None, None, 0

    def close() -> None:
        if file is not None:
            file.close()
            os.replace(file.name, f"{os.path.dirname(file.name)}/{name}")

    for batch in batches:
        for r in batch.to_pylist():
            if now != (r["below"], r["file_name"]):
                close()
                now, done = (r["below"], r["file_name"]), done + 1
                folder = f"{root}/export={r['below'] or NO_VALUE}/record={r['file_name']}"
                os.makedirs(folder, exist_ok=True)
                file = open(f"{folder}/.{uuid.uuid4().hex}", "wb")
            file.write(r["value"].encode("utf-8") + b"\n")
    close()
    yield pa.RecordBatch.from_pydict({"files": pa.array([done], pa.int64())})


def export_files(spark: SparkSession, sf_dir: str, persons: str = "true", root: str | None = None) -> str:
    """These lines written as files into the shared folder, which is given; or the lines of some ``persons``, beside what
    is in ``root``.

    Spark's writer takes milliseconds for each file and folder, of which there are as many as persons: where the shared folder
    is a mounted one, tasks write the files themselves.
    """
    root = root or scratch_folder(spark, "exports")
    lines = export_lines(spark, sf_dir).withColumn("user_id", F.split("below", "_")[1].cast("long")).where(persons)
    sorted_lines = lines.repartition("below", "file_name").sortWithinPartitions("below", "file_name", "position")
    mounted = re.match(r"^(?:file:(?://)?)?(/[^/].*)$", root)
    if mounted:
        folder, name = mounted[1], f"part-{uuid.uuid4().hex}.txt"
        sorted_lines.select("below", "file_name", "value").mapInArrow(
            lambda batches: _write_files(batches, folder, name), "files long").agg(F.sum("files")).collect()
    else:
        sorted_lines.select(F.col("below").alias("export"), F.col("file_name").alias("record"), "value").write.mode(
            "append").partitionBy("export", "record").text(root)
    return root
