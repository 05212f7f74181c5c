"""Data-quality profile of the record tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitalgrid.functions.clean import as_time

# Tables and columns worth checking, and the time columns in order of preference.
EXPECTED = {
    "sleep_combined": ("start_time", "end_time", "sleep_duration", "sleep_score", "efficiency"),
    "activity_day_summary": ("create_time", "start_time", "step_count", "active_time", "calorie"),
    "sleep_stage": ("start_time", "stage"),
    "weight": ("update_time", "create_time", "weight", "body_fat", "skeletal_muscle"),
    "heart_rate": ("start_time", "end_time", "heart_rate", "bpm", "max", "binning_data"),
    "exercise": ("start_time", "duration", "mean_hr", "calorie"),
    "stress": ("start_time", "create_time", "score", "max", "min", "binning_data"),
    "vitality_score": ("day_time", "total_score", "sleep_score", "max_hr"),
}
PROFILED_TIMES = ("start_time", "create_time", "update_time", "day_time", "end_time")
SAMPLES, TIME_SAMPLES = 3, 2
SAMPLE_WIDTH = 80


def profile_table(df: DataFrame, name: str, columns: Sequence[str]) -> DataFrame:
    """``table_name, column_name, n_rows, n_filled, n_times, samples, times`` per column found.

    ``n_times`` and ``times`` are set for the first time column only: how many values read as a trusted
    time, and the first of them. Samples are the first filled values in the order in which the table is
    read. Ranking keeps some rows per task before anything is shuffled.
    """
    found = [c for c in columns if c in df.columns]
    time = next((c for c in PROFILED_TIMES if c in df.columns), None)
    counted = list(dict.fromkeys([*found, *([time] if time else [])]))
    if not counted:
        return df.sparkSession.createDataFrame([], PROFILE_SCHEMA)

    cells = F.explode(F.array(*[
        F.struct(
            F.lit(c).alias("column_name"),
            F.col(c).cast("string").alias("text"),
            (as_time(df, c) if c == time else F.lit(None).cast("timestamp_ntz")).alias("time"),
        ) for c in counted]))
    long = df.withColumn("_at", F.monotonically_increasing_id()).select("_at", cells.alias("c")).select("_at", "c.*")
    counts = long.groupBy("column_name").agg(
        F.count("*").alias("n_rows"), F.count("text").alias("n_filled"),
        F.when(F.col("column_name") == (time or ""), F.count("time")).alias("n_times"))
    short = F.when(F.length("text") > SAMPLE_WIDTH,
                   F.concat(F.left("text", F.lit(SAMPLE_WIDTH)), F.lit("…"))).otherwise(F.col("text"))

    def first(filled: str, shown: Column, n: int, alias: str) -> DataFrame:
        in_order = Window.partitionBy("column_name").orderBy("_at")
        ranked = long.where(F.col(filled).isNotNull()).select("column_name", "_at", shown.alias("shown")) \
            .withColumn("rank", F.row_number().over(in_order)).where(F.col("rank") <= n)
        listed = ranked.groupBy("column_name").agg(F.sort_array(F.collect_list(F.struct("_at", "shown"))).alias("s"))
        return listed.select("column_name", F.col("s.shown").alias(alias))

    none = F.array().cast("array<string>")
    times = first("time", F.date_format("time", "yyyy-MM-dd HH:mm:ss"), TIME_SAMPLES, "times")
    return counts.join(first("text", short, SAMPLES, "samples"), "column_name", "left").join(
        times, "column_name", "left").select(
        F.lit(name).alias("table_name"), "column_name", "n_rows", "n_filled", "n_times",
        F.coalesce("samples", none).alias("samples"), F.coalesce("times", none).alias("times"))


PROFILE_SCHEMA = (
    "table_name string, column_name string, n_rows long, n_filled long, n_times long, "
    "samples array<string>, times array<string>")


def profile(tables: dict[str, DataFrame]) -> DataFrame:
    """Profile of every expected table that is there."""
    result = None
    for name, columns in EXPECTED.items():
        if name in tables:
            part = profile_table(tables[name], name, columns)
            result = part if result is None else result.unionAll(part)
    if result is None:
        raise ValueError("none of the expected tables is there")
    return result
