"""

The test tables hold no wearable records, so every query starts from the projections of ``events``
in :mod:`vitalgrid.bindings`.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable
from importlib.util import find_spec

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from oracle import oracle_sql as _oracle_sql  # noqa: E402
from vitalgrid import bindings as b  # noqa: E402
from vitalgrid.functions import clean, codes, display  # noqa: E402
from vitalgrid.functions.json import inline_json  # noqa: E402
from vitalgrid.functions.names import header_names  # noqa: E402
from vitalgrid.operators import daily, dedup, load, timeline  # noqa: E402
from vitalgrid.plans import ingest, profile, queries as q, refresh  # noqa: E402
from vitalgrid.plans.metrics import build_daily_metrics, daily_frame, load_range  # noqa: E402
from vitalgrid.shipping import scratch_folder  # noqa: E402
from vitalgrid.sources import export, tables as stored  # noqa: E402
from vitalgrid.sources.blobs import attach_blobs  # noqa: E402

# the corpus operators are an add-on: without their files everything else still works; other errors show
if find_spec("vitalgrid.llm") and find_spec("vitalgrid.llm.queries") and find_spec("corpus_pipeline"):
    import corpus_pipeline
    from vitalgrid.llm import oracle as corpus_oracle, queries as corpus_queries
else:
    corpus_pipeline = corpus_oracle = corpus_queries = None

Query = Callable[[SparkSession, str], DataFrame]


def entry(spark: SparkSession) -> DataFrame:
    """Daily metrics of all persons, from raw records to the readiness score."""
    return queries()["readiness_daily"](spark, "/root/testdata/sf0.001")


def _metrics(spark: SparkSession, sf: str) -> DataFrame:
    return build_daily_metrics(b.tables(spark, sf))


def _dense(spark: SparkSession, sf: str) -> DataFrame:
    return daily_frame(b.tables(spark, sf))


# ---- one function per query that is more than one call -----------------------------------------

def resting_median(spark, sf):
    medians = load.resting_median(daily.daily_resting_hr(b.table(spark, sf, "heart_rate")))
    return b.rounded(medians.select("user_id", F.col("_median_hr").alias("hr_rest")))


def daily_load(spark, sf):
    medians = load.resting_median(daily.daily_resting_hr(b.table(spark, sf, "heart_rate")))
    return b.rounded(load.daily_load(b.table(spark, sf, "exercise"), medians))


def readiness_profiles(spark, sf):
    """Load under per-person profiles: sex, maximum and, for some, resting heart rate."""
    profiles = b.events(spark, sf).select("user_id").distinct().select(
        "user_id",
        F.when(F.col("user_id") % 3 == 0, "female").otherwise("male").alias("sex"),
        (180 + F.col("user_id") % 20).cast("double").alias("hr_max"),
        F.when(F.col("user_id") % 2 == 0, (50 + F.col("user_id") % 10).cast("double")).alias("hr_rest"))
    medians = load.resting_median(daily.daily_resting_hr(b.table(spark, sf, "heart_rate")))
    return b.rounded(load.daily_load(b.table(spark, sf, "exercise"), medians, profiles=profiles))


def acwr(spark, sf):
    return b.rounded(timeline.load_balance(_dense(spark, sf)).select(
        "user_id", "day", "load", "load_acute", "load_chronic", "acwr"))


def sleep_debt(spark, sf):
    debt = timeline.sleep_debt(F.col("sleep_minutes"), F.lit(480.0))
    return b.rounded(_dense(spark, sf).select("user_id", "day", debt.alias("sleep_debt")))


def sleep_regularity(spark, sf):
    regularity = timeline.sleep_regularity(F.col("sleep_midpoint"))
    return b.rounded(_dense(spark, sf).select("user_id", "day", regularity.alias("sleep_regularity")))


def rhr_baseline(spark, sf):
    return b.rounded(timeline.resting_baseline(_dense(spark, sf)).select("user_id", "day", "rhr_baseline"))


def weight_trend(spark, sf):
    return b.rounded(timeline.weight_trend(_dense(spark, sf)).select(
        "user_id", "day", "weight_ffill", "weight_delta_7d", "weight_delta_30d"))


def summary_components(spark, sf):
    return b.rounded(q.summary(_metrics(spark, sf)).select("user_id", "as_of", "readiness", "components.*"))


def summary_cards(spark, sf):
    """The KPIs of the summary in their order, over all days."""
    cards = q.summary(_metrics(spark, sf), "all").select("user_id", F.posexplode("kpis").alias("pos", "k"))
    return b.rounded(cards.select("user_id", "pos", "k.key", "k.label", "k.unit", "k.better", "k.value", "k.delta"))


def summary_spark(spark, sf):
    """The points of each KPI's sparkline, oldest first."""
    return q.summary_kpis(_metrics(spark, sf)).select("user_id", "key", F.posexplode("spark").alias("pos", "v"))


def _workouts(spark, sf, *range_name):
    listed = q.workouts(b.table(spark, sf, "exercise"),
                        daily.daily_resting_hr(b.table(spark, sf, "heart_rate")), *range_name)
    whole = {c: F.col(c).cast("long") for c in ("mean_hr", "max_hr")}
    return listed.withColumns(whole).withColumn(
        "start_time", F.date_format("start_time", "yyyy-MM-dd HH:mm:ss.SSSSSS"))


def workouts(spark, sf):
    return _workouts(spark, sf)


def workouts_week(spark, sf):
    return _workouts(spark, sf, "7d")


def workout_spans(spark, sf):
    """Persons without any duration: minutes from start to end. The heart rate is under its other name."""
    rows = b.table(spark, sf, "exercise").selectExpr(
        "user_id", "start_time", "start_time + make_dt_interval(0, 0, 0, duration / 1000) as end_time",
        "if(user_id % 2 = 0, duration, null) as duration", "mean_hr as mean_heart_rate")
    medians = load.resting_median(daily.daily_resting_hr(b.table(spark, sf, "heart_rate")))
    return b.rounded(load.daily_load(rows, medians))


def load_outside_days(spark, sf):
    """Workouts on days before and after all other records add no day."""
    tables = {n: b.table(spark, sf, n) for n in ("heart_rate", "exercise")}
    inner = tables["heart_rate"].where("day(start_time) between 5 and 20")
    dense = daily_frame({"heart_rate": inner, "exercise": tables["exercise"]})
    return b.rounded(dense.select("user_id", "day", F.coalesce("load", F.lit(0.0)).alias("load")))


def sleep_without_scores(spark, sf):
    """Sleep score from minutes for persons that have no score at all."""
    tables = b.tables(spark, sf)
    tables["sleep"] = tables["sleep"].withColumn("score", F.when(F.col("user_id") % 2 == 0, F.col("score")))
    return b.rounded(build_daily_metrics(tables).select("user_id", "day", "sleep_minutes", "sleep_score", "sleep_score_c"))


def time_choice(spark, sf):
    """Persons with two time columns use the preferred one for all rows."""
    return b.rounded(daily.daily_stress(b.events(spark, sf).where("event_type = 'click'").selectExpr(
        "user_id", "if(user_id % 2 = 0 and event_id % 3 = 0, ts, null) as start_time",
        "ts + interval 1 day as create_time", "double(event_id % 101) as score")))


def column_names(spark, sf):
    """Headers of any number of files: short names, repeats told apart."""
    header = F.split(F.expr("""case event_id % 3
        when 0 then concat('a.b.start_time,a.time,c.d.Value,x.value,p', event_id % 50, '.id, ,')
        when 1 then 'stage,Stage, a.stage ,user_id,export_ts,STAGE' else 'time,,value,z' end"""), ",")
    names = header_names(header)
    return b.events(spark, sf).select("event_id", F.posexplode(names).alias("pos", "name"))


def missing_table(spark, sf):
    """A table that is not stored reads as an empty one of the given schema."""
    absent = stored.read_table(spark, f"{sf}/nothing", "exercise", "user_id long, start_time timestamp_ntz")
    seen = b.events(spark, sf).groupBy("user_id").agg(F.count("*").alias("n_events"))
    return seen.join(absent.groupBy("user_id").agg(F.count("*").alias("n")), "user_id", "left").select(
        "user_id", "n_events", F.coalesce("n", F.lit(0)).alias("n_workouts"))


def correlations(spark, sf):
    return b.rounded(q.correlation_matrix(_metrics(spark, sf), "90d", digits=None))


def correlations_shown(spark, sf):
    return q.correlation_matrix(_metrics(spark, sf), "all")


def goals(spark, sf):
    return b.rounded(q.goal_values(_metrics(spark, sf)))


def goals_shown(spark, sf):
    return q.goals(_metrics(spark, sf))


def dashboard_bands(spark, sf):
    return _metrics(spark, sf).select(
        "user_id", "day", display.status_band(F.col("readiness")).alias("status"),
        display.acwr_band(F.col("acwr")).alias("acwr_band"),
        display.duration_text(F.col("sleep_minutes")).alias("slept"))


def kpi_direction(spark, sf):
    days = Window.partitionBy("user_id").orderBy("day")
    return _metrics(spark, sf).select("user_id", "day", *[
        display.kpi_direction(F.col(c) - F.lag(c).over(days), F.lit(better)).alias(c)
        for c, better in (("resting_hr", "lower"), ("steps", "higher"), ("load", "neutral"))])


def clean_times(spark, sf):
    """Times as text in every form an export uses, and junk."""
    text = F.expr(f"""case event_id % 8
        when 1 then string({b.EPOCH_MS})
        when 2 then concat('  ', date_format(ts, 'yyyy-MM-dd HH:mm:ss.SSS'), ' ')
        when 3 then '1001-01-01 00:00:00' when 4 then 'junk' when 5 then '99999999999999999'
        when 6 then date_format(ts, 'yyyyMMdd') when 7 then null
        else date_format(ts, 'yyyy-MM-dd HH:mm:ss.SSS') end""")
    parsed = b.events(spark, sf).select("event_id", clean.parse_time(text).alias("t"))
    return parsed.select(
        "event_id", F.date_format("t", "yyyy-MM-dd HH:mm:ss.SSS").alias("parsed"),
        clean.calendar_day(F.col("t")).alias("day"), clean.wake_day(F.col("t")).alias("wake_day"))


def clean_numbers(spark, sf):
    text = F.expr("""case event_id % 9 when 3 then concat(event_id, 'd') when 4 then 'inf'
        when 5 then 'NaN' when 6 then '' when 7 then concat(event_id, 'e3')
        when 8 then concat(' +', event_id, '.5 ') else concat(event_id, '.5') end""")
    return b.events(spark, sf).select("event_id", clean.parse_number(text).alias("parsed"))


def stage_names(spark, sf):
    code = F.expr("""cast(case event_id % 7 when 0 then null when 1 then 40001 when 2 then 2
        when 3 then 3 when 4 then 40004 when 5 then 9 else 4 end as double)""")
    return b.events(spark, sf).select("event_id", codes.stage_name(code).alias("stage"))


def keep_last_dedup(spark, sf):
    rows = b.events(spark, sf).withColumn("day", F.to_date("ts"))
    kept = dedup.keep_last(rows, ["user_id", "day"], ["event_id"])
    return kept.select("user_id", "day", "event_id", "value", "event_type")


def keep_last_null_key(spark, sf):
    """A third of all rows share the null key of their person."""
    rows = b.events(spark, sf).select(
        "user_id", F.when(F.col("event_id") % 3 > 0, F.to_date("ts")).alias("day"), "event_id")
    return dedup.keep_last(rows, ["user_id", "day"], ["event_id"])


def union_by_name(spark, sf):
    events = b.events(spark, sf)
    return dedup.union_by_name([
        events.where("event_type = 'click'").selectExpr(
            "user_id", "event_id", "double(event_id % 101) as score"),
        events.where("event_type = 'signup'").selectExpr(
            "user_id", "event_id", "double(90 + event_id % 10) as spo2"),
    ])


def first_filled_table(spark, sf):
    events = b.events(spark, sf).select("user_id", "event_id", "value", "event_type")
    preferred = events.where("event_type = 'click' and user_id % 3 = 0").drop("event_type")
    fallback = events.where("event_type = 'view'").drop("event_type")
    return dedup.first_filled_table([preferred, fallback])


def candidate_choice(spark, sf):
    """Persons with a ``steps`` value anywhere use that column, the others ``step_count``."""
    return daily.daily_steps(b.events(spark, sf).selectExpr(
        "user_id", "ts as day_time",
        "if(user_id % 2 = 0 and event_id % 4 = 0, double(event_id % 5000), null) as steps",
        "double(event_id % 7000) as step_count"))


def person_tables(spark, sf):
    """Persons with rows in the preferred table use only that one."""
    events = b.events(spark, sf)
    return daily.daily_steps(
        events.where("event_type = 'click' and user_id % 3 = 0").selectExpr(
            "user_id", "ts as create_time", "double(event_id % 5000) as step_count"),
        events.where("event_type = 'view'").selectExpr(
            "user_id", "ts as day_time", "double(event_id % 7000) as steps"))


def json_decode(spark, sf):
    cell = F.expr("""case event_id % 5 when 1 then '[{a:1}]' when 2 then 'file.json'
        when 3 then concat('  ', props) else props end""")
    return b.events(spark, sf).select("event_id", inline_json(cell).alias("json"))


def table_listing(spark, sf):
    """Every seventh person's rows are owned by nobody."""
    tables = {n: t.withColumn("user_id", F.when(F.col("user_id") % 7 > 0, F.col("user_id"))) for n, t in b.tables(spark, sf).items()}
    return stored.table_listing(tables).withColumn("columns", F.array_join("columns", ","))


def profile_counts(spark, sf):
    listed = profile.profile(b.tables(spark, sf))
    return listed.withColumns({c: F.array_join(c, "|") for c in ("samples", "times")})


def blob_lookup(spark, sf):
    """Cells that name files: candidates in their order, bad JSON, missing files, inline JSON."""
    rows = b.events(spark, sf).selectExpr(
        "user_id", "event_id", "concat('/e/', user_id) as export_dir", "'f.csv' as file_name", "event_id as row_no",
        "'t' as datatype_id",
        """case event_id % 6 when 0 then concat('b', user_id) when 1 then concat('b', user_id, '.json')
            when 2 then concat('r', user_id) when 3 then concat('bad', user_id) when 4 then 'absent'
            else props end as cell""")
    texts = (("concat('t/b', user_id, '.json')", """concat('{"k": 1, "u": ', user_id, '}')"""),
             ("concat('t/b', user_id)", """'{"k": 2}'"""), ("concat('r', user_id)", """'{"k": 3}'"""),
             ("concat('t/bad', user_id, '.json')", "'[{'"), ("concat('bad', user_id)", """'{"never": 1}'"""))
    files = F.array(*[F.struct(F.expr(n).alias("name"), F.expr(t).alias("text")) for n, t in texts])
    blobs = b.events(spark, sf).select("user_id").distinct().select("user_id", F.explode(files).alias("f")).select(
        F.concat(F.lit("/e/"), "user_id", F.lit("/jsons/"), "f.name").alias("path"),
        F.col("f.text").cast("binary").alias("content"))
    return attach_blobs(rows, "cell", blobs).select("event_id", "cell_json")


def _described(spark: SparkSession, sf: str) -> DataFrame:
    """What ingest works on, from the events as records of export files; nothing is written."""
    return export.describe_rows(b.export_cells(spark, sf))


def _ingested_table(spark, sf, name):
    described = _described(spark, sf)
    headers = ingest.header_table(described).persist()
    columns = ingest.columns_by_table(headers)[name]
    table = ingest.build_table(described, headers, columns, ingest.spec_of_table(list(columns)), None)
    return table.withColumn("user_id", F.col("user_id").cast("long"))


def ingest_heart_rate(spark, sf):
    """Records to the typed table: quoted line breaks, corrections, inline JSON."""
    return _ingested_table(spark, sf, "heart_rate").select(
        "user_id", F.date_format("start_time", "yyyy-MM-dd HH:mm:ss.SSS").alias("start_time"),
        "bpm", "comment", "binning_data_json")


def ingest_sleep_nights(spark, sf):
    """An unregistered table, all text with epoch times, aggregated per night."""
    nights = daily.nightly_sleep(_ingested_table(spark, sf, "sleep_combined"))
    # means of whole milliseconds of an hour lie on the edge of rounding to six digits
    return b.rounded(nights, 9)


def ingest_report(spark, sf):
    described = _described(spark, sf)
    headers = ingest.header_table(described).persist()
    cut = ingest.wide_rows(described, headers)
    report = None
    for name, columns in ingest.columns_by_table(headers).items():
        ids = list(columns)
        rows = ingest.build_table(described, headers, columns, ingest.spec_of_table(ids), None).agg(
            F.count("*").alias("row_count"))
        wide = cut.where(F.col("datatype_id").isin(ids)).agg(
            F.coalesce(F.sum("wide_rows"), F.lit(0)).alias("wide_rows"))
        part = rows.join(wide).select(F.lit(name).alias("table_name"), "row_count", "wide_rows")
        report = part if report is None else report.unionAll(part)
    return report


def _files(spark, sf):
    return export.read_export_rows(spark, b.export_files(spark, sf), "*.txt")


def ingest_files(spark, sf):
    """Rows and cells that the reader finds in files, by file and kind of row."""
    return _files(spark, sf).groupBy("user_id", "export_ts", "datatype_id", "version", "part").agg(
        F.count("*").alias("n_rows"), F.sum(F.size("cells")).alias("n_cells"),
        F.sum(F.expr("length(array_join(cells, '|', '-'))")).alias("n_letters"))


def ingest_long_cells(spark, sf):
    """Cells as long as all properties of a person together, quoted, with doubled quotes and line breaks."""
    rows = b.events(spark, sf).groupBy("user_id").agg(F.sort_array(F.collect_list(F.struct("event_id", "props"))).alias("all"))
    text = F.array_join(F.transform("all", lambda e: e["props"]), ",\n")
    record = F.concat(F.col("user_id").cast("string"), F.lit(',"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('",end,'))
    return rows.select("user_id", F.explode(export.record_cells(record)).alias("cell"))


def ingest_run(spark, sf):
    """The whole ingest, from files to committed tables: its report, and what the tables then hold."""
    out = scratch_folder(spark, "tables")
    report = ingest.ingest(spark, b.export_files(spark, sf), out, files="*.txt")
    stored_rows = stored.table_listing(stored.read_tables(spark, out)).select(
        "table_name", F.col("n_rows").alias("stored_rows"), F.array_join("columns", ",").alias("columns"))
    return report.join(stored_rows, "table_name")


def ingest_refresh(spark, sf):
    """Tables after the last third of the persons has come: how many persons it read, and what the tables then hold."""
    out = scratch_folder(spark, "tables")
    root = b.export_files(spark, sf, "user_id % 3 > 0")
    refresh.refresh(spark, root, out, files="*.txt", buckets=8)
    report = refresh.refresh(spark, b.export_files(spark, sf, "user_id % 3 = 0", root), out, files="*.txt")
    found = stored.read_tables(spark, out)
    listing = stored.table_listing(found).select("table_name", "n_rows", F.array_join("columns", ",").alias("columns"))
    readings = found["heart_rate"].agg(F.sum("bpm").alias("bpm"), F.count_distinct("user_id").alias("owners")) \
        .withColumn("table_name", F.lit("heart_rate"))
    return report.select("table_name", "persons").join(listing, "table_name").join(readings, "table_name", "left")


def range_of_stored_metrics(spark, sf):
    """Metrics stored by month, of which a range reads what it needs."""
    out = scratch_folder(spark, "metrics")
    with stored.Commit(spark, out) as commit:
        for name, table in b.tables(spark, sf).items():
            commit.write(table, name)
    return load_range(spark, out, "7d").selectExpr(
        "user_id", "day", "round(resting_hr, 6) as resting_hr", "steps")


def ingest_persons(spark, sf):
    """Persons and export times from the folder names, one row for each person and record type."""
    described = _described(spark, sf).where("part = 'data'")
    return described.groupBy("user_id", "export_ts", "datatype_id", "version").agg(F.count("*").alias("n_rows"))


def queries() -> dict[str, Query]:
    def of(make, *names: str) -> Query:
        return lambda spark, sf: b.rounded(make(*[b.table(spark, sf, n) for n in names]))

    def over(read, *args) -> Query:
        return lambda spark, sf: b.rounded(read(_metrics(spark, sf), *args))

    corpus = {} if corpus_queries is None else corpus_queries.queries() | {"pipeline": corpus_pipeline.run}
    return corpus | {
        "readiness_daily": lambda spark, sf: b.rounded(_metrics(spark, sf)),
        "daily_resting_hr": of(daily.daily_resting_hr, "heart_rate"),
        "daily_steps": of(daily.daily_steps, "steps_daily"),
        "daily_stress": of(daily.daily_stress, "stress"),
        "daily_spo2": of(daily.daily_spo2, "spo2"),
        "body_series": of(daily.body_series, "body_composition"),
        "nightly_sleep": of(daily.nightly_sleep, "sleep"),
        "nightly_stages": of(daily.nightly_stages, "sleep_stage"),
        "dense_grid": lambda spark, sf: b.rounded(
            _dense(spark, sf).select("user_id", "day", "resting_hr", "steps")),
        "resting_median": resting_median,
        "daily_load": daily_load,
        "readiness_profiles": readiness_profiles,
        "acwr": acwr,
        "sleep_debt": sleep_debt,
        "sleep_regularity": sleep_regularity,
        "rhr_baseline": rhr_baseline,
        "weight_trend": weight_trend,
        "readiness_scores": lambda spark, sf: b.rounded(_metrics(spark, sf).select(
            "user_id", "day", "rhr_score", "sleep_score_c", "stress_score", "acwr_score", "readiness")),
        "summary_kpis": lambda spark, sf: b.rounded(q.summary_kpis(_metrics(spark, sf)).select(
            "user_id", "as_of", "key", "label", "unit", "better", "value", "delta")),
        "summary_components": summary_components,
        "summary_cards": summary_cards,
        "summary_spark": summary_spark,
        "kpi_points": lambda spark, sf: b.rounded(
            q.kpi_points(_metrics(spark, sf)).select("user_id", "key", "pos", "day", "v")),
        "timeseries": over(q.timeseries, "30d"),
        "timeseries_all": over(q.timeseries, "all"),
        "metrics_tail": lambda spark, sf: q.last_days(_metrics(spark, sf), 7),
        "workouts": workouts,
        "workouts_week": workouts_week,
        "workout_spans": workout_spans,
        "load_outside_days": load_outside_days,
        "sleep_without_scores": sleep_without_scores,
        "time_choice": time_choice,
        "column_names": column_names,
        "missing_table": missing_table,
        "correlations": correlations,
        "sleep_next_day": lambda spark, sf: q.sleep_next_day(_metrics(spark, sf), "90d"),
        "correlations_shown": correlations_shown,
        "goals": goals,
        "goals_shown": goals_shown,
        "steps_streak": lambda spark, sf: q.steps_streak(_metrics(spark, sf)),
        "dashboard_bands": dashboard_bands,
        "kpi_direction": kpi_direction,
        "clean_times": clean_times,
        "clean_numbers": clean_numbers,
        "stage_names": stage_names,
        "keep_last_dedup": keep_last_dedup,
        "keep_last_null_key": keep_last_null_key,
        "union_by_name": union_by_name,
        "first_filled_table": first_filled_table,
        "candidate_choice": candidate_choice,
        "person_tables": person_tables,
        "json_decode": json_decode,
        "table_listing": table_listing,
        "profile": profile_counts,
        "blob_lookup": blob_lookup,
        "ingest_heart_rate": ingest_heart_rate,
        "ingest_sleep_nights": ingest_sleep_nights,
        "ingest_report": ingest_report,
        "ingest_persons": ingest_persons,
        "ingest_files": ingest_files,
        "ingest_long_cells": ingest_long_cells,
        "ingest_run": ingest_run,
        "ingest_refresh": ingest_refresh,
        "range_of_stored_metrics": range_of_stored_metrics,
    }


def oracle_sql() -> dict[str, str]:
    return _oracle_sql() | ({} if corpus_oracle is None else corpus_oracle.oracle_sql())
