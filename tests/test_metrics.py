"""Load, rolling windows, scores, the metrics table and the read queries."""

from __future__ import annotations

import math
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from vitalgrid import MetricParams, build_daily_metrics
from vitalgrid.operators import load, timeline
from vitalgrid.plans import queries as q
from vitalgrid.plans.metrics import METRIC_COLUMNS

START = date(2024, 1, 1)


def day(i):
    return START + timedelta(days=i)


def noon(i, hour=12):
    return datetime(2024, 1, 1, hour) + timedelta(days=i)


def daily(spark, schema, values, user=1):
    return spark.createDataFrame([(user, day(i), *v) for i, v in enumerate(values)], f"user_id int, day date, {schema}")


def column(df, name):
    return [r[name] for r in df.orderBy("user_id", "day").collect()]


def trimp(spark, hr, minutes, rest, top, sex="male"):
    df = spark.createDataFrame([(hr, minutes)], "hr double, minutes double")
    return df.select(load.trimp(F.col("hr"), F.col("minutes"), F.lit(rest), F.lit(top), F.lit(sex))).first()[0]


def test_trimp(spark):
    h = 90 / 130
    assert trimp(spark, 150.0, 30.0, 60.0, 190.0) == pytest.approx(30 * h * 0.64 * math.exp(1.92 * h))
    assert trimp(spark, 150.0, 30.0, 60.0, 190.0, "female") == pytest.approx(30 * h * 0.86 * math.exp(1.67 * h))
    assert trimp(spark, 150.0, 30.0, 60.0, 190.0, "other") == trimp(spark, 150.0, 30.0, 60.0, 190.0)
    assert trimp(spark, None, 30.0, 60.0, 190.0) == 0.0
    assert trimp(spark, 150.0, 0.0, 60.0, 190.0) == 0.0
    assert trimp(spark, 150.0, 30.0, 190.0, 190.0) == 0.0
    assert trimp(spark, 50.0, 30.0, 60.0, 190.0) == 0.0
    assert trimp(spark, 170.0, 30.0, 60.0, 190.0) > trimp(spark, 120.0, 30.0, 60.0, 190.0) > 0


def test_daily_load(spark, rows):
    schema = "user_id int, start_time timestamp_ntz, end_time timestamp_ntz, duration double, mean_hr double"
    workouts = [
        (1, noon(0, 17), noon(0, 18), 1800000.0, 150.0), (1, noon(0, 19), noon(0, 20), 1800000.0, 140.0),
        (1, noon(1, 17), noon(1, 18), 3600000.0, 160.0), (1, noon(2, 17), noon(2, 18), None, 160.0),
        (2, noon(0, 17), noon(0, 18), None, 150.0)]
    got = rows(load.daily_load(spark.createDataFrame(workouts, schema)), "user_id", "day")
    by = {(r["user_id"], r["day"]): r["load"] for r in got}
    assert by[1, day(0)] == pytest.approx(
        trimp(spark, 150.0, 30.0, 60.0, 190.0) + trimp(spark, 140.0, 30.0, 60.0, 190.0))
    assert by[1, day(1)] > 0
    # person 1 has durations, so the workout without one counts nothing; person 2 uses the span
    assert by[1, day(2)] == 0.0
    assert by[2, day(0)] == pytest.approx(trimp(spark, 150.0, 60.0, 60.0, 190.0))


def test_steady_load_is_balanced(spark):
    got = timeline.load_balance(daily(spark, "load double", [(50.0,)] * 40))
    assert column(got, "acwr")[-1] == pytest.approx(1.0)
    none = timeline.load_balance(daily(spark, "load double", [(None,)] * 3))
    assert column(none, "acwr") == [None] * 3 and column(none, "load") == [0.0] * 3


def test_sleep_debt(spark):
    df = daily(spark, "m double", [(420.0,)] * 3 + [(None,)] + [(420.0,)] * 2)
    got = column(df.withColumn("d", timeline.sleep_debt(F.col("m"), F.lit(480.0))), "d")
    assert got == [60.0, 120.0, 180.0, 180.0, 240.0, 300.0]


def test_regularity_needs_three_nights(spark):
    df = daily(spark, "m double", [(1.0,), (2.0,), (None,), (3.0,)])
    assert column(df.withColumn("d", timeline.sleep_regularity(F.col("m"))), "d") == [None, None, None, 1.0]


def test_baseline_fills_backwards(spark):
    df = daily(spark, "resting_hr double", [(60.0,), (None,), (62.0,), (70.0,), (None,)])
    assert column(timeline.resting_baseline(df), "rhr_baseline") == [62.0] * 5
    two = daily(spark, "resting_hr double", [(60.0,), (61.0,)])
    assert column(timeline.resting_baseline(two), "rhr_baseline") == [None, None]


def test_weight_trend(spark):
    df = daily(spark, "weight double", [(80.0,)] + [(None,)] * 6 + [(78.0,)] + [(None,)] * 23)
    got = timeline.weight_trend(df)
    assert column(got, "weight_ffill")[:8] == [80.0] * 7 + [78.0]
    delta = column(got, "weight_delta_7d")
    assert delta[6] is None and delta[7:9] == [-2.0, -2.0] and delta[14] == 0.0
    assert column(got, "weight_delta_30d")[29:] == [None, -2.0]


def test_dense_days(spark, rows):
    df = spark.createDataFrame(
        [(1, day(0), 1.0, True), (1, day(3), 2.0, True), (1, day(4), 9.0, None), (2, day(1), 3.0, True),
         (3, day(0), 4.0, None)], "user_id int, day date, v double, real boolean")
    got = rows(timeline.dense_days(df, F.col("real")).drop("real"), "user_id", "day")
    assert [(r["user_id"], r["day"], r["v"]) for r in got] == [
        (1, day(0), 1.0), (1, day(1), None), (1, day(2), None), (1, day(3), 2.0), (2, day(1), 3.0)]


def test_scores(spark):
    df = daily(spark, "a double", [(None,), (0.8,), (1.3,), (0.6,), (1.8,), (5.0,), (0.0,)])
    got = column(df.withColumn("s", timeline.acwr_score(F.col("a"))), "s")
    assert got[0] is None and got[1:] == pytest.approx([100.0, 100.0, 50.0, 40.0, 0.0, 0.0])


# ---- the whole table -------------------------------------------------------------------------

def person(spark, user, days=40, workouts=True, score=True, stress=True, heart=None):
    def frame(schema, values):
        return spark.createDataFrame([(user, *v) for v in values], f"user_id int, {schema}")
    heart = days if heart is None else heart
    n = range(days)
    tables = {
        "heart_rate": frame("start_time timestamp_ntz, end_time timestamp_ntz, bpm double",
                            [(noon(i, 7), noon(i, 8), 55.0 + (i * 7 + user) % 9) for i in range(heart)]),
        "sleep": frame("start_time timestamp_ntz, end_time timestamp_ntz, score double, sleep_duration double",
                       [(noon(i, 0), noon(i, 7), 60.0 + (i + user) % 30 if score else None, 400.0 + i % 50) for i in n]),
        "exercise": frame("start_time timestamp_ntz, duration double, mean_hr double, exercise_type double, distance double",
                          [(noon(i, 17), 2400000.0, 130.0 + i % 20, 1002.0, 5000.0) for i in n if i % 2 and workouts]),
        "steps_daily": frame("day_time timestamp_ntz, steps double", [(noon(i, 0), 9000.0 + i * 100) for i in n]),
    }
    if stress:
        tables["stress"] = frame("start_time timestamp_ntz, score double", [(noon(i), 30.0 + i % 20) for i in n])
    return tables


def both(a, b):
    return {k: a[k].unionByName(b[k], True) if k in a and k in b else a.get(k, b.get(k)) for k in {**a, **b}}


@pytest.fixture(scope="module")
def metrics(spark):
    return build_daily_metrics(person(spark, 1)).cache()


def test_schema_and_range(metrics):
    assert metrics.columns == ["user_id", "day", *METRIC_COLUMNS]
    assert metrics.count() == 40
    values = [r for r in column(metrics, "readiness") if r is not None]
    assert values and all(0 <= v <= 100 for v in values)


def test_columns_of_missing_tables_are_null(metrics):
    assert metrics.where("weight is not null or spo2_min is not null or deep_pct is not null").count() == 0


def test_persons_do_not_influence_each_other(spark, metrics):
    other = person(spark, 2, days=25, workouts=False, score=False, stress=False, heart=2)
    together = build_daily_metrics(both(person(spark, 1), other)).cache()
    assert sorted(together.where("user_id = 1").collect()) == sorted(metrics.collect())
    two = together.where("user_id = 2")
    # two heart-rate days: no baseline, but the component is present, so readiness is null
    assert set(column(two, "rhr_baseline")) == {None} and set(column(two, "readiness")) == {None}
    # no sleep score anywhere: the share of the target counts; no workouts: no ratio
    assert column(two, "sleep_score_c")[0] == pytest.approx(400 / 480 * 100)
    assert set(column(two, "acwr")) == {None} and set(column(two, "load")) == {0.0}


def test_weights_of_absent_components_are_shared_out(spark):
    tables = person(spark, 1, workouts=False, stress=False)
    del tables["heart_rate"]
    got = build_daily_metrics(tables)
    assert column(got, "readiness") == pytest.approx(column(got, "sleep_score_c"))


def test_parameters_and_profiles(spark, metrics):
    given = build_daily_metrics(person(spark, 1), MetricParams(sex="female", hr_max=180.0, hr_rest=50.0, target_sleep_min=500.0))
    profile = spark.createDataFrame([(1, "female", 180.0, 50.0, 500.0), (9, None, None, None, None)],
                                    "user_id int, sex string, hr_max double, hr_rest double, target_sleep_min double")
    own = build_daily_metrics(person(spark, 1), profiles=profile)
    assert sorted(given.collect()) == sorted(own.collect())
    assert column(given, "load") != column(metrics, "load")
    assert column(given, "sleep_debt")[0] == 100.0


def test_no_daily_table(spark):
    got = build_daily_metrics({"exercise": person(spark, 1)["exercise"]})
    assert got.columns == ["user_id", "day", *METRIC_COLUMNS] and got.count() == 0


def test_empty_tables(spark):
    empty = {k: v.where("false") for k, v in person(spark, 1).items()}
    assert build_daily_metrics(empty).count() == 0


# ---- read queries ----------------------------------------------------------------------------

def test_ranges(metrics):
    assert q.timeseries(metrics, "7d").count() == 7
    assert q.timeseries(metrics, "all").count() == 40
    assert len(q.timeseries(metrics, "7d").columns) == 23
    for query in (q.timeseries, q.summary, q.correlation_matrix):
        with pytest.raises(ValueError):
            query(metrics, "bogus")


def test_summary(metrics):
    row = q.summary(metrics, "30d").first()
    assert row["as_of"] == day(39) and 0 <= row["readiness"] <= 100
    assert [k["key"] for k in row["kpis"]] == [
        "resting_hr", "sleep_minutes", "steps", "load", "stress_avg", "readiness"]
    steps = row["kpis"][2]
    assert steps["value"] == 12900.0 and steps["delta"] == 700.0
    assert steps["spark"] == [9000.0 + i * 100 for i in range(26, 40)]
    assert (steps["label"], steps["better"]) == ("Kroky", "higher")


def test_kpi_delta_with_few_or_no_values(spark, rows):
    schema = ", ".join(f"{c} double" for c in METRIC_COLUMNS)
    def values(i):
        return tuple(float(i + 1) if c == "steps" else (5.0 if c == "load" and i == 0 else None) for c in METRIC_COLUMNS)
    few = daily(spark, schema, [values(i) for i in range(3)])
    kpis = {r["key"]: r for r in rows(q.summary_kpis(few, "all"))}
    assert kpis["steps"]["delta"] == 2.0  # fewer than eight: against the first
    assert kpis["load"]["value"] is None and kpis["load"]["delta"] is None and kpis["load"]["spark"] == [5.0]
    assert kpis["stress_avg"]["spark"] == []


def test_tail(metrics):
    assert q.last_days(metrics, 3).count() == 3


def test_correlations(spark, metrics, rows):
    cells = rows(q.correlation_matrix(metrics, "all"))
    assert len(cells) == 64
    by = {(c["x"], c["y"]): c["v"] for c in cells}
    assert by["steps", "steps"] == 1.0 and by["steps", "load"] == by["load", "steps"]
    constant = metrics.withColumn("stress_avg", F.lit(5.0))
    flat = {(c["x"], c["y"]): c["v"] for c in rows(q.correlation_matrix(constant, "all"))}
    assert flat["stress_avg", "steps"] is None and flat["stress_avg", "stress_avg"] is None


def test_next_day(spark, metrics, rows):
    pairs = rows(q.sleep_next_day(metrics, "all"), "day")
    ready = column(metrics, "readiness")
    assert len(pairs) == 39 and pairs[0]["next_readiness"] == ready[1]


def test_goals_and_streak(spark, metrics, rows):
    goals = {r["key"]: r for r in rows(q.goals(metrics))}
    assert goals["steps"]["current"] == 12600.0 and goals["steps"]["progress"] == 1.26
    assert goals["acwr"]["target"] == 1.0
    assert q.steps_streak(metrics).first()["steps_streak"] == 30
    broken = metrics.withColumn("steps", F.when(F.col("day") >= day(38), F.col("steps")))
    assert q.steps_streak(broken).first()["steps_streak"] == 2
    assert q.steps_streak(metrics.withColumn("steps", F.lit(1.0))).first()["steps_streak"] == 0
    none = {r["key"]: r for r in rows(q.goals(metrics.withColumn("steps", F.lit(None).cast("double"))))}
    assert none["steps"]["current"] is None and none["steps"]["progress"] is None


def test_workouts(spark, metrics):
    listed = sorted(q.workouts(person(spark, 1)["exercise"], metrics, "7d").collect(), key=lambda r: r["start_time"], reverse=True)
    assert [r["date"] for r in listed] == [str(day(i)) for i in (39, 37, 35, 33)]
    first = listed[0]
    assert (first["type"], first["duration_min"], first["distance_km"], first["pace_min_km"]) == ("Beh", 40.0, 5.0, 8.0)
    assert first["mean_hr"] == 149 and first["trimp"] > 0
    assert q.workouts(person(spark, 1)["exercise"], metrics, "all").count() == 20


def test_workout_gaps(spark, rows):
    df = spark.createDataFrame(
        [(1, "2024-01-05 10:00:00", 0.0, 1000.0, "120.9"), (1, "2024-01-04 10:00:00", None, 0.0, None),
         (1, None, 60000.0, 1.0, "100")],
        "user_id int, start_time string, duration double, distance double, mean_hr string")
    got = rows(q.workouts(df, None, "all"), "date")
    assert [(r["date"], r["duration_min"], r["distance_km"], r["pace_min_km"], r["mean_hr"], r["trimp"]) for r in got] == [
        ("2024-01-04", None, None, None, None, 0.0), ("2024-01-05", None, 1.0, None, 120, 0.0)]


def test_workouts_of_a_dominant_person(spark):
    """One person with almost all workouts: nothing is lost or repeated."""
    many = spark.range(5000).selectExpr(
        "cast(if(id % 100 = 0, 2, 1) as int) as user_id",
        "timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, cast(id as int), 0) as start_time",
        "double(60000) as duration", "double(100 + id % 50) as mean_hr")
    assert q.workouts(many, None, "all").count() == 5000
    total = load.daily_load(many).agg(F.sum("load")).first()[0]
    each = many.select(F.sum(load.trimp(F.col("mean_hr"), F.lit(1.0), F.lit(60.0), F.lit(190.0), F.lit("male")))).first()[0]
    assert total == pytest.approx(each)
