"""Daily aggregates and the per-person choice of columns and tables."""

from __future__ import annotations

from datetime import date, datetime

import pytest

from vitalgrid import build_daily_metrics
from vitalgrid.operators import daily
from vitalgrid.operators.assembly import daily_rows
from vitalgrid.params import DEFAULT_PARAMS

D1, D2, D3 = date(2024, 1, 1), date(2024, 1, 2), date(2024, 1, 3)


def test_resting_hr(spark, rows):
    df = spark.createDataFrame(
        [(1, "2024-01-01 07:00:00", "60"), (1, "2024-01-01 12:00:00", "90"), (1, "2024-01-02 07:00:00", "bad"),
         (1, None, "40"), (2, "2024-01-01 08:00:00", "50")], "user_id int, start_time string, bpm string")
    assert rows(daily.daily_resting_hr(df), "user_id") == [
        {"user_id": 1, "day": D1, "resting_hr": 60.0, "hr_avg": 75.0},
        {"user_id": 2, "day": D1, "resting_hr": 50.0, "hr_avg": 50.0}]


def test_value_column_is_chosen_per_person(spark, rows):
    df = spark.createDataFrame(
        [(1, "2024-01-01", "60", "1"), (1, "2024-01-02", None, "2"), (2, "2024-01-01", None, "3")],
        "user_id int, start_time string, bpm string, heart_rate string")
    got = rows(daily.daily_resting_hr(df), "user_id")
    # person 1 has bpm, so the row without bpm does not count although heart_rate is filled
    assert [(r["user_id"], r["day"], r["resting_hr"]) for r in got] == [(1, D1, 60.0), (2, D1, 3.0)]


def test_time_column_is_chosen_per_person(spark, rows):
    df = spark.createDataFrame(
        [(1, "2024-01-01", "2024-01-03", 50.0), (1, None, "2024-01-03", 60.0), (2, None, "2024-01-02", 70.0),
         (3, "junk", "2024-01-02", 80.0)],
        "user_id int, start_time string, create_time string, score double")
    got = rows(daily.daily_stress(df), "user_id")
    # person 3 has a start time, even though nothing reads as one: no fallback
    assert [(r["user_id"], r["day"], r["stress_avg"]) for r in got] == [(1, D1, 50.0), (2, D2, 70.0)]


def test_steps_take_the_largest_report_and_default_to_zero(spark, rows):
    df = spark.createDataFrame(
        [(1, "2024-01-01", 100.0, 5.0), (1, "2024-01-01", 300.0, None), (1, "2024-01-02", None, 7.0),
         (2, "2024-01-01", 10.0, None)], "user_id int, day_time string, steps double, active_time double")
    got = rows(daily.daily_steps(df), "user_id", "day")
    assert [(r["user_id"], r["day"], r["steps"], r["active_minutes"], r["calories"]) for r in got] == [
        (1, D1, 300.0, 5.0, 0.0), (1, D2, None, 7.0, 0.0), (2, D1, 10.0, 0.0, 0.0)]


def test_person_without_step_column_has_no_days(spark):
    df = spark.createDataFrame(
        [(1, "2024-01-01", None, 5.0)], "user_id int, day_time string, steps double, calorie double")
    assert daily.daily_steps(df).count() == 0


def test_first_table_with_rows_is_chosen_per_person(spark, rows):
    real = spark.createDataFrame(
        [(1, "1704142800000", "7000"), (3, None, "9")], "user_id int, create_time string, step_count string")
    generated = spark.createDataFrame(
        [(1, datetime(2024, 1, 3), 100.0), (2, datetime(2024, 1, 3), 200.0), (3, datetime(2024, 1, 3), 300.0)],
        "user_id int, day_time timestamp_ntz, steps double")
    got = rows(daily.daily_steps(real, generated), "user_id")
    # person 3's rows in the first table have no time, but the table is still theirs
    assert [(r["user_id"], r["day"], r["steps"]) for r in got] == [(1, D1, 7000.0), (2, D3, 200.0)]


def test_sleep(spark, rows):
    df = spark.createDataFrame(
        [(1, "2024-01-01 23:00:00", "2024-01-02 07:00:00", 400.0, 80.0, 70.0),
         (1, "2024-01-02 03:00:00", "2024-01-02 04:00:00", 3600000.0, 90.0, 75.0),
         (2, "2024-01-01 17:59:00", "2024-01-01 18:59:00", None, None, None)],
        "user_id int, start_time string, end_time string, sleep_duration double, efficiency double, score double")
    one, two = rows(daily.nightly_sleep(df), "user_id")
    assert (one["day"], one["sleep_minutes"], one["sleep_efficiency"], one["sleep_score"]) == (D2, 460.0, 85.0, 75.0)
    # middle 03:00 and 03:30, counted from 18:00
    assert one["sleep_midpoint"] == pytest.approx(9.25)
    # no duration: the span counts; 18:29 is half an hour after 18:00
    assert (two["day"], two["sleep_minutes"]) == (D1, 60.0)
    assert two["sleep_midpoint"] == pytest.approx(29 / 60)


def test_sleep_without_end_time_or_duration_is_zero(spark, rows):
    df = spark.createDataFrame(
        [(1, "2024-01-01 17:00:00", "80")], "user_id int, start_time string, sleep_score string")
    (night,) = rows(daily.nightly_sleep(df))
    assert (night["sleep_minutes"], night["sleep_midpoint"], night["sleep_score"]) == (0.0, 23.0, 80.0)


def test_stages(spark, rows):
    def segment(user, start, minutes, stage):
        s = datetime(2024, 1, 2, 0, start)
        return user, s, datetime(2024, 1, 2, 0, start + minutes), stage
    df = spark.createDataFrame(
        [segment(1, 0, 10, 1.0), segment(1, 10, 10, 40003.0), segment(1, 20, 10, 9.0), segment(2, 0, 0, 3.0)],
        "user_id int, start_time timestamp_ntz, end_time timestamp_ntz, stage double")
    one, two = rows(daily.nightly_stages(df), "user_id")
    assert {k: one[k] for k in ("awake_pct", "light_pct", "deep_pct", "rem_pct")} == {
        "awake_pct": 33.3, "light_pct": 33.3, "deep_pct": 33.3, "rem_pct": 0.0}
    # a night of zero minutes: null for stages the person shows, 0 for the others
    assert (two["deep_pct"], two["rem_pct"]) == (None, 0.0)


def test_spo2_and_body(spark, rows):
    spo2 = spark.createDataFrame(
        [(1, "2024-01-01", "94"), (1, "2024-01-01", "98")], "user_id int, start_time string, oxygen_saturation string")
    assert rows(daily.daily_spo2(spo2)) == [{"user_id": 1, "day": D1, "spo2_min": 94.0, "spo2_avg": 96.0}]
    body = spark.createDataFrame(
        [(1, "2024-01-01", 80.0), (1, "2024-01-01", 82.0), (1, "2024-01-02", None)],
        "user_id int, start_time string, weight double")
    assert [(r["day"], r["weight"], r["bmi"]) for r in rows(daily.body_series(body), "day")] == [
        (D1, 81.0, None), (D2, None, None)]


def test_tables_with_other_candidates(spark, rows):
    combined = spark.createDataFrame(
        [(1, "2024-01-01 23:00:00", 80.0, 70.0)], "user_id int, start_time string, score double, sleep_score double")
    plain = spark.createDataFrame([(2, "2024-01-02 23:00:00", 60.0)], "user_id int, start_time string, sleep_score double")
    both = rows(daily.nightly_sleep(combined, plain), "user_id")
    assert [(r["user_id"], r["sleep_score"]) for r in both] == [(1, 80.0), (2, 60.0)]


def test_all_sources_at_once_are_those_of_each(spark, rows):
    """The tagged union gives what each source gives by itself, for persons who fill different columns and tables."""
    def times(i):
        return f"2024-01-0{1 + i % 5} {i % 24:02d}:30:00"

    n = range(60)
    tables = {
        "heart_rate": spark.createDataFrame(
            [(i % 4, times(i) if i % 4 else None, times(i + 1), 50.0 + i if i % 2 else None, 60.0 + i) for i in n],
            "user_id int, start_time string, create_time string, bpm double, value double"),
        "stress": spark.createDataFrame([(i % 3, times(i), float(i) if i % 7 else None) for i in n], "user_id int, time string, value double"),
        "spo2": spark.createDataFrame([(i % 3, times(i), 90.0 + i % 9) for i in n], "user_id int, start_time string, spo2 double"),
        "sleep_stage": spark.createDataFrame(
            [(i % 4, times(i), times(i)[:-5] + "55:00", 40001.0 + i % 3 if i % 4 else None) for i in n],
            "user_id int, start_time string, end_time string, stage double"),
        "sleep_combined": spark.createDataFrame([(i % 2, times(i), 300.0 + i, 50.0 + i) for i in n],
                                                "user_id int, start_time string, sleep_duration double, score double"),
        "sleep": spark.createDataFrame([(i % 4, times(i), times(i)[:-5] + "50:00", 40.0 + i) for i in n],
                                       "user_id int, start_time string, end_time string, sleep_score double"),
        "step_daily_trend": spark.createDataFrame([(i % 2, None if i % 2 else times(i), 100.0 * i) for i in n],
                                                  "user_id int, create_time string, count double"),
        "steps_daily": spark.createDataFrame([(i % 4, times(i), 10.0 * i, float(i)) for i in n],
                                             "user_id int, day_time string, steps double, calorie double"),
        "weight": spark.createDataFrame([(i % 2, times(i), 70.0 + i) for i in n], "user_id int, start_time string, weight double"),
        "body_composition": spark.createDataFrame([(i % 4, times(i), 80.0 + i, 20.0) for i in n],
                                                  "user_id int, start_time string, weight double, body_fat double"),
    }
    merged, columns = daily_rows(tables, DEFAULT_PARAMS, None)
    together = {(r["user_id"], r["day"]): r for r in rows(merged)}
    single = [
        daily.daily_resting_hr(tables["heart_rate"]), daily.daily_stress(tables["stress"]), daily.daily_spo2(tables["spo2"]),
        daily.nightly_stages(tables["sleep_stage"]), daily.nightly_sleep(tables["sleep_combined"], tables["sleep"]),
        daily.daily_steps(tables["step_daily_trend"], tables["steps_daily"]), daily.body_series(tables["weight"], tables["body_composition"])]
    seen = set()
    for frame in single:
        found = rows(frame)
        assert found
        for row in found:
            key = (row.pop("user_id"), row.pop("day"))
            seen.add(key)
            for name, value in row.items():
                source, column = columns[name].split(".")
                assert together[key][source][column] == (value if value is None else pytest.approx(value)), (key, name)
    assert {k for k, r in together.items() if any(r[s] is not None for s in r if s not in ("user_id", "day"))} == seen


def test_metrics_shuffle_twice(spark):
    frames = {
        "heart_rate": spark.createDataFrame([(1, datetime(2024, 1, 1), 60.0)], "user_id int, start_time timestamp_ntz, bpm double"),
        "steps_daily": spark.createDataFrame([(1, datetime(2024, 1, 1), 60.0)], "user_id int, day_time timestamp_ntz, steps double"),
        "exercise": spark.createDataFrame([(1, datetime(2024, 1, 1), 6e5, 120.0)],
                                          "user_id int, start_time timestamp_ntz, duration double, mean_hr double"),
    }
    plan = build_daily_metrics(frames)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2 and "Join" not in plan
