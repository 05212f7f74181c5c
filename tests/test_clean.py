"""Numbers, times, days, clipping, rounding, codes, names."""

from __future__ import annotations

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from vitalgrid.functions import clean, codes, display
from vitalgrid.functions.names import header_names, table_name


def apply(spark, values, make, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(make(F.col("v"))).collect()]


def test_numbers(spark):
    texts = ["12", " 12.5 ", "-3e2", ".5", "5.", "12d", "1f", "inf", "-inf", "NaN", "", None, "x", "1_0"]
    assert apply(spark, texts, clean.parse_number) == [
        12.0, 12.5, -300.0, 0.5, 5.0] + [None] * 9


def test_times_on_read(spark):
    texts = ["1704142800000", "2024-06-15 12:30:00.000", "junk", None, "99999999999999999",
             "1001-01-01 00:00:00", "99999999999999", "20240104", "01/05/2024", "10:00", "-5",
             "7150000000000", "7200000000000", "2200-01-01 00:00:00", "2200-01-01 00:00:01", "1e30",
             " 2024-06-15T12:30:00 "]
    assert apply(spark, texts, clean.parse_time) == [
        datetime(2024, 1, 1, 21), datetime(2024, 6, 15, 12, 30), None, None, None, None, None,
        datetime(2024, 1, 4), datetime(2024, 1, 5), None, None,
        datetime(1970, 1, 1) + timedelta(seconds=7150000000), None, datetime(2200, 1, 1), None, None,
        datetime(2024, 6, 15, 12, 30)]


def test_times_at_ingest_reach_the_last_trusted_day(spark):
    texts = ["2024-01-01 06:00:00.000", "1001-01-01 00:00:00", None, "2024-06-15 12:30:00.000",
             "99999999999999", "7258118400000", "7258118400001"]
    at_ingest = lambda c: clean.parse_time(c, clean.EPOCH_MS_BELOW_AT_INGEST)
    assert apply(spark, texts, at_ingest) == [
        datetime(2024, 1, 1, 6), None, None, datetime(2024, 6, 15, 12, 30), None,
        datetime(2200, 1, 1), None]


def test_typed_columns_keep_their_times(spark):
    df = spark.sql("select timestamp_ntz'2024-03-31 02:30:00' as t union all select timestamp_ntz'1960-01-01'")
    got = {r[0] for r in df.select(clean.as_time(df, "t")).collect()}
    assert got == {datetime(2024, 3, 31, 2, 30), None}  # a time the session zone skips


def test_days(spark):
    texts = ["2024-01-01 23:00:00", "2024-01-01 17:59:59", "2024-01-01 18:00:00"]
    assert apply(spark, texts, lambda c: clean.wake_day(clean.parse_time(c))) == [
        date(2024, 1, 2), date(2024, 1, 1), date(2024, 1, 2)]
    assert apply(spark, texts, lambda c: clean.calendar_day(clean.parse_time(c))) == [date(2024, 1, 1)] * 3


def test_minutes_do_not_follow_daylight_saving(spark):
    df = spark.sql("select timestamp_ntz'2024-03-30 23:00:00' a, timestamp_ntz'2024-03-31 07:00:00.5' b")
    assert df.select(clean.minutes_between(F.col("a"), F.col("b"))).first()[0] == pytest.approx(480 + 0.5 / 60)


def test_clip_and_finite(spark):
    assert apply(spark, [None, -1.0, 50.0, 101.0], clean.clip, "double") == [None, 0.0, 50.0, 100.0]
    values = [1.0, float("nan"), float("inf"), float("-inf"), None]
    assert apply(spark, values, clean.finite, "double") == [1.0, None, None, None, None]


def test_rounding_is_half_even(spark):
    half = lambda c: clean.round_half_even(c, 1)
    assert apply(spark, [0.25, 0.35, 33.25, 66.666, None], half, "double") == [0.2, 0.4, 33.2, 66.7, None]


def test_null_tokens(spark):
    texts = ["", "NA", "null", "None", "nan", "#N/A", " x ", "0", "na"]
    assert apply(spark, texts, clean.null_tokens_to_null) == [None] * 6 + [" x ", "0", "na"]


def test_codes(spark):
    stages = [1.0, 40001.0, 2.0, 3.0, 40003.0, 4.0, 40004.0, 9.0, None, 3.5]
    assert apply(spark, stages, codes.stage_name, "double") == [
        "awake", "awake", "light", "deep", "deep", "rem", "rem", "light", "light", "light"]
    kinds = [1002.0, 1002.9, 0.0, None, 77.0]
    assert apply(spark, kinds, codes.exercise_name, "double") == [
        "Beh", "Beh", "Tréning", "Tréning", "Tréning"]


def test_bands(spark):
    assert apply(spark, [None, 75.0, 74.9, 55.0, 40.0, 39.9], display.status_band, "double") == [
        "–", "Výborné zotavenie", "Dobré zotavenie", "Dobré zotavenie", "Priemerné",
        "Nízke — oddýchni si"]
    assert apply(spark, [None, 0.7, 0.8, 1.3, 1.4, 1.5, 1.6], display.acwr_band, "double") == [
        "–", "under", "sweet spot", "sweet spot", "above", "above", "overreach"]
    assert apply(spark, [None, 479.6, 65.0, 0.0], display.duration_text, "double") == [
        "–", "8:00", "1:05", "0:00"]
    for better, expected in (("lower", ["flat", "flat", "down", "up"]),
                             ("higher", ["flat", "flat", "up", "down"]),
                             ("neutral", ["flat"] * 4)):
        got = apply(spark, [None, 0.5, 0.6, -0.6],
                    lambda c, b=better: display.kpi_direction(c, F.lit(b)), "double")
        assert got == expected


def test_names(spark):
    headers = [["com.samsung.health.heart_rate.start_time", "com.samsung.health.x.time", "time"],
               [" a ", None, "b", "", None], ["a", "b", "a", "A", "a", "user_id"], [], None]
    found = apply(spark, headers, header_names, "array<string>")
    assert found == [["start_time", "x_time", "time"], ["a", "", "b"],
                     ["a", "b", "a_2", "A_3", "a_4", "user_id_2"], [], None]
    assert table_name("com.samsung.shealth.sleep_combined") == "sleep_combined"
    assert table_name("com.samsung.health.Weight-1") == "weight_1"
    assert table_name("com.samsung.health.") == table_name(None) == "unknown"


def test_times_with_a_zone_are_null(spark):
    texts = ["2024-01-01 23:00:00+02:00", "2024-01-01T23:00:00Z", "2024-01-01 23:00:00.5 UTC", "2024-01-01 23:00:00.5"]
    assert [t is None for t in apply(spark, texts, clean.parse_time)] == [True, True, True, False]
