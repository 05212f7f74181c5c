"""Training load: TRIMP per workout, load per day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitalgrid.functions.clean import as_number, as_time, calendar_day, clip, minutes_between
from vitalgrid.operators.candidates import position_of, time_of, value_of
from vitalgrid.params import DEFAULT_PARAMS, FALLBACK_HR_REST, MetricParams

# Candidate columns and the coefficients of the impulse formula.
WORKOUT_TIME_COLUMNS = ("start_time", "create_time", "time")
WORKOUT_HEART_RATES = ("mean_hr", "mean_heart_rate", "heart_rate")
MALE_FACTOR = (0.64, 1.92)
FEMALE_FACTOR = (0.86, 1.67)
MS_PER_MINUTE = 60000.0


def trimp(mean_hr: Column, minutes: Column, hr_rest: Column, hr_max: Column, sex: Column) -> Column:
    """Banister training impulse; 0 wherever an input is missing or makes no sense."""
    reserve = hr_max - hr_rest
    fraction = clip(F.try_divide(mean_hr - hr_rest, reserve), 0.0, 1.0)
    female_base, female_rate = FEMALE_FACTOR
    male_base, male_rate = MALE_FACTOR
    factor = F.when(sex == "female", F.lit(female_base) * F.exp(F.lit(female_rate) * fraction)) \
        .otherwise(F.lit(male_base) * F.exp(F.lit(male_rate) * fraction))
    usable = (minutes > 0) & (reserve > 0)
    return F.coalesce(F.when(usable, minutes * fraction * factor), F.lit(0.0))


def workout_rows(exercise: DataFrame, heart_rates=WORKOUT_HEART_RATES) -> DataFrame:
    """Workouts with parsed start, heart rate and both durations, tagged with the positions of
    the candidate columns they fill."""
    no_minutes = F.lit(None).cast("double")
    has = exercise.columns
    duration = as_number(exercise, "duration") / F.lit(MS_PER_MINUTE) if "duration" in has else no_minutes
    rows = exercise.withColumns({
        "_start": time_of(exercise, WORKOUT_TIME_COLUMNS),
        "_time_position": position_of(exercise, WORKOUT_TIME_COLUMNS),
        "_mean_hr": value_of(exercise, heart_rates, as_number),
        "_hr_position": position_of(exercise, heart_rates),
        "_minutes": duration,
        "_has_duration": F.col("duration").isNotNull() if "duration" in has else F.lit(False),
    })
    span = minutes_between(F.col("_start"), as_time(exercise, "end_time")) \
        if "end_time" in has else no_minutes
    return rows.withColumns({"_span": span, "_day": calendar_day(F.col("_start"))})


def positive_only(name: str) -> Column:
    return F.when(F.col(name) > 0, F.col(name))


def workout_choices(rows: DataFrame, *more: Column) -> DataFrame:
    """One row per person: which candidates that person's workouts use, the newest start, and ``more``
    aggregates."""
    newest = F.max(F.struct(-F.col("_time_position"), F.col("_start")))
    return rows.groupBy("user_id").agg(
        F.min("_time_position").alias("_best_time"),
        F.min("_hr_position").alias("_best_hr"),
        F.max("_has_duration").alias("_any_duration"),
        newest.alias("_newest"), *more,
    ).withColumn("_newest", F.col("_newest._start"))


def resting_median(daily: DataFrame) -> DataFrame:
    """One row per person: median of the daily resting heart rate (days are at most one row)."""
    return daily.groupBy("user_id").agg(F.percentile("resting_hr", F.lit(0.5)).alias("_median_hr"))


def person_values(
    choices: DataFrame,
    resting: DataFrame | None,
    params: MetricParams = DEFAULT_PARAMS,
    profiles: DataFrame | None = None,
) -> DataFrame:
    """Complete the per-person row with resting and maximum heart rate and sex."""
    persons = choices if resting is None else choices.join(resting, "user_id", "left")
    return with_profile(persons, params, profiles)


def with_profile(rows: DataFrame, params: MetricParams, profiles: DataFrame | None) -> DataFrame:
    """Rows with ``_hr_rest``, ``_hr_max`` and ``_sex`` of their person, from the profile, the parameters and
    the median ``_median_hr`` where the rows have it."""
    persons = rows
    rest = [F.lit(params.hr_rest).cast("double")]
    hr_max, sex = F.lit(float(params.hr_max)), F.lit(params.sex)
    if "_median_hr" in rows.columns:
        rest.append(F.col("_median_hr"))
    if profiles is not None:
        renamed = profiles.select("user_id", *[F.col(c).alias(f"_own_{c}") for c in ("sex", "hr_max", "hr_rest")])
        persons = persons.join(renamed, "user_id", "left")
        rest.insert(0, F.col("_own_hr_rest"))
        hr_max, sex = F.coalesce("_own_hr_max", hr_max), F.coalesce("_own_sex", sex)
    known = F.coalesce(*rest)
    hr_rest = F.when(known != 0, known).otherwise(F.lit(FALLBACK_HR_REST))
    return persons.withColumns({"_hr_rest": hr_rest, "_hr_max": hr_max, "_sex": sex})


def daily_load(
    exercise: DataFrame,
    resting: DataFrame | None = None,
    params: MetricParams = DEFAULT_PARAMS,
    profiles: DataFrame | None = None,
) -> DataFrame:
    """TRIMP summed per person and calendar day.

    TRIMP is proportional to the minutes, so workouts are first summed per person, day and heart
    rate. A person has few of those rows, however many workouts, and they meet the per-person values.
    """
    rows = workout_rows(exercise)
    positive = {name: F.sum(positive_only(name)) for name in ("_minutes", "_span")}
    summed = rows.groupBy("user_id", "_day", "_time_position", "_mean_hr", "_hr_position").agg(
        *[total.alias(name) for name, total in positive.items()])
    persons = person_values(workout_choices(rows), resting, params, profiles)
    joined = summed.where("_day is not null").join(persons, "user_id")
    minutes = F.when(F.col("_any_duration"), F.col("_minutes")).otherwise(F.col("_span"))
    mean_hr = F.when(F.col("_hr_position") == F.col("_best_hr"), F.col("_mean_hr"))
    load = trimp(mean_hr, minutes, F.col("_hr_rest"), F.col("_hr_max"), F.col("_sex"))
    return (
        joined.where("_time_position = _best_time")
        .groupBy("user_id", F.col("_day").alias("day")).agg(F.sum(load).alias("load"))
    )
