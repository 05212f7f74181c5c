"""The read queries over ``metrics_daily`` and the workout table, for all persons at once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitalgrid.functions.clean import as_number, finite, round_half_even
from vitalgrid.functions.codes import STAGES, exercise_name
from vitalgrid.operators import load as l
from vitalgrid.operators.candidates import position_of, value_of
from vitalgrid.operators.timeline import days
from vitalgrid.params import (
    CORRELATED, DEFAULT_PARAMS, GOAL_DAYS, GOALS, KPI_PREVIOUS_POSITION, KPI_SPARK_POINTS, KPIS,
    RANGES, READINESS_WEIGHTS, STREAK_STEPS, MetricParams,
)

# Names of the output columns.
SERIES_COLUMNS = (
    "readiness", "resting_hr", "rhr_baseline", "hr_avg",
    "sleep_minutes", "sleep_debt", "sleep_score", "sleep_regularity",
    "deep_h", "rem_h", "light_h", "awake_h",
    "stress_avg", "spo2_min", "steps",
    "load", "load_acute", "load_chronic", "acwr",
    "weight_ffill", "body_fat",
)
TAIL_COLUMNS = (
    "resting_hr", "sleep_minutes", "sleep_debt", "stress_avg", "load", "acwr", "readiness")

# Candidate columns of the workout list (load accepts one more heart rate).
LISTED_MEAN_HR = ("mean_hr", "mean_heart_rate")
LISTED_MAX_HR = ("max_hr", "max_heart_rate")
LISTED_CALORIES = ("calorie", "calories")


def days_of(range_name: str) -> int | None:
    if range_name not in RANGES:
        raise ValueError(f"range must be one of {', '.join(RANGES)}, not {range_name!r}")
    return RANGES[range_name]


def in_range(metrics: DataFrame, range_name: str) -> DataFrame:
    """The last days of each person, counted from that person's last day."""
    length = days_of(range_name)
    if length is None:
        return metrics
    newest = metrics.withColumn("_newest", F.max("day").over(Window.partitionBy("user_id")))
    return newest.where(F.col("day") >= F.date_sub("_newest", length - 1)).drop("_newest")


def _long(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """One row per key and column: ``keys, key, v``."""
    return df.unpivot(keys, columns, "key", "v")


# ---- summary ---------------------------------------------------------------------------------

def kpi_points(metrics: DataFrame, range_name: str = "30d") -> DataFrame:
    """Per person and KPI the last non-null values in range; ``pos`` 1 is the newest."""
    names = [k[0] for k in KPIS]
    window = _long(in_range(metrics, range_name), ["user_id", "day"], names)
    newest_first = Window.partitionBy("user_id", "key").orderBy(F.col("day").desc())
    return (
        window.where("v is not null").withColumn("pos", F.row_number().over(newest_first).cast("long"))
        .where(F.col("pos") <= KPI_SPARK_POINTS)
    )


def _kpi(name: str, label: str, unit: str, better: str) -> Column:
    """One KPI from ``_days``, the days in range in order: its last value, the change since the value
    some readings before, and the last points."""
    value = F.element_at("_days", -1)[name]
    points = F.filter(F.transform("_days", lambda d: d[name]), lambda v: v.isNotNull())
    previous = F.when(F.size(points) >= KPI_PREVIOUS_POSITION, F.get(points, F.size(points) - KPI_PREVIOUS_POSITION)) \
        .otherwise(F.get(points, F.lit(0)))
    newest = F.slice(points, F.greatest(F.size(points) - KPI_SPARK_POINTS + 1, F.lit(1)), KPI_SPARK_POINTS)
    return F.struct(
        F.lit(name).alias("key"), F.lit(label).alias("label"), F.lit(unit).alias("unit"),
        F.lit(better).alias("better"), value.alias("value"), (value - previous).alias("delta"),
        F.transform(newest, lambda v: round_half_even(v, 2)).alias("spark"))


def summary(metrics: DataFrame, range_name: str = "30d") -> DataFrame:
    """One row per person: ``as_of, readiness``, the component scores and the KPIs as an array.

    The last day lies in every range, so one aggregate per person over the days in range (at most some
    84,000) gives everything; it keeps the partitioning by person.
    """
    components = list(READINESS_WEIGHTS)
    last = F.struct("day", "readiness", F.struct(*components).alias("components"))
    persons = in_range(metrics, range_name).groupBy("user_id").agg(
        F.max_by(last, "day").alias("_last"),
        F.sort_array(F.collect_list(F.struct("day", *[k[0] for k in KPIS]))).alias("_days"))
    return persons.select(
        "user_id", F.col("_last.day").alias("as_of"), "_last.readiness", "_last.components",
        F.array(*[_kpi(*k) for k in KPIS]).alias("kpis"))


def summary_kpis(metrics: DataFrame, range_name: str = "30d") -> DataFrame:
    """``user_id, as_of, key, label, unit, better, value, delta, spark`` (oldest point first).

    ``value`` is that of the person's last day, even if null.
    """
    return summary(metrics, range_name).select("user_id", "as_of", F.explode("kpis").alias("k")).select(
        "user_id", "as_of", "k.*")


# ---- time series -----------------------------------------------------------------------------

def timeseries(metrics: DataFrame, range_name: str = "30d") -> DataFrame:
    """The daily series of each person, in no order: show them by ``day``."""
    hours = {
        f"{s}_h": F.col(f"{s}_pct") / F.lit(100.0) * F.col("sleep_minutes") / F.lit(60.0)
        for s in STAGES}
    return in_range(metrics, range_name).withColumns(hours).select(
        "user_id", F.date_format("day", "yyyy-MM-dd").alias("day"),
        *[finite(F.col(c)).alias(c) for c in SERIES_COLUMNS])


def last_days(metrics: DataFrame, n: int = 7) -> DataFrame:
    """The last ``n`` days of each person, rounded to one decimal."""
    newest_first = Window.partitionBy("user_id").orderBy(F.col("day").desc())
    return (
        metrics.withColumn("_row", F.row_number().over(newest_first)).where(F.col("_row") <= n)
        .select("user_id", "day", *[round_half_even(F.col(c), 1).alias(c) for c in TAIL_COLUMNS])
    )


# ---- workouts --------------------------------------------------------------------------------

WORKOUT_SCHEMA = "user_id long, start_time timestamp_ntz"


def workouts(
    exercise: DataFrame | None,
    metrics: DataFrame | None,
    range_name: str = "90d",
    params: MetricParams = DEFAULT_PARAMS,
    profiles: DataFrame | None = None,
) -> DataFrame:
    """Workouts with pace and TRIMP, in no order: show them by ``start_time`` descending.

    Without a workout table (``None``) there are none. Persons are not windowed: their newest start and
    resting heart rate come from one aggregate and meet the rows by an equi-join, which adaptive
    execution splits for a large person.
    """
    length = days_of(range_name)
    if exercise is None:
        exercise = metrics.sparkSession.createDataFrame([], WORKOUT_SCHEMA)
    rows = l.workout_rows(exercise, LISTED_MEAN_HR)
    resting = None if metrics is None or params.hr_rest is not None else l.resting_median(metrics)
    extras = {"_max_hr": LISTED_MAX_HR, "_calorie": LISTED_CALORIES}
    tagged = rows
    best = []
    for name, candidates in extras.items():
        tagged = tagged.withColumns({
            name: value_of(exercise, candidates, as_number),
            f"{name}_position": position_of(exercise, candidates)})
        best.append(F.min(f"{name}_position").alias(f"_best{name}"))
    for name in ("distance", "exercise_type"):
        value = as_number(exercise, name) if name in exercise.columns else F.lit(None).cast("double")
        tagged = tagged.withColumn(f"_{name}", value)
    persons = l.person_values(l.workout_choices(tagged, *best), resting, params, profiles)

    listed = tagged.where("_start is not null").join(persons, "user_id").where("_time_position = _best_time")
    if length is not None:
        oldest = F.col("_newest") - F.make_dt_interval(days=F.lit(length - 1))
        listed = listed.where(F.col("_start") >= oldest)

    def chosen(name: str, position: str, wanted: str) -> Column:
        return F.when(F.col(position) == F.col(wanted), F.col(name))

    minutes, meters = F.col("_minutes"), F.col("_distance")
    mean_hr = chosen("_mean_hr", "_hr_position", "_best_hr")
    pace = F.when((minutes != 0) & (meters > 0), minutes / (meters / F.lit(1000.0)))
    load = l.trimp(mean_hr, F.coalesce(minutes, F.lit(0.0)),
                   F.col("_hr_rest"), F.col("_hr_max"), F.col("_sex"))
    calorie = chosen("_calorie", "_calorie_position", "_best_calorie")
    max_hr = chosen("_max_hr", "_max_hr_position", "_best_max_hr")
    return listed.select(
        "user_id",
        F.col("_start").alias("start_time"),
        F.date_format("_day", "yyyy-MM-dd").alias("date"),
        exercise_name(F.col("_exercise_type")).alias("type"),
        round_half_even(F.when(minutes != 0, minutes), 1).alias("duration_min"),
        round_half_even(F.when(meters != 0, meters / F.lit(1000.0)), 2).alias("distance_km"),
        round_half_even(pace, 2).alias("pace_min_km"),
        round_half_even(calorie, 0).alias("calorie"),
        mean_hr.try_cast("int").alias("mean_hr"),
        max_hr.try_cast("int").alias("max_hr"),
        round_half_even(load, 1).alias("trimp"),
    )


# ---- correlations ----------------------------------------------------------------------------

def correlation_matrix(metrics: DataFrame, range_name: str = "90d", digits: int | None = 2) -> DataFrame:
    """Pearson r of every pair of metrics over the days that have both: ``user_id, x, y, v``.

    ``corr`` fails on a constant column, so r is built from central moments, null where one is constant.
    Those of all pairs are one row of aggregation state per person, which is merged (stably, by Spark's own central
    moments) before the shuffle; rows of days are neither multiplied nor collected.
    """
    pairs = [(a, b) for i, a in enumerate(CORRELATED) for b in CORRELATED[i:]]
    moments = []
    for n, (a, b) in enumerate(pairs):
        x, y = F.when(F.col(b).isNotNull(), F.col(a)), F.when(F.col(a).isNotNull(), F.col(b))
        deviations = F.stddev_pop(x) * (F.stddev_pop(y) if a != b else F.stddev_pop(x))
        moments.append(F.try_divide(F.covar_pop(a, b), deviations).alias(f"r{n}"))
    persons = in_range(metrics, range_name).groupBy("user_id").agg(*moments)
    r = persons.select("user_id", F.explode(F.array(*[
        F.struct(F.lit(a).alias("x"), F.lit(b).alias("y"), F.col(f"r{n}").alias("v"))
        for n, (a, b) in enumerate(pairs)])).alias("r")).select("user_id", "r.*")
    bounded = F.least(F.lit(1.0), F.greatest(F.lit(-1.0), F.col("v")))
    v = F.when(F.col("v").isNotNull(), bounded)
    cells = F.when(F.col("x") == F.col("y"), F.array(F.struct("x", "y"))).otherwise(
        F.array(F.struct("x", "y"), F.struct(F.col("y").alias("x"), F.col("x").alias("y"))))
    return r.select(
        "user_id", F.explode(cells).alias("c"),
        (v if digits is None else round_half_even(v, digits) + F.lit(0.0)).alias("v"),  # no negative zero
    ).select("user_id", "c.x", "c.y", "v")


def sleep_next_day(metrics: DataFrame, range_name: str = "90d") -> DataFrame:
    """Hours slept and the readiness of the following row, where both are known."""
    following = in_range(metrics, range_name).withColumn("_next", F.lead("readiness").over(days()))
    return following.where("sleep_minutes is not null and _next is not null").select(
        "user_id", "day",
        round_half_even(F.col("sleep_minutes") / F.lit(60.0), 2).alias("sleep_h"),
        round_half_even(F.col("_next"), 1).alias("next_readiness"))


# ---- goals -----------------------------------------------------------------------------------

def goal_values(metrics: DataFrame) -> DataFrame:
    """Mean of each goal over the last rows and the progress towards its target, unrounded."""
    names = [g[0] for g in GOALS]
    recent = metrics.withColumn("_newest", F.max("day").over(Window.partitionBy("user_id"))) \
        .where(F.col("day") > F.date_sub("_newest", GOAL_DAYS))
    means = recent.groupBy("user_id").agg(*[F.avg(c).alias(c) for c in names])
    current = _long(means, ["user_id"], names).withColumnRenamed("v", "current")

    def per_goal(i: int) -> Column:
        return F.element_at(
            F.create_map(*[F.lit(x) for g in GOALS for x in (g[0], g[i])]), F.col("key"))

    near_one = F.greatest(F.lit(0.0), F.lit(1.0) - F.abs(F.col("current") - F.lit(1.0)))
    reached = F.least(F.lit(1.5), F.col("current") / F.col("target"))
    progress = F.when(
        F.col("current").isNotNull(), F.when(F.col("key") == "acwr", near_one).otherwise(reached))
    labelled = current.withColumns(
        {"label": per_goal(1), "target": per_goal(2), "unit": per_goal(3)})
    return labelled.select(
        "user_id", "key", "label", "unit", "current", "target", progress.alias("progress"))


def goals(metrics: DataFrame) -> DataFrame:
    """``goal_values`` as shown: one decimal for the mean, two for the progress."""
    return goal_values(metrics).withColumns({
        "current": round_half_even(F.col("current"), 1),
        "progress": round_half_even(F.col("progress"), 2),
    })


def steps_streak(metrics: DataFrame) -> DataFrame:
    """Days in a row, back from the last, with the step goal reached."""
    reached = F.coalesce(F.col("steps") >= STREAK_STEPS, F.lit(False))
    # days are dense: the streak is as long as the last missed day is away
    return metrics.groupBy("user_id").agg(
        F.coalesce(F.date_diff(F.max("day"), F.max(F.when(~reached, F.col("day")))), F.count("*"))
        .cast("long").alias("steps_streak"))
