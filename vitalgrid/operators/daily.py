"""Daily and nightly aggregates: one row per person and day from each kind of record.

Every kind is described by a :class:`Source`. Raw records are first pre-aggregated per person,
day and candidate position (partial aggregation runs before the shuffle, so neither a large
person nor repeated records concentrate work). ``settle`` then applies the per-person choices on
those few rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitalgrid.functions.clean import (
    as_number, as_time, calendar_day, minutes_between, round_half_even, seconds_between, wake_day,
)
from vitalgrid.functions.codes import STAGES, stage_name
from vitalgrid.operators.candidates import first_filled, position_of, present, time_of

# Candidate columns, in order of preference.
TIME_COLUMNS = (
    "start_time", "create_time", "day_time", "time", "start", "end_time", "update_time")
NIGHT_TIME_COLUMNS = ("start_time", "create_time", "time")
HEART_RATE_VALUES = ("bpm", "heart_rate", "value")
STEP_VALUES = ("steps", "step_count", "count")
ACTIVE_VALUES = ("active_time", "active_minutes")
CALORIE_VALUES = ("calorie", "calories")
SLEEP_DURATIONS = ("sleep_duration", "duration")
SLEEP_SCORES = ("score", "sleep_score")
STRESS_VALUES = ("score", "value")
SPO2_VALUES = ("spo2", "oxygen_saturation", "value")
BODY_VALUES = ("weight", "body_fat", "skeletal_muscle", "muscle_mass", "bmi")
SLEEP_DURATION_MS_FROM = 1000.0
MIDPOINT_ZERO_HOUR = 18.0

# Tables that hold the same facts, in order of preference.
STEP_TABLES = ("activity_day_summary", "step_daily_trend", "steps_daily")
SLEEP_TABLES = ("sleep_combined", "sleep")
BODY_TABLES = ("weight", "body_composition")

HOW: dict[str, Callable[[Column], Column]] = {
    "min": F.min, "max": F.max, "avg": F.avg, "sum": F.sum}

#: stands for "whatever the person has", the last choice of a measure
ALWAYS = None


@dataclass(frozen=True)
class Source:
    """How one kind of record becomes daily columns.

    ``measures`` maps an output column to its choices: names of the candidate columns, with
    ``ALWAYS`` as a last resort. A day is kept if ``needs_value`` is filled, or if the person has
    any of ``needs_any``.
    """

    name: str
    measures: dict[str, tuple[str | None, ...]]
    needs_any: tuple[str, ...] = ()
    needs_value: str | None = None
    zero_if_null: tuple[str, ...] = ()


HEART_RATE = Source(
    "heart_rate", {"resting_hr": HEART_RATE_VALUES, "hr_avg": HEART_RATE_VALUES},
    needs_value="hr_avg")
STEPS = Source(
    "steps",
    {"steps": STEP_VALUES, "active_minutes": (*ACTIVE_VALUES, ALWAYS),
     "calories": (*CALORIE_VALUES, ALWAYS)},
    needs_any=STEP_VALUES)
SLEEP = Source(
    "sleep",
    {"sleep_minutes": (*SLEEP_DURATIONS, ALWAYS), "sleep_efficiency": ("efficiency",),
     "sleep_score": SLEEP_SCORES, "sleep_midpoint": ("end_time", ALWAYS)},
    zero_if_null=("sleep_minutes",))
STAGE_MINUTES = tuple(f"{stage}_min" for stage in STAGES)
STAGE_SEEN = tuple(f"{stage}_seen" for stage in STAGES)
SLEEP_STAGE = Source(
    "sleep_stage", {name: (ALWAYS,) for name in (*STAGE_MINUTES, *STAGE_SEEN)},
    needs_any=("stage",), zero_if_null=STAGE_MINUTES)
STRESS = Source("stress", {"stress_avg": STRESS_VALUES}, needs_value="stress_avg")
SPO2 = Source(
    "spo2", {"spo2_min": SPO2_VALUES, "spo2_avg": SPO2_VALUES}, needs_value="spo2_avg")
BODY = Source("body", {name: (name,) for name in BODY_VALUES}, needs_any=BODY_VALUES)


@dataclass
class Records:
    """Raw rows of one table, with the aggregates their days need.

    ``several`` says that other tables hold the same facts: which columns are filled is then kept even
    of a table with a single candidate.
    """

    source: Source
    rows: DataFrame
    day: Column
    times: Sequence[str]
    several: bool = False
    values: dict[str, tuple[str, Column]] = field(default_factory=dict)
    flags: dict[str, Column] = field(default_factory=dict)

    def value(self, measure: str, choice: str | None, how: str, x: Column) -> None:
        i = self.source.measures[measure].index(choice)
        self.values[f"{measure}__{i}"] = (how, x)

    def numbers(self, measure: str, how: str) -> None:
        """Aggregate each candidate column of ``measure`` that the rows have."""
        has = self.rows.columns
        choices = [c for c in self.source.measures[measure] if c is ALWAYS or c in has]
        open_choice = len(choices) > 1 or self.several and len(self.source.measures[measure]) > 1
        for column in choices:
            if column in has:
                self.value(measure, column, how, as_number(self.rows, column))
                if open_choice or column in self.source.needs_any:
                    self.flag(column)
            elif column is ALWAYS:
                self.value(measure, column, how, F.lit(0.0))

    def flag(self, column: str) -> None:
        if column in self.rows.columns:
            self.flags[flag_name(self.source, column)] = F.col(column).isNotNull()


def flag_name(source: Source, column: str | None) -> str:
    return f"has__{source.name}__{column}"


def pre_aggregate(records: Records, table_position: int | None = None) -> DataFrame:
    keys = [F.col("user_id"), records.day.alias("day")]
    df = records.rows.where("user_id is not null")
    if len(present(df, records.times)) > 1:
        keys.append(position_of(df, records.times).alias("time_position"))
    elif not records.flags and table_position is None:
        df = df.where(records.day.isNotNull())  # no choice depends on a row without a day
    rows = df.groupBy(*keys).agg(
        *[HOW[how](x).alias(name) for name, (how, x) in records.values.items()],
        *[F.max(filled).alias(name) for name, filled in records.flags.items()])
    if table_position is not None:
        rows = rows.withColumn("table_position", F.lit(table_position))
    return rows


def _by_day(source: Source, df: DataFrame, several: bool = False) -> Records:
    return Records(source, df, calendar_day(time_of(df, TIME_COLUMNS)), TIME_COLUMNS, several)


def heart_rate_records(df: DataFrame) -> Records:
    found = _by_day(HEART_RATE, df)
    found.numbers("resting_hr", "min")
    found.numbers("hr_avg", "avg")
    return found


def stress_records(df: DataFrame) -> Records:
    found = _by_day(STRESS, df)
    found.numbers("stress_avg", "avg")
    return found


def spo2_records(df: DataFrame) -> Records:
    found = _by_day(SPO2, df)
    found.numbers("spo2_min", "min")
    found.numbers("spo2_avg", "avg")
    return found


def step_records(df: DataFrame, several: bool = False) -> Records:
    """Several devices report the same day, so the day takes the largest report."""
    found = _by_day(STEPS, df, several)
    for measure in STEPS.measures:
        found.numbers(measure, "max")
    return found


def body_records(df: DataFrame, several: bool = False) -> Records:
    found = _by_day(BODY, df, several)
    for measure in BODY.measures:
        found.numbers(measure, "avg")
    return found


def _minutes_asleep(duration: Column) -> Column:
    """Durations below the threshold are minutes, larger ones milliseconds."""
    return F.when(duration < SLEEP_DURATION_MS_FROM, duration).otherwise(duration / F.lit(60000.0))


def _midpoint_hours(midpoint: Column) -> Column:
    """Hours after 18:00, so that midpoints around midnight do not wrap."""
    midnight = midpoint.cast("date").cast("timestamp_ntz")
    hours = seconds_between(midnight, midpoint) / F.lit(3600.0)
    return F.pmod(hours - F.lit(MIDPOINT_ZERO_HOUR), F.lit(24.0))


def sleep_records(df: DataFrame, several: bool = False) -> Records:
    start = time_of(df, NIGHT_TIME_COLUMNS)
    end = as_time(df, "end_time") if "end_time" in df.columns else F.lit(None).cast("timestamp_ntz")
    timed = df.withColumns({"_start": start, "_end": end})
    span = minutes_between(F.col("_start"), F.col("_end"))
    found = Records(SLEEP, timed, wake_day(F.col("_start")), NIGHT_TIME_COLUMNS, several)
    for column in SLEEP_DURATIONS:
        if column in df.columns:
            minutes = F.coalesce(_minutes_asleep(as_number(df, column)), span)
            found.value("sleep_minutes", column, "sum", minutes)
            found.flag(column)
    # without an end time a night has no span; its sum is then 0 through zero_if_null
    found.value("sleep_minutes", ALWAYS, "sum", span)
    found.numbers("sleep_efficiency", "avg")
    found.numbers("sleep_score", "max")
    if "end_time" in df.columns:
        middle = F.col("_start") + (F.col("_end") - F.col("_start")) / F.lit(2)
        found.value("sleep_midpoint", "end_time", "avg", _midpoint_hours(middle))
        found.flag("end_time")
    found.value("sleep_midpoint", ALWAYS, "avg", _midpoint_hours(F.col("_start")))
    return found


def stage_records(df: DataFrame) -> Records:
    start = time_of(df, NIGHT_TIME_COLUMNS)
    minutes = minutes_between(F.col("_start"), as_time(df, "end_time")) \
        if "end_time" in df.columns else F.lit(0.0)
    if "stage" in df.columns:
        stage = stage_name(as_number(df, "stage"))
        timed = df.withColumn("_start", start).withColumns({"_minutes": minutes, "_stage": stage})
    else:
        timed = df.withColumn("_start", start).withColumns(
            {"_minutes": F.lit(None).cast("double"), "_stage": F.lit(None).cast("string")})
    found = Records(SLEEP_STAGE, timed, wake_day(F.col("_start")), NIGHT_TIME_COLUMNS)
    found.flag("stage")
    for stage, in_minutes, seen in zip(STAGES, STAGE_MINUTES, STAGE_SEEN):
        found.value(in_minutes, ALWAYS, "sum",
                    F.when(F.col("_stage") == stage, F.coalesce("_minutes", F.lit(0.0))))
        found.value(seen, ALWAYS, "max",
                    F.when((F.col("_stage") == stage) & F.col("_start").isNotNull(), 1.0))
    return found


def settle(rows: DataFrame, source: Source) -> DataFrame:
    """Apply the per-person choices and keep the days that count: ``user_id, day``, measures.

    The window runs over pre-aggregated rows, at most one per person, day and candidate.
    """
    person = Window.partitionBy("user_id")
    order = table = None
    if "table_position" in rows.columns:
        table = F.col("table_position")
        order = table * 10
    if "time_position" in rows.columns:
        time = F.coalesce("time_position", F.lit(9))
        order = time if order is None else order + time

    chosen: dict[str, Column] = {}
    if order is not None:
        chosen["_order"] = order
        chosen["_best"] = F.min(order).over(person)
    for name in [c for c in rows.columns if c.startswith("has__")]:
        if table is None:
            chosen[name] = F.max(name).over(person)
        else:
            # in the person's first table only: the smallest (table, not filled) pair decides
            pair = table * 2 + F.when(F.col(name), 0).otherwise(1)
            chosen[name] = F.min(pair).over(person) % 2 == 0
    settled = rows.repartition("user_id").withColumns(chosen) if chosen else rows

    keep = F.col("day").isNotNull()
    if order is not None:
        keep = keep & (F.col("_order") == F.col("_best"))
    found = {c: F.col(c) for c in settled.columns}
    result = settled.where(keep & any_filled(found, source)).select(
        "user_id", "day", *[settled_value(found, source, m).alias(m) for m in source.measures])
    if source.needs_value:
        result = result.where(F.col(source.needs_value).isNotNull())
    return result


def settled_value(found: dict[str, Column], source: Source, measure: str) -> Column:
    """The value of a measure; ``found`` holds the aggregates and the settled flags by name."""
    choices = []
    for i, column in enumerate(source.measures[measure]):
        name = f"{measure}__{i}"
        if name in found:
            # no flag: the only choice in its table
            filled = found.get(flag_name(source, column), found[name].isNotNull())
            choices.append((F.lit(True) if column is ALWAYS else filled, found[name]))
    value = first_filled(choices).cast("double")
    return F.coalesce(value, F.lit(0.0)) if measure in source.zero_if_null else value


def any_filled(found: dict[str, Column], source: Source) -> Column:
    """Whether the person has any of the columns the source needs."""
    filled = F.lit(not source.needs_any)
    for column in source.needs_any:
        if flag_name(source, column) in found:
            filled = filled | F.coalesce(found[flag_name(source, column)], F.lit(False))
    return filled


def _settle_tables(make, tables: Sequence[DataFrame], source: Source) -> DataFrame:
    if len(tables) == 1:
        return settle(pre_aggregate(make(tables[0])), source)
    rows = pre_aggregate(make(tables[0], True), 0)
    for i, table in enumerate(tables[1:], start=1):
        rows = rows.unionByName(pre_aggregate(make(table, True), i), allowMissingColumns=True)
    return settle(rows, source)


def stage_percent(minutes: Column, total: Column, ever_seen: Column) -> Column:
    """A stage's share of the night; 0 if the person never shows the stage."""
    share = F.try_divide(minutes, total) * F.lit(100.0)
    return F.when(ever_seen, round_half_even(share, 1)).otherwise(F.lit(0.0))


def night_total(minutes: Sequence[Column]) -> Column:
    return reduce(lambda x, y: x + y, minutes)


def stage_shares(nights: DataFrame) -> DataFrame:
    """Turn stage minutes into percent of the night."""
    person = Window.partitionBy("user_id")
    total = night_total([F.col(name) for name in STAGE_MINUTES])
    return nights.withColumn("_total", total).select("user_id", "day", *[
        stage_percent(F.col(minutes), F.col("_total"), F.max(seen).over(person).isNotNull()).alias(f"{stage}_pct")
        for stage, minutes, seen in zip(STAGES, STAGE_MINUTES, STAGE_SEEN)])


def daily_resting_hr(heart_rate: DataFrame) -> DataFrame:
    """Lowest and mean heart rate of each calendar day."""
    return settle(pre_aggregate(heart_rate_records(heart_rate)), HEART_RATE)


def daily_steps(*tables: DataFrame) -> DataFrame:
    """Largest report per day, from the first of ``tables`` in which the person has rows."""
    return _settle_tables(step_records, tables, STEPS)


def nightly_sleep(*tables: DataFrame) -> DataFrame:
    """Minutes, efficiency, score and midpoint per wake day."""
    return _settle_tables(sleep_records, tables, SLEEP)


def nightly_stages(sleep_stage: DataFrame) -> DataFrame:
    """Share of each sleep stage per wake day, in percent."""
    return stage_shares(settle(pre_aggregate(stage_records(sleep_stage)), SLEEP_STAGE))


def daily_stress(stress: DataFrame) -> DataFrame:
    return settle(pre_aggregate(stress_records(stress)), STRESS)


def daily_spo2(spo2: DataFrame) -> DataFrame:
    return settle(pre_aggregate(spo2_records(spo2)), SPO2)


def body_series(*tables: DataFrame) -> DataFrame:
    return _settle_tables(body_records, tables, BODY)
