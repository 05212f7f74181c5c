"""All daily and nightly aggregates and the daily load at once, in two shuffles.

The rows of all record tables become one tagged union. What a table aggregates lies in slots that the tables share
(``sum0``, ``max0``, ``max1``, ...), so the union stays narrow however many tables there are. It is aggregated by
person, source, day and candidate, with partial sums before the shuffle, then moved once more by person. Choices among
columns and tables, the median resting heart rate, shares of stages and training loads are windows and expressions
over those rows, and the merge to one row per person and day moves nothing.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vitalgrid.functions.codes import STAGES
from vitalgrid.operators import daily as d
from vitalgrid.operators import load as l
from vitalgrid.operators.candidates import position_of, present
from vitalgrid.params import MetricParams

#: makers of the sources of one table, and of those that several tables may hold, in order of preference
SINGLE = {
    "heart_rate": d.heart_rate_records, "sleep_stage": d.stage_records,
    "stress": d.stress_records, "spo2": d.spo2_records,
}
SEVERAL = {
    "steps": (d.STEP_TABLES, d.step_records), "sleep": (d.SLEEP_TABLES, d.sleep_records),
    "body": (d.BODY_TABLES, d.body_records),
}
WORKOUT = "exercise"
#: position of a row that fills no time column
NO_TIME = 9
#: an order is the position of the table times this, plus that of the time column
TABLE_STEP = 10
#: workouts are also told apart by heart rate, as their load is linear in minutes only
WORKOUT_KEYS = ("_mean_hr", "_hr_position")


class _Slots:
    """Which shared column holds which aggregate of a source, and which flag."""

    def __init__(self):
        self.used: dict[str, str] = {}
        self.of: dict[str, dict[str, str]] = {}

    def column(self, source: str, name: str, how: str) -> str:
        held = self.of.setdefault(source, {})
        if name not in held:
            number = sum(slot.startswith(how) for slot in held.values())
            held[name] = f"{how}{number}"
            self.used[held[name]] = how
        return held[name]


def _records_of(tables: dict[str, DataFrame]) -> list[tuple[d.Records, int]]:
    """The records of the tables at hand, with the position of their table among those of the source."""
    found = [(make(tables[name]), 0) for name, make in SINGLE.items() if name in tables]
    for names, make in SEVERAL.values():
        held = [tables[name] for name in names if name in tables]
        found += [(make(table, len(held) > 1), i) for i, table in enumerate(held)]
    return found


def _tagged(records: d.Records, position: int, slots: _Slots) -> tuple[DataFrame, dict[str, Column]]:
    name = records.source.name
    order = F.lit(0)
    if len(present(records.rows, records.times)) > 1:
        order = F.coalesce(position_of(records.rows, records.times), F.lit(NO_TIME))
    cells = {slots.column(name, value, how): x.cast("double") for value, (how, x) in records.values.items()}
    cells |= {slots.column(name, flag, "flag"): filled for flag, filled in records.flags.items()}
    return records.rows, {
        "_source": F.lit(name), "day": records.day, "_order": F.lit(position * TABLE_STEP) + order, **cells}


def _tagged_workouts(exercise: DataFrame, slots: _Slots) -> tuple[DataFrame, dict[str, Column]]:
    cells = {slots.column(WORKOUT, name, "sum"): l.positive_only(name) for name in ("_minutes", "_span")}
    cells[slots.column(WORKOUT, "_any_duration", "flag")] = F.col("_has_duration")
    return l.workout_rows(exercise), {
        "_source": F.lit(WORKOUT), "day": F.col("_day"), "_order": F.coalesce("_time_position", F.lit(NO_TIME)),
        **{key: F.col(key) for key in WORKOUT_KEYS}, **cells}


def _long_rows(tables: dict[str, DataFrame], records: list, slots: _Slots) -> DataFrame:
    """The aggregated union: one row per person, source, day and candidate (workouts: and heart rate)."""
    parts = [_tagged(r, position, slots) for r, position in records]
    extra: tuple[str, ...] = ()
    if WORKOUT in tables:
        parts.append(_tagged_workouts(tables[WORKOUT], slots))
        extra = WORKOUT_KEYS
    types = {slot: "boolean" if how == "flag" else "double" for slot, how in slots.used.items()}
    types |= dict(zip(extra, ("double", "int")))
    union = reduce(DataFrame.unionByName, [
        rows.where("user_id is not null").select(
            "user_id", *[cells[c].alias(c) for c in ("_source", "day", "_order")],
            *[cells.get(c, F.lit(None)).cast(kind).alias(c) for c, kind in types.items()])
        for rows, cells in parts])
    how = {**d.HOW, "flag": F.max}
    return union.groupBy("user_id", "_source", "day", "_order", *extra).agg(
        *[how[kind](slot).alias(slot) for slot, kind in slots.used.items()])


def daily_rows(
    tables: dict[str, DataFrame], params: MetricParams, profiles: DataFrame | None,
) -> tuple[DataFrame, dict[str, str]]:
    """One row per person and day, partitioned by person, with the columns of each source in a struct named after
    it and the ``load``; and where each output column lies."""
    slots = _Slots()
    records = _records_of(tables)
    sources = {r.source.name: r.source for r, _ in records}
    long = _long_rows(tables, records, slots)

    # choices: smallest order, and for each flag the smallest pair of table and "not filled"
    own = Window.partitionBy("user_id", "_source")
    table = F.floor(F.col("_order") / TABLE_STEP)
    chosen = {"_best": F.min("_order").over(own)}
    for slot, kind in slots.used.items():
        if kind == "flag":
            chosen[slot] = F.min(table * 2 + F.when(F.col(slot), 0).otherwise(1)).over(own) % 2 == 0
    if WORKOUT in tables:
        chosen["_best_hr"] = F.min("_hr_position").over(own)
    rows = long.repartition("user_id").withColumns(chosen).where("day is not null and _order = _best")

    found = {name: {value: F.col(slot) for value, slot in held.items()} for name, held in slots.of.items()}
    values = {
        name: {m: d.settled_value(found[name], source, m) for m in source.measures} for name, source in sources.items()}

    def of(name: str, x: Column) -> Column:
        counts = (F.col("_source") == name) & d.any_filled(found[name], sources[name])
        needed = sources[name].needs_value
        return F.when(counts if needed is None else counts & values[name][needed].isNotNull(), x)

    # what depends on all kept rows of a person
    person = Window.partitionBy("user_id")
    stages, heart = d.SLEEP_STAGE.name, d.HEART_RATE.name
    overall = {}
    if stages in sources:
        overall |= {f"_{seen}": F.max(of(stages, values[stages][seen])).over(person) for seen in d.STAGE_SEEN}
    if WORKOUT in tables and heart in sources and params.hr_rest is None:
        overall["_median_hr"] = F.percentile(of(heart, values[heart]["resting_hr"]), F.lit(0.5)).over(person)
    if overall:
        rows = rows.withColumns(overall)
    if stages in sources:
        total = d.night_total([values[stages][m] for m in d.STAGE_MINUTES])
        values[stages] = {
            f"{stage}_pct": d.stage_percent(values[stages][minutes], total, F.col(f"_{seen}").isNotNull())
            for stage, minutes, seen in zip(STAGES, d.STAGE_MINUTES, d.STAGE_SEEN)}

    merged = [F.max(of(name, F.struct(*[x.alias(m) for m, x in values[name].items()]))).alias(name) for name in sources]
    if WORKOUT in tables:
        rows = l.with_profile(rows, params, profiles)
        held = found[WORKOUT]
        minutes = F.when(held["_any_duration"], held["_minutes"]).otherwise(held["_span"])
        mean_hr = F.when(F.col("_hr_position") == F.col("_best_hr"), F.col("_mean_hr"))
        load = l.trimp(mean_hr, minutes, F.col("_hr_rest"), F.col("_hr_max"), F.col("_sex"))
        merged.append(F.sum(F.when(F.col("_source") == WORKOUT, load)).alias("load"))
    columns = {m: f"{name}.{m}" for name in sources for m in values[name]} | ({"load": "load"} if WORKOUT in tables else {})
    return rows.groupBy("user_id", "day").agg(*merged), columns
