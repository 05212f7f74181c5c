"""``metrics_daily``: one wide row per person and day, from all record tables."""

from __future__ import annotations

import json
from collections.abc import Iterable
from dataclasses import asdict
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalgrid.operators import daily as d
from vitalgrid.operators import timeline as t
from vitalgrid.operators.assembly import daily_rows
from vitalgrid.params import DEFAULT_PARAMS, MetricParams
from vitalgrid.plans.queries import days_of, in_range
from vitalgrid.sources.tables import Commit, committed, read_table

METRICS_TABLE = "metrics_daily"
#: profiles the stored metrics were built with, and each person's newest day; not listed among the tables
PROFILES_TABLE, NEWEST_TABLE = "_metrics_profiles", "_metrics_newest"
#: column the stored metrics are partitioned by
MONTH = "month"
DAILY_TABLES = (
    "heart_rate", "sleep_stage", "stress", "spo2", *d.STEP_TABLES, *d.SLEEP_TABLES, *d.BODY_TABLES)
# Names of the output columns.
RAW_COLUMNS = (
    "resting_hr", "hr_avg", "steps", "active_minutes", "calories",
    "sleep_minutes", "sleep_efficiency", "sleep_score", "sleep_midpoint",
    "awake_pct", "light_pct", "deep_pct", "rem_pct", "stress_avg", "spo2_min", "spo2_avg",
    "weight", "body_fat", "skeletal_muscle", "muscle_mass", "bmi",
)
METRIC_COLUMNS = (
    *RAW_COLUMNS, "load", "load_acute", "load_chronic", "acwr", "sleep_debt", "sleep_regularity",
    "weight_ffill", "weight_delta_7d", "weight_delta_30d", "rhr_baseline",
    "rhr_score", "sleep_score_c", "stress_score", "acwr_score", "readiness",
)


def daily_frame(
    tables: dict[str, DataFrame],
    params: MetricParams = DEFAULT_PARAMS,
    profiles: DataFrame | None = None,
) -> DataFrame:
    """Dense daily rows with every raw column and the daily load.

    Two shuffles, of rows aggregated by person and day and of those by person (see
    :mod:`vitalgrid.operators.assembly`). Dense days and rolling windows keep the partitioning.
    """
    merged, columns = daily_rows(tables, params, profiles)
    names = [c for c in merged.columns if c not in ("user_id", "day", "load")]
    spans = reduce(lambda x, y: x | y, [F.col(name).isNotNull() for name in names])
    dense = t.dense_days(merged, spans)
    return dense.select("user_id", "day", *[
        (F.col(columns[c]) if c in columns else F.lit(None).cast("double")).alias(c)
        for c in (*RAW_COLUMNS, "load")])


def build_daily_metrics(
    tables: dict[str, DataFrame],
    params: MetricParams = DEFAULT_PARAMS,
    profiles: DataFrame | None = None,
) -> DataFrame:
    """All daily metrics of all persons. ``tables`` maps table names to record tables with a
    ``user_id``; missing tables leave their columns null.

    ``profiles`` may hold one row per person ``(user_id, sex, hr_max, hr_rest,
    target_sleep_min)``; its nulls, and persons without a row, use ``params``. Days come from the
    daily tables only, so without any of those the result is empty.
    """
    if not set(tables) & set(DAILY_TABLES):
        return _no_metrics(next(iter(tables.values())))
    daily = daily_frame(tables, params, profiles)
    target = F.lit(float(params.target_sleep_min))
    if profiles is not None:
        own = profiles.select("user_id", F.col("target_sleep_min").cast("double").alias("_target"))
        daily = daily.join(own, "user_id", "left")
        target = F.coalesce("_target", target)
    # all of these share one window pass; only the back-fill needs the days in reverse
    metrics = daily.withColumn("load", F.coalesce("load", F.lit(0.0))).withColumns({
        "load_acute": t.mean_load(params.acute_days),
        "load_chronic": t.mean_load(params.chronic_days),
        "sleep_debt": t.sleep_debt(F.col("sleep_minutes"), target, params.sleep_debt_window),
        "sleep_regularity": t.sleep_regularity(F.col("sleep_midpoint"), params.regularity_window),
        "rhr_baseline": t.rolling_median(F.col("resting_hr"), params.rhr_baseline_window),
        **t.weight_columns(),
        **t.presence_flags(),
    }).withColumns({
        "acwr": F.try_divide("load_acute", "load_chronic"),
        "rhr_baseline": t.next_known(F.col("rhr_baseline")),
    })
    metrics = t.readiness_scores(metrics, target)
    return metrics.select("user_id", "day", *METRIC_COLUMNS)


def _no_metrics(table: DataFrame) -> DataFrame:
    return table.where("false").select(
        "user_id", F.lit(None).cast("date").alias("day"),
        *[F.lit(None).cast("double").alias(c) for c in METRIC_COLUMNS])


def _digest(profiles: DataFrame | None) -> str | None:
    if profiles is None:
        return None
    columns = sorted(profiles.columns)
    return profiles.agg(F.sum(F.xxhash64(*[F.col(c).cast("string") for c in columns]).cast("decimal(38,0)"))
                        .cast("string").alias("d")).first()["d"]


def _built_with(spark: SparkSession, root: str) -> tuple[MetricParams, str | None]:
    """Parameters, and the profiles' digest, that the stored metrics were built with."""
    row = committed(spark, root).get(METRICS_TABLE)
    if row is None or row["about"] is None:
        return DEFAULT_PARAMS, None
    about = json.loads(row["about"])
    return MetricParams(**about["params"]), about["profiles"]


def write_metrics(
    spark: SparkSession, root: str, params: MetricParams | None = None, profiles: DataFrame | None = None,
    changed: DataFrame | None = None, buckets: Iterable[int] | None = None,
) -> None:
    """Build ``metrics_daily`` from the stored tables and replace it, by month of the day.

    Parameters and profiles that are not given stay those of the last build (at first the defaults and
    none). They, the metrics and each person's newest day are one commit. If only some persons have
    ``changed`` (``user_id``, all in ``buckets``), theirs alone are built and the other stored days are kept.
    """
    last_params, last_profiles = _built_with(spark, root)
    params = params or last_params
    own = read_table(spark, root, PROFILES_TABLE) if profiles is None else profiles
    stored = read_table(spark, root, METRICS_TABLE)
    some = changed is not None and stored is not None and params == last_params and _digest(own) == last_profiles
    names = [name for name in committed(spark, root) if not name.startswith("_") and name != METRICS_TABLE]
    tables = {name: read_table(spark, root, name, buckets=buckets if some else None) for name in names}
    if some:
        tables = {name: table.join(changed, "user_id", "left_semi") for name, table in tables.items()}
    metrics = build_daily_metrics(tables, params, own)
    if some:
        metrics = metrics.unionByName(stored.drop(MONTH).join(changed, "user_id", "left_anti"))
    metrics = metrics.withColumn(MONTH, _month(F.col("day")))
    with Commit(spark, root) as commit:
        about = json.dumps({"params": asdict(params), "profiles": _digest(own)})
        commit.write(metrics.hint("rebalance", MONTH), METRICS_TABLE, [MONTH], about)
        written = commit.reread(METRICS_TABLE, metrics.schema)
        commit.write(written.groupBy("user_id").agg(F.max("day").alias("newest")), NEWEST_TABLE)
        if profiles is not None:
            commit.write(profiles, PROFILES_TABLE)


def _month(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def _ensure_metrics(spark, root, params, profiles) -> None:
    built_params, built_profiles = _built_with(spark, root)
    if read_table(spark, root, METRICS_TABLE) is None or params not in (None, built_params) or (
            profiles is not None and _digest(profiles) != built_profiles):
        write_metrics(spark, root, params, profiles)


def load_metrics(
    spark: SparkSession, root: str, params: MetricParams | None = None, profiles: DataFrame | None = None,
) -> DataFrame:
    """The stored ``metrics_daily``; built and stored first if it does not exist or was built with other
    parameters or profiles than those given."""
    _ensure_metrics(spark, root, params, profiles)
    return read_table(spark, root, METRICS_TABLE).drop(MONTH)


def load_range(
    spark: SparkSession, root: str, range_name: str, params: MetricParams | None = None, profiles: DataFrame | None = None,
) -> DataFrame:
    """As ``load_metrics``, the days of a range only, counted from each person's newest day.

    Only the months in which someone's range lies are read; their names come from the table of newest days,
    one row a person. The days are then cut by an equi-join with that table, without a window over the
    history. Give the result to the queries with the range ``all``.
    """
    length = days_of(range_name)
    metrics = load_metrics(spark, root, params, profiles)
    if length is None:
        return metrics
    newest = read_table(spark, root, NEWEST_TABLE)
    if newest is None:  # stored by others: no months, no newest days
        return in_range(metrics, range_name)
    first = F.date_sub("newest", length - 1)
    months = newest.where("newest is not null").select(F.explode(F.sequence(
        F.trunc(first, "MM"), F.trunc("newest", "MM"), F.expr("interval 1 month"))).alias("m")).select(_month(F.col("m"))).distinct()
    # as many as there are months in the data
    stored = read_table(spark, root, METRICS_TABLE).where(F.col(MONTH).isin([r[0] for r in months.collect()]))
    since = newest.select(F.col("user_id").alias("_person"), first.alias("_first"))
    return stored.join(since, F.col("user_id").eqNullSafe(F.col("_person"))).where("day >= _first").select(metrics.columns)
