"""Operators along a person's days.

A person has at most one row per day, and days outside 1970-2200 are dropped when times are
parsed. A person's window therefore never exceeds about 84,000 rows, however many raw records
the person has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from vitalgrid.functions.clean import clip, round_half_even
from vitalgrid.params import READINESS_WEIGHTS

#: fewest readings for a baseline or a regularity
FEWEST = 3


def days() -> WindowSpec:
    """A person's days in order. All windows share this, but for the back-fill."""
    return Window.partitionBy("user_id").orderBy("day")


def all_days() -> WindowSpec:
    return days().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)


def last_days(n: int) -> WindowSpec:
    return days().rowsBetween(-(n - 1), Window.currentRow)


def dense_days(daily: DataFrame, spans: Column | None = None) -> DataFrame:
    """Add the missing days between a person's first and last day, with nulls.

    ``spans`` marks the rows that set the first and last day; others outside are dropped. Each
    row is repeated up to the day before the next one, so no calendar has to be joined.
    """
    values = [c for c in daily.columns if c not in ("user_id", "day")]
    spanning = F.col("day") if spans is None else F.when(spans, F.col("day"))
    bounded = daily.withColumns({
        "_first": F.min(spanning).over(all_days()),
        "_last": F.max(spanning).over(all_days()),
        "_next": F.lead("day").over(days()),
    }).where("day between _first and _last")
    until = F.coalesce(F.least(F.date_sub("_next", 1), F.col("_last")), F.col("day"))
    filled = bounded.withColumn("_day", F.explode(F.sequence(F.col("day"), until)))
    return filled.selectExpr(
        "user_id", "_day as day", *[f"if(_day = day, `{c}`, null) as `{c}`" for c in values])


def mean_load(window: int) -> Column:
    return F.avg("load").over(last_days(window))


def load_balance(daily: DataFrame, acute_days: int = 7, chronic_days: int = 28) -> DataFrame:
    """Acute and chronic load and their ratio; ``daily`` is dense and has ``load``."""
    return (
        daily.withColumn("load", F.coalesce("load", F.lit(0.0)))
        .withColumns({"load_acute": mean_load(acute_days), "load_chronic": mean_load(chronic_days)})
        .withColumn("acwr", F.try_divide("load_acute", "load_chronic"))
    )


def sleep_debt(minutes: Column, target: Column, window: int = 14) -> Column:
    return F.sum(target - minutes).over(last_days(window))


def _if_enough(x: Column, result: Column, window: int) -> Column:
    return F.when(F.count(x).over(last_days(window)) >= FEWEST, result.over(last_days(window)))


def sleep_regularity(midpoint: Column, window: int = 7) -> Column:
    return _if_enough(midpoint, F.stddev_samp(midpoint), window)


def rolling_median(x: Column, window: int = 30) -> Column:
    return _if_enough(x, F.percentile(x, F.lit(0.5)), window)


def next_known(x: Column) -> Column:
    """The value itself or the next one that is not null.

    The days are walked in reverse, which costs one sort but stays linear; a frame that reaches
    forward from every row would be quadratic.
    """
    backwards = Window.partitionBy("user_id").orderBy(F.col("day").desc()) \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return F.last(x, ignorenulls=True).over(backwards)


def resting_baseline(daily: DataFrame, window: int = 30) -> DataFrame:
    """Rolling median of the resting heart rate; days before it is known take the next one."""
    return daily.withColumn("rhr_baseline", rolling_median(F.col("resting_hr"), window)) \
        .withColumn("rhr_baseline", next_known(F.col("rhr_baseline")))


def last_known(name: str, days_ago: int = 0) -> Column:
    """The newest non-null value as of some rows ago."""
    return F.last(name, ignorenulls=True).over(
        days().rowsBetween(Window.unboundedPreceding, -days_ago))


def weight_columns() -> dict[str, Column]:
    """Last known weight and its change over 7 and 30 days."""
    now = last_known("weight")
    return {
        "weight_ffill": now,
        "weight_delta_7d": now - last_known("weight", 7),
        "weight_delta_30d": now - last_known("weight", 30),
    }


def weight_trend(daily: DataFrame) -> DataFrame:
    return daily.withColumns(weight_columns())


def rhr_score(resting: Column, baseline: Column) -> Column:
    return clip(F.lit(50.0) + (baseline - resting) * F.lit(4.0))


def sleep_score(score: Column, minutes: Column, target: Column, has_score: Column) -> Column:
    """The device's score if the person has any, else the share of the target slept."""
    return F.when(has_score, clip(score)).otherwise(clip(minutes / target * F.lit(100.0)))


def stress_score(stress: Column) -> Column:
    return clip(F.lit(100.0) - stress)


def acwr_score(ratio: Column) -> Column:
    """100 between 0.8 and 1.3, less on either side."""
    short = F.greatest(F.lit(0.0), F.lit(0.8) - ratio) * F.lit(250.0)
    beyond = F.greatest(F.lit(0.0), ratio - F.lit(1.3)) * F.lit(120.0)
    return F.when(ratio.isNotNull(), clip(F.lit(100.0) - short - beyond))


def weighted_mean(has: dict[str, Column], weights: dict[str, float] = READINESS_WEIGHTS) -> Column:
    """Weighted mean of the components the person has; null on a day that lacks one of them."""
    total = F.lit(0.0)
    for name, weight in weights.items():
        total = total + F.when(has[name], F.lit(weight)).otherwise(F.lit(0.0))
    score = F.lit(0.0)
    for name, weight in weights.items():
        share = F.try_divide(F.lit(weight), total)
        score = score + F.when(has[name], F.col(name) * share).otherwise(F.lit(0.0))
    any_component = F.lit(False)
    for name in weights:
        any_component = any_component | has[name]
    return F.when(any_component, score)


def ever(condition: Column) -> Column:
    """Whether the condition holds on any of the person's days."""
    return F.max(condition).over(all_days())


def presence_flags() -> dict[str, Column]:
    """Which score components the person has at all. A ratio of loads exists on some day exactly
    if some day has load."""
    return {
        "_has_resting": ever(F.col("resting_hr").isNotNull()),
        "_has_score": ever(F.col("sleep_score").isNotNull()),
        "_has_minutes": ever(F.col("sleep_minutes").isNotNull()),
        "_has_stress": ever(F.col("stress_avg").isNotNull()),
        "_has_load": ever(F.coalesce("load", F.lit(0.0)) > 0),
    }


def readiness_scores(daily: DataFrame, target: Column) -> DataFrame:
    """Add the four component scores and ``readiness``.

    ``daily`` has ``rhr_baseline`` and ``acwr`` and the columns of ``presence_flags``.
    """
    scored = daily.withColumns({
        "rhr_score": rhr_score(F.col("resting_hr"), F.col("rhr_baseline")),
        "sleep_score_c": sleep_score(
            F.col("sleep_score"), F.col("sleep_minutes"), target, F.col("_has_score")),
        "stress_score": stress_score(F.col("stress_avg")),
        "acwr_score": acwr_score(F.col("acwr")),
    })
    has = {
        "rhr_score": F.col("_has_resting"),
        "sleep_score_c": F.col("_has_score") | F.col("_has_minutes"),
        "stress_score": F.col("_has_stress"),
        "acwr_score": F.col("_has_load"),
    }
    return scored.withColumn("readiness", round_half_even(weighted_mean(has), 1)) \
        .drop(*presence_flags())
