"""Row rules of the dashboard: bands, KPI direction, durations (fixed values)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NO_VALUE = "–"
STATUS_BANDS = (
    (75.0, "Výborné zotavenie"),
    (55.0, "Dobré zotavenie"),
    (40.0, "Priemerné"),
)
STATUS_LOWEST = "Nízke — oddýchni si"
FLAT_DELTA = 0.5
ACWR_SWEET_SPOT = (0.8, 1.3)
ACWR_OVERREACH = 1.5


def status_band(score: Column) -> Column:
    band = F.when(score.isNull(), NO_VALUE)
    for lower, label in STATUS_BANDS:
        band = band.when(score >= lower, label)
    return band.otherwise(STATUS_LOWEST)


def kpi_direction(delta: Column, better: Column) -> Column:
    """``up`` is an improvement, ``down`` a decline, ``flat`` neither."""
    improved = F.when(better == "lower", delta < 0).otherwise(delta > 0)
    return (
        F.when(delta.isNull() | (F.abs(delta) <= FLAT_DELTA) | (better == "neutral"), "flat")
        .when(improved, "up")
        .otherwise("down")
    )


def acwr_band(acwr: Column) -> Column:
    low, high = ACWR_SWEET_SPOT
    return (
        F.when(acwr.isNull(), NO_VALUE)
        .when(acwr < low, "under")
        .when(acwr <= high, "sweet spot")
        .when(acwr <= ACWR_OVERREACH, "above")
        .otherwise("overreach")
    )


def duration_text(minutes: Column) -> Column:
    """``h:mm`` of the minutes, rounded before they are split so that 479.6 is 8:00."""
    whole = F.floor(minutes + 0.5)
    text = F.concat(
        F.floor(whole / 60).cast("string"), F.lit(":"),
        F.lpad(F.pmod(whole, F.lit(60)).cast("string"), 2, "0"),
    )
    return F.coalesce(text, F.lit(NO_VALUE))
