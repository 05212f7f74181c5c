"""Calculation parameters. All values here are fixed values the results depend on."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class MetricParams:
    """Profile used for every person that has no row of their own in ``profiles``."""

    sex: str = "male"
    hr_max: float = 190.0
    hr_rest: float | None = None  # None: median of the person's daily resting heart rate
    target_sleep_min: float = 480.0
    acute_days: int = 7
    chronic_days: int = 28
    rhr_baseline_window: int = 30
    sleep_debt_window: int = 14
    regularity_window: int = 7


DEFAULT_PARAMS = MetricParams()

FALLBACK_HR_REST = 60.0

#: weight of each readiness component
READINESS_WEIGHTS = {
    "rhr_score": 0.30,
    "sleep_score_c": 0.35,
    "stress_score": 0.20,
    "acwr_score": 0.15,
}

#: days covered by each range literal; None keeps everything
RANGES = {"7d": 7, "30d": 30, "90d": 90, "all": None}

#: KPI column, label, unit, which direction is good
KPIS = (
    ("resting_hr", "Pokojový HR", "bpm", "lower"),
    ("sleep_minutes", "Spánok", "h", "higher"),
    ("steps", "Kroky", "", "higher"),
    ("load", "Tréning. záťaž", "TRIMP", "neutral"),
    ("stress_avg", "Stres", "", "lower"),
    ("readiness", "Readiness", "", "higher"),
)
KPI_SPARK_POINTS = 14
KPI_PREVIOUS_POSITION = 8  # counted from the newest non-null value

#: goal column, label, target, unit
GOALS = (
    ("steps", "Kroky / deň", 10000.0, ""),
    ("sleep_minutes", "Spánok / noc", 480.0, "min"),
    ("readiness", "Readiness", 80.0, ""),
    ("acwr", "ACWR v pásme", 1.0, ""),
)
GOAL_DAYS = 7
STREAK_STEPS = 10000

CORRELATED = (
    "readiness", "resting_hr", "sleep_minutes", "sleep_debt",
    "stress_avg", "load", "steps", "acwr",
)
