"""Integer codes of the export and their names (fixed values)."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

EXERCISE_NAMES = {
    1001: "Chôdza",
    1002: "Beh",
    11007: "Bicykel",
    13001: "Túra",
    14001: "Plávanie",
    15006: "Posilňovňa",
    0: "Tréning",
}
OTHER_EXERCISE = "Tréning"

STAGES = ("awake", "light", "deep", "rem")
STAGE_NAMES = {
    1: "awake", 2: "light", 3: "deep", 4: "rem",
    40001: "awake", 40002: "light", 40003: "deep", 40004: "rem",
}
OTHER_STAGE = "light"


def _lookup(code: Column, names: dict[int, str], key: Column) -> Column:
    literals = F.create_map(*[F.lit(v) for v in chain.from_iterable(names.items())])
    return F.try_element_at(literals, key)


def exercise_name(code: Column) -> Column:
    """Codes are truncated to whole numbers first."""
    return F.coalesce(_lookup(code, EXERCISE_NAMES, code.try_cast("int")), F.lit(OTHER_EXERCISE))


def stage_name(code: Column) -> Column:
    """Only whole codes count; everything else is light sleep."""
    whole = F.when(code == F.floor(code), code.try_cast("int"))
    return F.coalesce(_lookup(code, STAGE_NAMES, whole), F.lit(OTHER_STAGE))
