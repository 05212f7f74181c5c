"""Choosing among candidate columns and tables, once per person.

Exports name the same fact differently, so a person's data may sit in ``steps`` or in
``step_count``, in ``start_time`` or in ``create_time``. A candidate counts for a person when
any of that person's rows fills it, and the first such candidate is used for *all* their rows.

The choice is made after the rows were aggregated per day: a row is tagged with the position of
its first filled candidate, and later only the groups with the person's smallest position stay.
Raw rows are therefore never collected per person.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitalgrid.functions.clean import as_time


def present(df: DataFrame, candidates: Sequence[str]) -> list[tuple[int, str]]:
    """The candidates that are columns of ``df``, with their position."""
    return [(i, name) for i, name in enumerate(candidates) if name in df.columns]


def first_filled(found: Sequence[tuple[Column, Column]]) -> Column:
    """``(test, value)`` pairs as one CASE: the value of the first pair whose test holds."""
    if not found:
        return F.lit(None)
    case = F
    for test, value in found:
        case = case.when(test, value)
    return case


def position_of(df: DataFrame, candidates: Sequence[str]) -> Column:
    """Position of the row's first filled candidate; null if it fills none."""
    return first_filled(
        [(F.col(c).isNotNull(), F.lit(i)) for i, c in present(df, candidates)]).cast("int")


def time_of(df: DataFrame, candidates: Sequence[str]) -> Column:
    """Time in the row's first filled candidate. An unreadable text there gives null."""
    return first_filled(
        [(F.col(c).isNotNull(), as_time(df, c)) for _, c in present(df, candidates)]
    ).cast("timestamp_ntz")


def value_of(df: DataFrame, candidates: Sequence[str], read) -> Column:
    """``read(df, column)`` of the row's first filled candidate, as double."""
    return first_filled(
        [(F.col(c).isNotNull(), read(df, c)) for _, c in present(df, candidates)]).cast("double")
