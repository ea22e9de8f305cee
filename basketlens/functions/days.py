"""Integer-day windows: features look strictly back, outcomes look forward.

A day is an ordered integer, never a calendar date.  Feature windows are
``[cutoff - lookback, cutoff)`` and outcome windows ``[cutoff, cutoff + length)``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def check_day(value: object, name: str = "cutoff") -> int:
    if isinstance(value, bool) or not isinstance(value, int):
        raise ValueError(f"{name} must be an integer day index, got {value!r}")
    return value


def check_length(value: object, name: str) -> int:
    if check_day(value, name) <= 0:
        raise ValueError(f"{name} must be a positive number of days, got {value!r}")
    return value


def feature_bounds(cutoff: int, lookback: int | None = None) -> tuple[int | None, int]:
    """Inclusive lower bound (``None`` = unbounded) and exclusive upper bound."""
    check_day(cutoff)
    if lookback is None:
        return None, cutoff
    return cutoff - check_length(lookback, "lookback"), cutoff


def outcome_bounds(cutoff: int, length: int) -> tuple[int, int]:
    return check_day(cutoff), cutoff + check_length(length, "outcome window")


def between_days(day: Column, lower: int | Column | None, upper: int | Column) -> Column:
    """``lower <= day < upper``; a missing lower bound leaves the window open."""
    upper_ok = day < upper
    return upper_ok if lower is None else upper_ok & (day >= lower)


def in_feature_window(df: DataFrame, cutoff: int, lookback: int | None = None,
                      day: str = "DAY") -> DataFrame:
    return df.where(between_days(F.col(day), *feature_bounds(cutoff, lookback)))


def in_outcome_window(df: DataFrame, cutoff: int, length: int, day: str = "DAY") -> DataFrame:
    return df.where(between_days(F.col(day), *outcome_bounds(cutoff, length)))


def before_start(day: Column, start: Column, lookback: int) -> Column:
    """The lookback window of another table's start day: ``[start - n, start)``."""
    return between_days(day, start - check_length(lookback, "lookback"), start)


def within_interval(day: Column, start: Column, end: Column) -> Column:
    """Campaign intervals include both of their end days."""
    return day.between(start, end)
