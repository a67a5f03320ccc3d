"""Processing days: validation, file-name tokens, and which days a write produced."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

Day = date | str

# The name Spark gives to the partition directory of a NULL value.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def parse_day(day: Day) -> date:
    """A ``YYYY-MM-DD`` day; anything else raises here, before any data is read."""
    if isinstance(day, date):
        return date(day.year, day.month, day.day)
    if len(day) != 10:
        raise ValueError(f"day must be YYYY-MM-DD, got {day!r}")
    return date.fromisoformat(day)


def parse_days(days: Day | Iterable[Day]) -> list[date]:
    """One day or many, as a sorted list without repeats; none at all raises."""
    if isinstance(days, (str, date)):
        days = [days]
    parsed = sorted({parse_day(d) for d in days})
    if not parsed:
        raise ValueError("no days given")
    return parsed


def file_token(day: Day) -> str:
    """``2025-04-15`` as it is written in file names: ``2025_04_15``."""
    return parse_day(day).isoformat().replace("-", "_")


def on_days(column: Column, days: Iterable[date | None]) -> Column:
    """Membership in a set of days in which None stands for the NULL date."""
    days = list(days)
    known = [d for d in days if d is not None]
    match = column.isin(known)
    return match | column.isNull() if None in days else match


def presence(column: Column, days: list[date]) -> Column:
    """Aggregate: those of the days that occur, as a set.

    It holds at most one value per day asked for, and a retried task cannot spoil it.
    """
    return F.collect_set(F.when(column.isin(days), column))
