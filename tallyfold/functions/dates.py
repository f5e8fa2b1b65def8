"""Time zone free dates from epoch seconds and timestamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_of_epoch(seconds: Column) -> Column:
    return F.date_add(F.lit("1970-01-01").cast("date"), F.floor(seconds / 86400).cast("int"))


def week_of(day: Column) -> Column:
    """The Monday of a date's week."""
    return F.date_sub(day, F.weekday(day))


def weekday_number(day: Column) -> Column:
    """1 on Monday to 7 on Sunday."""
    return F.weekday(day) + 1
