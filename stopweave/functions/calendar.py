"""Calendar and rush-hour features of a date and an hour."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# These define the features the models are trained on.
RUSH_HOURS = (6, 7, 11, 12, 17, 18)
NOON, EVENING = 12, 18
HOLIDAY_MONTHS = (1, 6, 7, 12)
WEEKEND = ("Sat", "Sun")
REGULAR_DAYS = ("Tue", "Wed", "Thu")


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it does not or is null."""
    return F.coalesce(condition.cast("int"), F.lit(0))


def is_rush(hour: Column) -> Column:
    return flag(hour.isin(*RUSH_HOURS))


def period_of_day(hour: Column) -> Column:
    """morning, afternoon or night; an unknown hour counts as night."""
    return (
        F.when(hour < NOON, "morning").when(hour < EVENING, "afternoon").otherwise("night")
    )


def week_day(date: Column) -> Column:
    return F.date_format(date, "E")


def is_holiday(date: Column) -> Column:
    return flag(F.month(date).isin(*HOLIDAY_MONTHS))


def is_weekend(date: Column) -> Column:
    return flag(week_day(date).isin(*WEEKEND))


def is_regular_day(date: Column) -> Column:
    return flag(week_day(date).isin(*REGULAR_DAYS))
