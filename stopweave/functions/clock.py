"""Time of day as whole seconds since midnight of the service day.

Service days run past midnight, so ``25:10:00`` is a valid time of day.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def seconds_of_day(text: Column) -> Column:
    """``H:mm:ss`` to seconds; null where the text is not a time."""
    part = F.split(text, ":")
    hours, minutes, seconds = (F.try_element_at(part, F.lit(i)).try_cast("bigint") for i in (1, 2, 3))
    valid = (F.size(part) == 3) & (hours >= 0) & minutes.between(0, 59) & seconds.between(0, 59)
    return F.when(valid, hours * 3600 + minutes * 60 + seconds)


def time_text(seconds: Column) -> Column:
    """Seconds of day to ``HH:mm:ss``."""
    whole = seconds.cast("bigint")
    return F.format_string(
        "%02d:%02d:%02d",
        F.floor(whole / 3600),
        F.floor(F.pmod(whole, F.lit(3600)) / 60),
        F.pmod(whole, F.lit(60)),
    )


def hour_of_day(seconds: Column) -> Column:
    """Hour of the service day; 24 and up for times past midnight."""
    return F.floor(seconds / 3600).cast("int")


def minutes_between(earlier: Column, later: Column) -> Column:
    """Minutes from ``earlier`` to ``later``, -1 unless time moves forward."""
    return F.when(later > earlier, (later - earlier) / F.lit(60.0)).otherwise(F.lit(-1.0))
