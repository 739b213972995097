"""Stop-to-stop legs and the features models are trained on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stopweave.functions import calendar
from stopweave.functions.clock import hour_of_day
from stopweave.operators.columns import drop_missing, rename_columns
from stopweave.operators.ordered import LARGE_GROUP, next_row
from stopweave.schemas import SHAPE_TRIP

# Limits of the training data, in seconds and km/h.
OUTLIER_SECONDS = 1200
CLEAN_SECONDS = 1100
CLEAN_SPEED_KMH = 90
CLEAN_PROBLEMS = ("NO_PROBLEM", "BETWEEN")

# Columns that differ between the two ends of a leg: (column, at origin, at destination).
LEG_ENDS = (
    ("busStopId", "busStopIdOrig", "busStopIdDest"),
    ("timestamp_s", "timestampOrig_s", "timestampDest_s"),
    ("tripNum", "tripNumOrig", "tripNumDest"),
    ("shapeLat", "shapeLatOrig", "shapeLatDest"),
    ("shapeLon", "shapeLonOrig", "shapeLonDest"),
    ("distanceTraveledShape", "distanceTraveledShapeOrig", "distanceTraveledShapeDest"),
)


def with_stops(visits: DataFrame) -> DataFrame:
    """Records at a stop, with the stop named as the leg tables name it."""
    return drop_missing(rename_columns(visits, [("stopPointId", "busStopId")]), ["busStopId"])


def route_stops(visits: DataFrame) -> DataFrame:
    """Distinct stops of each route and shape, along the shape."""
    stops = with_stops(visits).select("route", "shapeId", "busStopId", "distanceTraveledShape")
    return stops.distinct().orderBy("route", "shapeId", "distanceTraveledShape")


def stop_to_stop(visits: DataFrame, large_group: int = LARGE_GROUP) -> DataFrame:
    """One row per hop from a stop record to the next one of the trip."""
    hops = next_row(
        with_stops(visits),
        SHAPE_TRIP,
        "timestamp_s",
        "visit_id",
        {column: dest for column, _, dest in LEG_ENDS},
        large_group,
    )
    hops = rename_columns(hops, [(column, orig) for column, orig, _ in LEG_ENDS])
    return drop_missing(hops, ["busStopIdDest"])


def leg_features(legs: DataFrame) -> DataFrame:
    """Duration (s), distance (m), speed (m/s) and pacing (s/m) of a leg."""
    duration = (F.col("timestampDest_s") - F.col("timestampOrig_s")).cast("double")
    distance = F.abs(F.col("distanceTraveledShapeDest") - F.col("distanceTraveledShapeOrig"))
    return (
        rename_columns(legs, [("ext_num_pass", "crowdedness")])
        .withColumns({"duration": duration, "distance": distance})
        .withColumns(
            {
                "speed": F.try_divide("distance", "duration"),
                "pacing": F.try_divide("duration", "distance"),
            }
        )
    )


def calendar_features(legs: DataFrame) -> DataFrame:
    """Hour, rush hour and period of both ends, and features of the date."""
    date = F.col("date")
    orig, dest = (hour_of_day(F.col(c)) for c in ("timestampOrig_s", "timestampDest_s"))
    return legs.withColumns(
        {
            "hourOrig": orig,
            "hourDest": dest,
            "isRushOrig": calendar.is_rush(orig),
            "isRushDest": calendar.is_rush(dest),
            "periodOrig": calendar.period_of_day(orig),
            "periodDest": calendar.period_of_day(dest),
            "weekDay": calendar.week_day(date),
            "weekOfYear": F.weekofyear(date),
            "dayOfMonth": F.dayofmonth(date),
            "month": F.month(date),
            "isHoliday": calendar.is_holiday(date),
            "isWeekend": calendar.is_weekend(date),
            "isRegularDay": calendar.is_regular_day(date),
        }
    )


def featured_legs(visits: DataFrame, large_group: int = LARGE_GROUP) -> DataFrame:
    """Stop-to-stop legs with all their features."""
    return calendar_features(leg_features(stop_to_stop(visits, large_group)))


def split_outliers(legs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(kept, outliers) by duration; legs that take no time are in neither."""
    duration = F.col("duration")
    kept = legs.where((duration > 0) & (duration < OUTLIER_SECONDS))
    return kept, legs.where(duration >= OUTLIER_SECONDS)


def clean_legs(legs: DataFrame) -> DataFrame:
    """Legs without signs of a faulty trip or measurement."""
    velocity_kmh = F.try_divide("distance", "duration") * 3.6
    return legs.withColumn("velocityKmh", velocity_kmh).where(
        (F.col("distanceTraveledShapeDest") > 0)
        & (F.col("tripNumOrig") == F.col("tripNumDest"))
        & (F.col("busStopIdOrig") != F.col("busStopIdDest"))
        & (F.col("velocityKmh") <= CLEAN_SPEED_KMH)
        & F.col("problem").isin(*CLEAN_PROBLEMS)
        & (F.col("duration") <= CLEAN_SECONDS)
    )
