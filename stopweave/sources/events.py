"""Stop records laid over a plain table of user events.

An event stands for a stop record: its second of the day places it on one of
two trips and one of forty stops, its user is the card. Any table with the
columns of ``events`` can be run through the jobs this way.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def visits_from_events(events: DataFrame) -> DataFrame:
    event_id, ts = F.col("event_id"), F.col("ts")
    second = F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)
    timed = events.select(
        "event_id", "user_id", "event_type", F.to_date(ts).alias("date"),
        second.cast("bigint").alias("sod"),
    )
    route = (event_id % 2).cast("int")
    sod = F.col("sod")
    stop = F.floor(sod % 43200 / 1080).cast("int") + 1
    card = F.col("event_type") != "error"
    problem = (
        F.when(event_id % 10 == 0, "TRIP_PROBLEM")
        .when(event_id % 10 == 1, "BETWEEN")
        .otherwise("NO_PROBLEM")
    )
    return timed.select(
        event_id.alias("visit_id"),
        "date",
        route.alias("route"),
        F.lit("B1").alias("busCode"),
        F.floor(sod / 43200).cast("int").alias("tripNum"),
        stop.alias("stopPointId"),
        sod.alias("timestamp_s"),
        F.when(card, F.col("user_id")).alias("cardNum"),
        F.when(card, sod).alias("cardTimestamp_s"),
        (route + 100).alias("shapeId"),
        (stop * 10).alias("shapeSequence"),
        (F.lit(-25.40) - stop * F.lit(0.004)).alias("shapeLat"),
        (F.lit(-49.25) + stop * F.lit(0.001) + route * F.lit(0.003)).alias("shapeLon"),
        (stop * F.lit(250.0)).alias("distanceTraveledShape"),
        problem.alias("problem"),
    )
