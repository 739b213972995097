"""Where did each rider get off? The nearest later stop to the next boarding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stopweave.functions.geo import Grid, geo_distance_km
from stopweave.operators.boardings import boardings, clean_visits, dedup_taps, trip_chain
from stopweave.operators.ordered import first_per_group
from stopweave.schemas import TRIP, TRIP_STOP

# Fixed value: a rider walks at most this far to the next boarding.
MAX_WALK_KM = 1.0


def trip_stops(visits: DataFrame) -> DataFrame:
    """First visit of each stop in a trip; later passes are dropped map-side."""
    cleaned = clean_visits(visits).drop("cardNum", "cardTimestamp_s", "cardTimestamp")
    return first_per_group(cleaned, TRIP_STOP, ["timestamp_s", "visit_id"])


def _on_trip(stops: DataFrame, legs: DataFrame) -> Column:
    return (
        (stops["date"] == legs["o_date"])
        & (stops["route"] == legs["o_route"])
        & (stops["busCode"] == legs["o_bus_code"])
        & (stops["tripNum"] == legs["o_tripNum"])
    )


def alighting_candidates(
    legs: DataFrame, stops: DataFrame, max_km: float = MAX_WALK_KM
) -> DataFrame:
    """Later stops of the boarded trip within ``max_km`` of the next boarding.

    Stops too far away can never be chosen, so the join also matches on a grid
    cell: a rider meets the few stops around the next boarding and not the
    whole trip, and a crowded trip is spread over as many keys as it has cells.
    """
    grid = Grid.within(max_km)
    rows, columns = grid.covering(F.col("shapeLat"), F.col("shapeLon"))
    row, column = grid.home(F.col("next_o_shape_lat"), F.col("next_o_shape_lon"))
    covered = (
        stops.withColumnRenamed("visit_id", "id")
        .withColumn("_row", F.explode(rows))
        .withColumn("_column", F.explode(columns))
    )
    homed = legs.withColumns({"_o_row": row, "_o_column": column})
    distance = geo_distance_km(
        F.col("shapeLat"), F.col("shapeLon"), F.col("next_o_shape_lat"), F.col("next_o_shape_lon")
    )
    return (
        homed.join(
            covered,
            _on_trip(covered, homed)
            & (covered["_row"] == homed["_o_row"])
            & (covered["_column"] == homed["_o_column"])
            & (covered["timestamp_s"] > homed["o_timestamp_s"]),
        )
        .withColumn("dist", distance)
        .where(F.col("dist") <= F.lit(max_km))
        .drop("_row", "_column", "_o_row", "_o_column")
    )


def infer_alightings(
    legs: DataFrame, stops: DataFrame, max_km: float = MAX_WALK_KM, per: str = "trip"
) -> DataFrame:
    """The stop at which each rider got off.

    ``per="trip"`` gives one leg per card and vehicle trip, so that two taps on
    one trip share an alighting; ``per="boarding"`` gives one for every tap.
    """
    keys = ["cardNum", *TRIP]
    if per == "boarding":
        keys.append("o_timestamp_s")
    elif per != "trip":
        raise ValueError(f"per must be 'trip' or 'boarding', not {per!r}")
    nearest = Window.partitionBy(*keys).orderBy(
        F.round("dist", 6), "timestamp_s", "stopPointId", "o_timestamp_s"
    )
    ranked = alighting_candidates(legs, stops, max_km).withColumn(
        "rn", F.row_number().over(nearest)
    )
    return ranked.where(F.col("rn") == 1)


def trips_od(visits: DataFrame, max_km: float = MAX_WALK_KM, per: str = "trip") -> DataFrame:
    """Origin-destination legs straight from stop records."""
    legs = trip_chain(dedup_taps(boardings(visits)))
    return infer_alightings(legs, trip_stops(visits), max_km, per)
