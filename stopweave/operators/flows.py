"""Boardings, alightings and the load of each bus at each stop."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stopweave.schemas import TRIP, TRIP_STOP

ROUTE_DAY = ("date", "route")
_ORIGIN_KEY = ("o_date", "o_route", "o_bus_code", "o_tripNum", "o_stop_id")


def trip_origins(od: DataFrame) -> DataFrame:
    """Boardings per trip stop."""
    boarded = od.select(*(F.col(o).alias(k) for o, k in zip(_ORIGIN_KEY, TRIP_STOP)))
    return boarded.groupBy(*TRIP_STOP).agg(F.count(F.lit(1)).alias("boarding_cnt"))


def trip_destinations(od: DataFrame) -> DataFrame:
    """Alightings per trip stop."""
    return od.groupBy(*TRIP_STOP).agg(F.count(F.lit(1)).alias("alighting_cnt"))


def stop_flows(od: DataFrame) -> DataFrame:
    """Boardings and alightings per trip stop, null where a stop had none.

    Same rows as a full outer join of origins and destinations, but each leg is
    read once, as one boarding and one alighting, and counted in one shuffle.
    """
    one, none = F.lit(1).cast("bigint"), F.lit(None).cast("bigint")
    on = F.struct(
        *(F.col(o).alias(k) for o, k in zip(_ORIGIN_KEY, TRIP_STOP)),
        one.alias("_on"),
        none.alias("_off"),
    )
    off = F.struct(*(F.col(k).alias(k) for k in TRIP_STOP), none.alias("_on"), one.alias("_off"))
    return (
        od.select(F.inline(F.array(on, off)))
        .groupBy(*TRIP_STOP)
        .agg(F.sum("_on").alias("boarding_cnt"), F.sum("_off").alias("alighting_cnt"))
    )


def route_factors(stops: DataFrame, flows: DataFrame, taps: DataFrame | None = None) -> DataFrame:
    """Per day and route, the factor that scales inferred legs up.

    The numerator is the number of trip stops (``trip_stop_cnt``), or of taps if
    a table of taps is given. Every leg alights at one stop, so the legs of a
    route are the sum of its alightings.
    """
    counted, name = (stops, "trip_stop_cnt") if taps is None else (taps, "tap_cnt")
    overall = counted.groupBy(*ROUTE_DAY).agg(F.count(F.lit(1)).alias(name))
    legs = flows.groupBy(*ROUTE_DAY).agg(F.sum("alighting_cnt").alias("odmatrix_boarding"))
    factor = F.when(
        F.coalesce(F.col("odmatrix_boarding"), F.lit(0)) == 0, F.lit(0.0)
    ).otherwise(F.col(name).cast("double") / F.col("odmatrix_boarding"))
    return overall.join(legs, list(ROUTE_DAY), "left").withColumn("extrap_factor", factor)


def stop_balance(stops: DataFrame, flows: DataFrame, missing_as_zero: bool = False) -> DataFrame:
    """Trip stops with boardings minus alightings.

    The balance is null where either side is missing, unless ``missing_as_zero``.
    """
    on, off = F.col("boarding_cnt"), F.col("alighting_cnt")
    if missing_as_zero:
        on, off = F.coalesce(on, F.lit(0)), F.coalesce(off, F.lit(0))
    return stops.join(flows, list(TRIP_STOP), "left").withColumn("crowd_bal", on - off)


def running_load(balance: DataFrame) -> DataFrame:
    """Passengers on board: the balance summed along the trip.

    Takes one row per trip stop, so a group is at most the stops of the
    network. Stops passed in the same second share one value (RANGE frame).
    """
    along = Window.partitionBy(*TRIP).orderBy("timestamp_s")
    return balance.withColumn("num_pass", F.sum("crowd_bal").over(along))


def crowdedness(stops: DataFrame, flows: DataFrame, missing_as_zero: bool = False) -> DataFrame:
    """Load per trip stop, scaled to total ridership."""
    loads = running_load(stop_balance(stops, flows, missing_as_zero))
    factors = route_factors(stops, flows).select(*ROUTE_DAY, "extrap_factor")
    return (
        loads.drop("numPassengers", "gps_timestamp", "gps_timestamp_in_secs")
        .join(factors, list(ROUTE_DAY), "left")
        .withColumn("ext_num_pass", F.col("num_pass") * F.col("extrap_factor"))
    )
