"""From stop records to each card's chain of boardings through the day."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stopweave.functions.clock import minutes_between
from stopweave.operators.columns import drop_missing
from stopweave.operators.ordered import first_per_group
from stopweave.schemas import VISIT_REQUIRED

CARD_DAY = ("cardNum", "date")
TAP = ("cardNum", "date", "cardTimestamp_s")

#: Column of a boarding -> name as origin; ``next_`` is put before it for the
#: boarding that follows.
ORIGIN = {
    "route": "o_route",
    "busCode": "o_bus_code",
    "date": "o_date",
    "tripNum": "o_tripNum",
    "cardTimestamp_s": "o_timestamp_s",
    "shapeId": "o_shape_id",
    "shapeSequence": "o_shape_seq",
    "shapeLat": "o_shape_lat",
    "shapeLon": "o_shape_lon",
    "stopPointId": "o_stop_id",
    "visit_id": "o_boarding_id",
}


def clean_visits(visits: DataFrame) -> DataFrame:
    """Stop records that can be placed on a trip, in time and in space."""
    return drop_missing(visits, VISIT_REQUIRED)


def boardings(visits: DataFrame) -> DataFrame:
    """Taps: stop records with a card, cut down to what tells where it boarded."""
    tapped = drop_missing(clean_visits(visits), ["cardNum", "cardTimestamp_s"])
    return tapped.select("cardNum", *ORIGIN)


def dedup_taps(taps: DataFrame) -> DataFrame:
    """One row per card, day and second: the one with the least ``visit_id``.

    Copies are dropped before the shuffle. Afterwards a card has at most one
    row per second of the day, however many taps came in under its number.
    """
    return first_per_group(taps, TAP, ["visit_id"])


def taps_per_card(taps: DataFrame, more_than: int = 1) -> DataFrame:
    """Cards tapped more than once on a day, with the number of taps."""
    counts = taps.groupBy(*CARD_DAY).agg(F.count(F.lit(1)).alias("tap_cnt"))
    return counts.where(F.col("tap_cnt") > more_than)


def repeat_boardings(taps: DataFrame) -> DataFrame:
    """Taps of cards tapped more than once that day."""
    return taps.join(taps_per_card(taps), list(CARD_DAY), "left_semi")


def circular_lead(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Mapping[str, str]
) -> DataFrame:
    """Add columns of the following row; the last row is followed by the first.

    ``columns`` maps source to new name. Groups must be bounded, as those of
    ``dedup_taps`` are by the seconds of a day.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    row = F.struct(*(F.col(old).alias(new) for old, new in columns.items()))
    following = F.coalesce(F.lead(row).over(window), F.first(row).over(window))
    return df.withColumn("_next", following).select("*", "_next.*").drop("_next")


def trip_chain(taps: DataFrame) -> DataFrame:
    """Each boarding with the card's next boarding of the day.

    Takes deduplicated taps. The last boarding is followed by the first one;
    cards with a single boarding that day say nothing and are left out. One
    window does both, so the taps are shuffled once.
    """
    window = Window.partitionBy(*CARD_DAY).orderBy("cardTimestamp_s")
    row = F.struct(*(F.col(old).alias(f"next_{new}") for old, new in ORIGIN.items()))
    chained = taps.select(
        "cardNum",
        *(F.col(old).alias(new) for old, new in ORIGIN.items()),
        F.lead(row).over(window).alias("_following"),
        F.lag(F.lit(True)).over(window).alias("_has_previous"),
        F.first(row).over(window).alias("_first"),
    )
    return (
        chained.where(F.col("_following").isNotNull() | F.col("_has_previous"))
        .withColumn("_next", F.coalesce("_following", "_first"))
        .select("cardNum", *ORIGIN.values(), "_next.*")
        .withColumn("leg_duration", minutes_between(F.col("o_timestamp_s"), F.col("next_o_timestamp_s")))
    )
