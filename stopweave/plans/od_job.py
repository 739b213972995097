"""Origin-destination job: who got off where, and how full each bus was."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession

from stopweave.operators import alighting, boardings, flows
from stopweave.session import job_tables, stored
from stopweave.sources.readers import REJECTED, count_rejected, read_days
from stopweave.sources.writers import write_table

TRIP_ORDER = ("route", "busCode", "tripNum", "timestamp_s")


def build_od(
    visits: DataFrame,
    output: str,
    per: str = "trip",
    missing_as_zero: bool = False,
    fmt: str = "parquet",
    days: tuple[date, date] | None = None,
) -> None:
    """Write all tables of the job for the days in ``visits``.

    Every key holds the date, so any number of days go through together. Trip
    stops and legs feed several tables and are stored once for this run; a day
    run again replaces its folders, and days from the first to the last of ``days``
    that have no rows any more lose theirs.
    """
    stops = stored(alighting.trip_stops(visits))
    chain = boardings.trip_chain(boardings.dedup_taps(boardings.boardings(visits)))
    od = stored(alighting.infer_alightings(chain, stops, per=per))
    write_table(od, f"{output}/od/trips_od", fmt=fmt, days=days)
    write_table(flows.trip_origins(od), f"{output}/od/trips_origins", fmt=fmt, days=days)
    write_table(flows.trip_destinations(od), f"{output}/od/trips_destinations", fmt=fmt, days=days)
    loads = flows.crowdedness(stops, flows.stop_flows(od), missing_as_zero)
    write_table(loads, f"{output}/od/crowdedness", sort_by=TRIP_ORDER, fmt=fmt, days=days)


def run_od_job(
    spark: SparkSession,
    source: str,
    output: str,
    start: date,
    end: date,
    per: str = "trip",
    missing_as_zero: bool = False,
    fmt: str = "parquet",
) -> None:
    """Read the CSV day folders from ``start`` to ``end`` and build all tables.

    Folders decide what is read: a record keeps its own date, also one after
    midnight in the folder of the day before. The files are parsed once: the typed records are
    stored, and trip stops and taps read their own columns of them. Values that
    are not of their column's type are stored beside them and counted in ``od/rejected_values``.
    """
    with job_tables(spark):
        records = stored(read_days(spark, source, start, end, rejected=True))
        write_table(count_rejected(records), f"{output}/od/rejected_values", partition_by=(), fmt=fmt)
        build_od(records.drop(REJECTED), output, per, missing_as_zero, fmt, (start, end))
