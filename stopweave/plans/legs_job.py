"""Preprocessing job: stop-to-stop legs with features, split into training data
and outliers."""

from __future__ import annotations

from datetime import date

from pyspark.sql import SparkSession

from stopweave.operators import legs
from stopweave.session import job_tables, stored
from stopweave.sources.readers import read_crowdedness
from stopweave.sources.writers import write_table


def run_legs_job(
    spark: SparkSession,
    source: str,
    output: str,
    start: date | None = None,
    end: date | None = None,
    clean: bool = False,
    fmt: str = "parquet",
) -> None:
    """Write ``routes_stops``, ``train_data`` and ``outliers``.

    Without ``start`` and ``end`` the tables are replaced as a whole, else the days
    from the one to the other; days without legs any more lose their rows.
    """
    part = start is not None or end is not None
    days = (start or date.min, end or date.max) if part else None
    how = {"fmt": fmt, "days": days, "replace": "partitions" if part else "table"}
    with job_tables(spark):
        loads = read_crowdedness(spark, source, fmt, start=start, end=end)
        write_table(legs.route_stops(loads), f"{output}/routes_stops", partition_by=(), fmt=fmt)
        featured = stored(legs.featured_legs(loads))
        kept, outliers = legs.split_outliers(featured)
        write_table(legs.clean_legs(kept) if clean else kept, f"{output}/train_data", **how)
        write_table(outliers, f"{output}/outliers", **how)
