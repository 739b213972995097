"""Positions and running sums in a total order, with no task that sees all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stopweave.session import stored


def ordered_positions(df: DataFrame, order: list[str], size: str) -> DataFrame:
    """``df`` with ``pos`` (from 0) and ``before``, the sum of ``size`` over the rows before.

    The rows are dealt out by ranges of ``order`` and stored with the number of
    their range; each range then needs only the totals of those before it,
    which are as many rows as ranges. Rows equal in all of ``order`` come in any
    order.
    """
    spark = df.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = stored(df.repartitionByRange(ranges, *order).withColumn("_range", F.spark_partition_id()))
    totals = dealt.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"), F.sum(size).alias("_size"))
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(
        "_range",
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_n"),
        F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_size"),
    )
    within = Window.partitionBy("_range").orderBy(*order)
    rows = within.rowsBetween(Window.unboundedPreceding, -1)
    numbered = dealt.select(
        "*",
        (F.row_number().over(within) - 1).alias("pos"),
        F.coalesce(F.sum(size).over(rows), F.lit(0)).alias("before"),
    )
    # One row for each range: bounded by the number of shuffle partitions.
    joined = numbered.join(F.broadcast(starts), "_range")
    return joined.select(
        *df.columns,
        (F.col("pos") + F.col("_n")).alias("pos"),
        (F.col("before") + F.col("_size")).alias("before"),
    )
