"""Small table-shaping steps shared by the jobs."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Columns a row of the training table must have to be used in tuning.
COMPLETE_TEXT = ("periodOrig", "weekDay", "route")
COMPLETE_NUMBERS = (
    "shapeLatOrig",
    "shapeLonOrig",
    "busStopIdOrig",
    "busStopIdDest",
    "shapeLatDest",
    "shapeLonDest",
    "hourOrig",
    "isRushOrig",
    "weekOfYear",
    "dayOfMonth",
    "month",
    "isHoliday",
    "isWeekend",
    "isRegularDay",
    "distance",
    "crowdedness",
    "pacing",
    "speed",
)


def drop_missing(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Rows that have all of ``columns``; not-a-number counts as missing.

    Written as one comparison per column, which reaches the Parquet scan.
    """
    schema = df.schema

    def present(name: str) -> Column:
        known = F.col(name).isNotNull()
        if isinstance(schema[name].dataType, (T.DoubleType, T.FloatType)):
            known = known & ~F.isnan(name)
        return known

    return df.where(reduce(Column.__and__, map(present, columns)))


def rename_columns(df: DataFrame, pairs: Iterable[tuple[str, str]]) -> DataFrame:
    """Rename by (old, new) pairs; names that are absent are skipped."""
    return df.withColumnsRenamed(dict(pairs))


def complete_cases(
    df: DataFrame, columns: Sequence[str] = COMPLETE_TEXT + COMPLETE_NUMBERS
) -> DataFrame:
    return drop_missing(df, columns)


def between_dates(df: DataFrame, start: date, end: date, column: str = "date") -> DataFrame:
    """Rows with ``start <= date <= end``; prunes folders of a table split by date."""
    return df.where(F.col(column).between(F.lit(start), F.lit(end)))


def union_tables(tables: Sequence[DataFrame]) -> DataFrame:
    """All tables, such as days read one by one, as one; columns go by name."""
    if not tables:
        raise ValueError("union_tables needs at least one table")
    return reduce(DataFrame.unionByName, tables)
