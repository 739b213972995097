"""Typed readers. Nothing is inferred: a pass over the data and, for times of
day, wrong types would be the price."""

from __future__ import annotations

import csv
from collections.abc import Sequence
from datetime import date, timedelta
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stopweave.functions.clock import seconds_of_day
from stopweave.operators.columns import between_dates, rename_columns
from stopweave.schemas import CROWDEDNESS, LEGS, STOP_VISITS_CSV

# How the delivered files write dates and missing values.
DAY_FORMAT = "yyyy_MM_dd"
DAY_FOLDER = "%Y_%m_%d"
NULL_MARKER = "-"

#: The column of values that were not of their column's type, where asked for.
REJECTED = "_rejected"


def day_folders(base: str, start: date, end: date) -> str:
    """One pattern for the day folders from ``start`` to ``end``, both included.

    Days without a folder are skipped by the file system's own matching.
    """
    if end < start:
        raise ValueError(f"start {start} is after end {end}")
    days = (start + timedelta(n) for n in range((end - start).days + 1))
    return f"{base.rstrip('/')}/{{{','.join(day.strftime(DAY_FOLDER) for day in days)}}}"


def _names_of(header: str) -> list[str]:
    """The column names of a header line, as Spark's reader names them: none twice, none empty."""
    names = next(csv.reader([header], escapechar="\\", skipinitialspace=False))
    lowered = [name.lower() for name in names]
    return [
        f"_c{k}" if not name else f"{name}{k}" if lowered.count(name.lower()) > 1 else name
        for k, name in enumerate(names)
    ]


def file_headers(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """``(header, files)``: the files, as URLs, that share a header line, their first that is not blank.

    One aggregate over the lines, however many files there are; files without
    any text are left out.
    """
    lines = spark.read.text(paths if isinstance(paths, str) else list(paths)).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.struct("_metadata.file_block_start", F.monotonically_increasing_id()).alias("place"),
    )
    # Spark's reader passes over lines of blanks and control characters.
    first = lines.where(F.col("value").rlike(r"[^\x00-\x20]")).groupBy("file").agg(F.min_by("value", "place").alias("header"))
    return first.groupBy("header").agg(F.collect_list("file").alias("files"))


def _raw_csv(
    spark: SparkSession,
    paths: str | Sequence[str],
    mode: str,
    base: str | None = None,
    known: Sequence[str] = (),
) -> DataFrame:
    """All columns as text, each file read by its own header.

    Files with the same header line are read together, by Spark's own
    reader. A file with text none of whose first line's names are ``known`` has no
    header: that is an error, as its first record would be lost otherwise.
    """
    found = file_headers(spark, paths).collect()
    if not found:
        raise ValueError(f"no CSV file with a header in {paths}")
    reader = spark.read.options(header=True, nullValue=NULL_MARKER, mode=mode)
    if base:
        reader = reader.option("basePath", base)
    parts = []
    for header, files in sorted((row["header"], sorted(map(unquote, row["files"]))) for row in found):
        names = _names_of(header)
        if known and not set(names) & set(known):
            raise ValueError(f"{len(files)} files without a header, such as {files[0]}")
        text = T.StructType([T.StructField(name, T.StringType()) for name in names])
        parts.append(reader.schema(text).csv(files))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def _typed(column: Column, kind: T.DataType, strict: bool) -> Column:
    """Text as ``kind``; whole numbers may be written with a fraction of zero, as ``7.0``."""
    if not isinstance(kind, T.IntegralType):
        return column.cast(kind) if strict else column.try_cast(kind)
    number = column.try_cast("double")
    whole = F.when(number == F.floor(number), number.try_cast(kind))
    plain = column.try_cast(kind)
    if strict:
        return F.coalesce(plain, whole, column.cast(kind))
    return F.coalesce(plain, whole)


def _csv(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType,
    mode: str,
    base: str | None = None,
    rejected: bool = False,
) -> DataFrame:
    """CSV matched by column name and cast to the declared types.

    Columns may come in any order, which may differ between files, be absent, or be
    more than declared; absent ones are null. A value of the wrong type
    becomes null, or an error if ``mode`` is FAILFAST. With ``rejected``, the
    column ``REJECTED`` lists such values of a record, for ``count_rejected``.
    """
    raw = _raw_csv(spark, paths, mode, base, schema.names)
    kinds = {field.name: field.dataType for field in schema}
    strict = mode.upper() == "FAILFAST"

    def typed(name: str) -> Column:
        if name not in kinds or raw.schema[name].dataType == kinds[name]:
            return F.col(name)
        return _typed(F.col(name), kinds[name], strict).alias(name)

    rejects = [_rejects(raw, schema).alias(REJECTED)] if rejected else []
    return raw.select(*(typed(name) for name in raw.columns), *rejects)


def _with_declared(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with typed nulls for declared columns that it lacks."""
    absent = {f.name: F.lit(None).cast(f.dataType) for f in schema if f.name not in df.columns}
    return df.withColumns(absent) if absent else df


def _rejects(raw: DataFrame, schema: T.StructType) -> Column:
    """The columns of a record whose values are not of the declared type, with the record's day."""
    day = F.col("date") if "date" in raw.columns else F.lit(None).cast("string")
    checks = [
        F.when(
            F.col(f.name).isNotNull() & _typed(F.col(f.name), f.dataType, False).isNull(),
            F.struct(day.alias("date"), F.lit(f.name).alias("column")),
        )
        for f in schema
        if f.name in raw.columns and not isinstance(f.dataType, T.StringType)
    ]
    none = F.array().cast("array<struct<date:string,column:string>>")
    return F.array_compact(F.array(*checks)) if checks else none


def count_rejected(records: DataFrame) -> DataFrame:
    """``(date, column, rejected)`` from records read with ``rejected``."""
    each = records.select(F.explode(REJECTED).alias("r")).select("r.date", "r.column")
    return each.groupBy("date", "column").agg(F.count(F.lit(1)).alias("rejected"))


def rejected_values(
    spark: SparkSession, paths: str | Sequence[str], schema: T.StructType = STOP_VISITS_CSV
) -> DataFrame:
    """``(date, column, rejected)``: values that are not of the declared type, which readers null."""
    raw = _raw_csv(spark, paths, "PERMISSIVE", known=schema.names)
    return count_rejected(raw.select(_rejects(raw, schema).alias(REJECTED)))


def _identified(df: DataFrame, schema: T.StructType | None = None) -> DataFrame:
    """``df`` with a ``visit_id`` unless it has one: a hash of the declared columns.

    Columns go in by name, and nulls as such, so neither the order of
    columns, nor extra ones, nor a null moved to another column matter.
    """
    if "visit_id" in df.columns:
        return df
    names = sorted(f.name for f in schema) if schema else sorted(df.columns)
    values = [F.col(c).cast("string") if c in df.columns else F.lit(None).cast("string") for c in names]
    marked = [F.coalesce(F.concat(F.lit("="), value), F.lit("-")) for value in values]
    return df.withColumn("visit_id", F.xxhash64(*marked))


def read_stop_visits(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType = STOP_VISITS_CSV,
    mode: str = "PERMISSIVE",
    numeric_route: bool = False,
    rejected: bool = False,
) -> DataFrame:
    """Stop records of any number of day folders, as one typed table.

    ``visit_id`` is a hash of the declared columns, so a record keeps its id
    wherever and however often it is read. ``numeric_route`` turns route codes
    into numbers and leaves those that are none null. ``rejected`` adds the column that
    ``count_rejected`` counts, so that one pass over the files serves both.
    """
    raw = _csv(spark, paths, schema, mode, rejected=rejected)
    typed = _identified(_with_declared(raw, schema), schema).withColumns(
        {
            "date": F.to_date(F.try_to_timestamp("date", F.lit(DAY_FORMAT))),
            "timestamp_s": seconds_of_day(F.col("timestamp")),
            "cardTimestamp_s": seconds_of_day(F.col("cardTimestamp")),
        }
    )
    if numeric_route:
        typed = typed.withColumn("route", F.col("route").try_cast("int"))
    return typed


def read_days(
    spark: SparkSession, base: str, start: date, end: date, **options: object
) -> DataFrame:
    """Stop records of the day folders in a range of dates."""
    return read_stop_visits(spark, day_folders(base, start, end), **options)


def read_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    fmt: str = "parquet",
    start: date | None = None,
    end: date | None = None,
) -> DataFrame:
    """A table written by ``write_table``; a range of dates prunes its folders."""
    if fmt == "csv":
        table = _csv(spark, path, schema or T.StructType(), "PERMISSIVE", base=path)
    else:
        reader = spark.read if schema is None else spark.read.schema(schema)
        table = reader.format(fmt).load(path)
    if start is None and end is None:
        return table
    return between_dates(table, start or date.min, end or date.max)


def read_crowdedness(spark: SparkSession, path: str, fmt: str = "parquet", **dates: date) -> DataFrame:
    """Loads per trip stop, as input of the leg job.

    CSV may also be of the older form, with the date in seconds since 1970, the
    time as ``HH:mm:ss`` in ``timestamp``, and no ``visit_id``.
    """
    if fmt != "csv":
        loads = read_table(spark, path, None, fmt, **dates)
    else:
        raw = _csv(spark, path, _without(CROWDEDNESS, "date"), "PERMISSIVE", base=path)
        loads = _dated(raw, "date", **dates)
        if "timestamp_s" not in loads.columns:
            loads = loads.withColumn("timestamp_s", seconds_of_day(F.col("timestamp")))
        loads = _identified(loads)
    return rename_columns(loads, [("stopPointId", "busStopId")])


def _without(schema: T.StructType, name: str) -> T.StructType:
    return T.StructType([field for field in schema if field.name != name])


def _dated(
    df: DataFrame, column: str, start: date | None = None, end: date | None = None
) -> DataFrame:
    """``column`` as a date, from a date or from seconds since 1970 in UTC, in a range.

    The session's time zone has no part in it.
    """
    if not isinstance(df.schema[column].dataType, T.DateType):
        text = F.col(column).cast("string")
        days = F.floor(text.try_cast("bigint") / 86_400).cast("int")
        dated = F.coalesce(text.try_cast("date"), F.date_from_unix_date(days))
        df = df.withColumn(column, dated)
    if start is None and end is None:
        return df
    return between_dates(df, start or date.min, end or date.max, column)


def read_legs(spark: SparkSession, path: str, fmt: str = "parquet", **dates: date) -> DataFrame:
    """The training table."""
    table = read_table(spark, path, LEGS if fmt == "csv" else None, fmt, **dates)
    return _identified(table).withColumn("duration", F.col("duration").cast("double"))
