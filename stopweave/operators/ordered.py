"""Ordered work inside groups, also where one group holds most of the rows.

A window puts each group into one task. ``first_per_group`` needs none: it is an
aggregate, reduced before the shuffle. ``next_row`` needs every row, so groups
above ``large_group`` rows are cut into consecutive chunks; only the row at the
end of a chunk looks into the next one. Whether there are such groups is known when the
step is planned: from the size of the files of a small table, else by counting the keys once.
Without any, the plan is one window.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stopweave.session import stored

#: Rows a single task may sort for one group before the group is cut.
LARGE_GROUP = 5_000_000


#: Bytes of a table for each row that a single task may sort: up to this size, one task can take all of it.
BYTES_PER_ROW = 32


def small(df: DataFrame, large_group: int) -> bool:
    """Whether a single task can sort all of ``df``, by the size that Spark knows of its files.

    Nothing is read. Files are no larger than their rows, compressed and with the
    columns that ``df`` uses; where Spark knows no size, it takes a very large one.
    """
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) <= large_group * BYTES_PER_ROW


def first_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of each group; ``order`` must leave no ties.

    Each task keeps one row per group before the shuffle. Grouping starts with a
    hash of the keys because rows are sorted by group: numbers that seldom tie
    compare much faster than keys that share a date and a route. All columns of
    ``df`` travel, so select the wanted ones first.
    """
    others = [F.col(c) for c in df.columns if c not in keys]
    first = F.min_by(F.struct(*others), F.struct(*order)).alias("_first")
    grouped = df.groupBy(F.xxhash64(*keys).alias("_hash"), *keys).agg(first)
    return grouped.select(*keys, "_first.*").select(*df.columns)


def _match(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join on keys where null equals null, keeping the left key columns."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    condition = reduce(
        lambda a, b: a & b, (left[k].eqNullSafe(renamed[f"_r_{k}"]) for k in keys)
    )
    return left.join(renamed, condition, how).drop(*(f"_r_{k}" for k in keys))


def large_groups(df: DataFrame, keys: Sequence[str], large_group: int) -> DataFrame:
    """Keys of groups above ``large_group`` rows.

    Counted with a partial sum per task; there are fewer than
    rows / ``large_group`` such groups.
    """
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    return counted.where(F.col("_rows") > large_group).drop("_rows")


def chunked(
    df: DataFrame, keys: Sequence[str], position: str, tiebreak: str, chunk_rows: int
) -> DataFrame:
    """Add ``_chunk``: consecutive pieces of about ``chunk_rows`` rows per group.

    The rank of a row is estimated as the rows at earlier positions plus its
    share of its own position by ``tiebreak``. The estimate never decreases
    along (position, tiebreak), so pieces do not overlap; how even they are
    changes the load of the tasks, never the result.
    """
    places = df.groupBy(*keys, position).agg(
        F.count(F.lit(1)).alias("_here"),
        F.min(tiebreak).cast("double").alias("_low"),
        F.max(tiebreak).cast("double").alias("_high"),
    )
    # One row per position: a service day has a fixed number of seconds.
    before = Window.partitionBy(*keys).orderBy(position).rowsBetween(Window.unboundedPreceding, -1)
    places = places.withColumn("_before", F.coalesce(F.sum("_here").over(before), F.lit(0)))
    share = (F.col(tiebreak).cast("double") - F.col("_low")) / (
        F.col("_high") - F.col("_low") + F.lit(1.0)
    )
    rank = F.col("_before") + F.col("_here") * F.coalesce(F.least(share, F.lit(0.999999)), F.lit(0.0))
    return (
        _match(df, places, [*keys, position], "inner")
        .withColumn("_chunk", F.floor(rank / F.lit(chunk_rows)))
        .drop("_here", "_low", "_high", "_before")
    )


def next_row(
    df: DataFrame,
    keys: Sequence[str],
    position: str,
    tiebreak: str,
    columns: Mapping[str, str],
    large_group: int = LARGE_GROUP,
) -> DataFrame:
    """Add, per row, columns of the row that follows it in its group.

    ``columns`` maps source to new name. The last row of a group gets nulls.
    Rows follow each other by (position, tiebreak); ``position`` takes a
    bounded number of values per group, as seconds of a day do.
    """
    ahead = F.struct(*(F.col(old).alias(new) for old, new in columns.items()))
    order = [F.col(position), F.col(tiebreak)]
    following = F.lead(ahead).over(Window.partitionBy(*keys).orderBy(*order))
    # No group is larger than the table. Else one pass over the keys alone, counted before their shuffle.
    large = None if small(df, large_group) else stored(large_groups(df, keys, large_group))
    if large is None or large.isEmpty():
        return df.withColumn("_next", following).select("*", "_next.*").drop("_next")

    whole = _match(df, large, keys, "left_anti").withColumn("_next", following)

    pieces = chunked(_match(df, large, keys, "left_semi"), keys, position, tiebreak, large_group)
    piece = [*keys, "_chunk"]
    heads = pieces.groupBy(*piece).agg(F.min_by(ahead, F.struct(*order)).alias("_head"))
    # One row per chunk of a large group: rows / large_group in all.
    heads = heads.withColumn(
        "_head", F.lead("_head").over(Window.partitionBy(*keys).orderBy("_chunk"))
    )
    cut = _match(
        pieces.withColumn(
            "_next", F.lead(ahead).over(Window.partitionBy(*piece).orderBy(*order))
        ),
        heads,
        piece,
        "left",
    )
    cut = cut.withColumn("_next", F.coalesce("_next", "_head")).drop("_head", "_chunk")

    return whole.unionByName(cut).select("*", "_next.*").drop("_next")
