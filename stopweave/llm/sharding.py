"""Shards of near equal bytes that never part equal texts: minimax contiguous partition."""

from __future__ import annotations

from bisect import bisect_right
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stopweave.llm.ordering import ordered_positions
from stopweave.session import stored

SHARDS = 8
#: Capacities tried in one pass over the groups.
TRIED = 128
#: Ends of groups near the cuts that the driver may hold to finish the search.
HELD = 100_000
#: Equal texts share these; texts that differ hardly ever do, and would just stay together.
ORDER = ["_hash", "_crc", "_bytes"]


@dataclass(frozen=True)
class Cuts:
    """Least capacity, and where shards after the first begin in the order of groups."""

    capacity: int
    starts: list[int]


def order_columns() -> list[Column]:
    """``ORDER`` of a row; bytes are those of the text plus 1."""
    text = F.col("text").cast("string")
    return [
        F.when(text.isNotNull(), F.xxhash64(text)),
        F.crc32(text.cast("binary")),
        F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint") + 1,
    ]


def _greedy(ends: DataFrame, capacities: list[int], shards: int) -> list[list[int]]:
    """For each capacity, where shards end if each takes all whole groups that fit.

    One pass for each shard serves all capacities; only their maxima come back.
    """
    cuts: list[list[int]] = [[] for _ in capacities]
    reached = [0] * len(capacities)
    for _ in range(shards):
        # As an array, the bounds are data of one and the same compiled plan.
        bounds = [F.struct(F.lit(i).alias("i"), F.lit(at).cast("bigint").alias("at"), F.lit(at + c).cast("bigint").alias("to")) for i, (at, c) in enumerate(zip(reached, capacities))]
        near = ends.where(F.col("end").between(min(reached) + 1, max(at + c for at, c in zip(reached, capacities))))
        tried = near.select("end", F.explode(F.array(*bounds)).alias("b")).where("end > b.at AND end <= b.to")
        furthest = tried.groupBy("b.i").agg(F.max("end").alias("end")).collect()
        for i, end in furthest:
            reached[i] = end
            cuts[i].append(end)
        if not furthest:
            break
    return cuts


def _cuts_of(ends: list[int], capacity: int, shards: int) -> list[int]:
    """The greedy cuts among sorted ``ends``, which hold all that can be cuts."""
    cuts, reached = [], 0
    for _ in range(shards):
        at = bisect_right(ends, reached + capacity)
        if not at or ends[at - 1] <= reached:
            break
        reached = ends[at - 1]
        cuts.append(reached)
    return cuts


def _padded(cuts: list[int], total: int, shards: int) -> list[int]:
    """A cut for each shard; all that follow the end of the rows stand there."""
    return [*cuts, *[total] * (shards - len(cuts))]


def minimax_cuts(
    ends: DataFrame, total: int, largest: int, shards: int, held: int = HELD
) -> Cuts:
    """The least capacity with which ``shards`` runs of groups hold all.

    ``ends(end)``: the running sum of sizes at the end of each group. No shard can
    be under the largest group or an equal share; the two together always do.
    A cut never moves back as the capacity grows, so those of the bounds of the search
    bracket it. Once no more than ``held`` groups end inside the brackets, their ends alone
    finish the search; until then each pass over all groups tries ``TRIED`` capacities.
    """
    if not total:
        return Cuts(largest, [])
    low = max(largest, -(-total // shards))
    high = max(low, -(-total // shards) + largest)
    # A shard lacks less than one group of its capacity.
    begin = [min(total, k * (low - largest)) for k in range(1, shards + 1)]
    end = [min(total, k * high) for k in range(1, shards + 1)]
    while True:
        inside = F.lit(False)
        for a, b in zip(begin, end, strict=True):
            inside = inside | F.col("end").between(a, b)
        near = ends.where(inside)
        if near.count() <= held:
            few = sorted(e for (e,) in near.collect())
            break
        if low >= high:
            return Cuts(low, [c for c in _greedy(ends, [low], shards)[0] if c < total])
        step = max(1, -(-(high - low) // TRIED))
        tried = [*range(low, high, step), high]
        cuts = _greedy(ends, tried, shards)
        first = next(i for i, c in enumerate(cuts) if c and c[-1] == total)
        if first:
            low, begin = tried[first - 1] + 1, _padded(cuts[first - 1], total, shards)
        high, end = tried[first], _padded(cuts[first], total, shards)
    while low < high:
        middle = (low + high) // 2
        if _cuts_of(few, middle, shards)[-1:] == [total]:
            high = middle
        else:
            low = middle + 1
    return Cuts(low, [c for c in _cuts_of(few, low, shards) if c < total])


def shard_of(before: Column, cuts: Cuts) -> Column:
    """The shard of a row by the sum of sizes before it."""
    shard = F.lit(0)
    for start in cuts.starts:
        shard = shard + (before >= start).cast("int")
    return shard


def placed(docs: DataFrame, shards: int = SHARDS) -> tuple[DataFrame, Cuts]:
    """``doc_id`` and ``ORDER`` of all rows with position, sum of bytes before, and shard."""
    sizes = docs.select("doc_id", *(c.alias(name) for c, name in zip(order_columns(), ORDER)))
    rows = stored(ordered_positions(sizes, [*ORDER, "doc_id"], "_bytes"))
    groups = stored(
        rows.groupBy(*ORDER).agg(
            F.max(F.col("before") + F.col("_bytes")).alias("end"), F.sum("_bytes").alias("size")
        )
    )
    total, largest = groups.agg(F.max("end"), F.max("size")).first()
    cuts = minimax_cuts(groups.select("end"), total or 0, largest or 1, shards)
    return rows.withColumn("_shard", shard_of(F.col("before"), cuts)), cuts


def shard_documents(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``(doc_id, size, text_crc32, shard, slot)`` for each row of ``docs(doc_id, text)``.

    ``size`` is the UTF-8 bytes of the text plus 1. Rows with equal texts, and
    rows without a text, are groups that stay whole. The groups stand in the order of
    the hashes of their texts and are cut into at most ``shards`` runs of the
    least possible largest size; shards may stay empty if there are few groups. ``slot`` numbers
    the rows of a shard from 0. A null text has a null ``text_crc32``.
    """
    rows, _ = placed(docs, shards)
    starts = rows.groupBy("_shard").agg(F.min("pos").alias("_first"))
    # One row for each shard.
    return rows.join(F.broadcast(starts), "_shard").select(
        "doc_id",
        F.col("_bytes").alias("size"),
        F.col("_crc").alias("text_crc32"),
        F.col("_shard").alias("shard"),
        (F.col("pos") - F.col("_first")).alias("slot"),
    )


def with_shards(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """All rows and columns of ``docs`` with their ``shard``, in place of a column of that name.

    The cuts are found on sizes and hashes alone. As shards are runs in the
    order of the hashes, a row's own hash then says where it goes; texts are not moved.
    """
    rows, cuts = placed(docs, shards)
    firsts = rows.groupBy("_shard").agg(F.min(F.struct(*ORDER)).alias("first")).orderBy("_shard")
    own = F.struct(*(c.alias(name) for c, name in zip(order_columns(), ORDER)))
    shard = F.lit(0)
    for bound in firsts.collect()[1:] if cuts.starts else []:
        first = F.struct(*(F.lit(bound["first"][c]).cast("bigint").alias(c) for c in ORDER))
        shard = shard + (own >= first).cast("int")
    return docs.withColumn("shard", shard)
