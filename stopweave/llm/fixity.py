"""Fixity audit of archive replicas with Merkle trees over ordered offset ranges.

Records of a replica are hashed, the records that begin in a range of ``RANGE``
bytes make a leaf, and ``FANOUT`` neighbouring nodes a node above. Two replicas with
equal roots are equal; else only the children of nodes that differ are looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stopweave.llm.ordering import ordered_positions
from stopweave.session import stored

RANGE = 65_536
FANOUT = 64


def warc_record() -> Column:
    """The bytes of ``(page_id, url, html)`` as an archive record, as text; nulls are empty."""
    html = F.coalesce("html", F.lit(""))
    return F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: resource\r\nWARC-Target-URI: "), F.coalesce("url", F.lit("")),
        F.lit("\r\nWARC-Record-ID: "), F.coalesce(F.col("page_id").cast("string"), F.lit("")),
        F.lit("\r\nContent-Length: "), F.octet_length(html).cast("string"), F.lit("\r\n\r\n"), html, F.lit("\r\n\r\n"),
    )


def laid_out(records: DataFrame, record: str = "record") -> DataFrame:
    """``records`` in the order of ``record_id``, with ``offset``, ``length`` and ``digest``.

    The bytes themselves are hashed where they are read and not moved. Equal records follow
    each other, each with its own offset.
    """
    rest = [c for c in records.columns if c != record]
    sized = records.select(*rest, F.octet_length(record).cast("bigint").alias("length"), F.sha2(record, 256).alias("digest"))
    placed = ordered_positions(sized, ["record_id", "digest"], "length")
    return placed.withColumnRenamed("before", "offset").drop("pos")


def _parent(level: DataFrame, fanout: int) -> DataFrame:
    children = F.array_sort(F.collect_list(F.struct("node", "hash")))
    text = F.array_join(F.transform(children, lambda x: F.concat_ws(":", x["node"], x["hash"])), "|")
    return level.groupBy(F.floor(F.col("node") / fanout).alias("node")).agg(F.sha2(text, 256).alias("hash"))


def merkle_tree(replica: DataFrame, height: int, size: int = RANGE, fanout: int = FANOUT) -> list[DataFrame]:
    """The levels ``(node, hash)`` of a replica, ranges first and the root last.

    ``replica(offset, length, digest)``. A range holds no more records than can
    begin in it, a node no more than ``fanout`` children.
    """
    records = F.array_sort(F.collect_list(F.struct("offset", "length", "digest")))
    text = F.array_join(F.transform(records, lambda x: F.concat_ws(":", x["offset"], x["length"], x["digest"])), "|")
    leaves = replica.groupBy(F.floor(F.col("offset") / size).alias("node")).agg(F.sha2(text, 256).alias("hash"))
    levels = [stored(leaves)]
    for _ in range(height):
        levels.append(stored(_parent(levels[-1], fanout)))
    return levels


def audit(first: DataFrame, second: DataFrame, size: int = RANGE, fanout: int = FANOUT) -> DataFrame:
    """``(offset, record_id, length, found_length, digest, found_digest, kind)`` of each difference.

    Both replicas have ``(record_id, offset, length, digest)``. ``kind`` is ``changed``,
    ``missing`` (only in the first) or ``extra`` (only in the second). Equal
    replicas, also two empty ones, give no rows.
    """
    ends = [t.agg(F.max("offset")).first()[0] or 0 for t in (first, second)]
    height, nodes = 0, max(ends) // size + 1
    while nodes > 1:
        height, nodes = height + 1, -(-nodes // fanout)
    trees = [merkle_tree(t, height, size, fanout) for t in (first, second)]
    differing = None
    for a, b in reversed(list(zip(*trees, strict=True))):
        if differing is not None:
            below = F.floor(F.col("node") / fanout) == F.col("_node")
            up = differing.select(F.col("node").alias("_node"))
            a, b = a.join(up, below, "left_semi"), b.join(up, below, "left_semi")
        both = a.join(b.withColumnRenamed("hash", "_hash"), "node", "full_outer")
        differing = stored(both.where(~F.col("hash").eqNullSafe(F.col("_hash"))).select("node"))
        if differing.isEmpty():
            break
    inside = F.floor(F.col("offset") / size) == F.col("node")
    left = first.join(differing, inside, "left_semi").select("offset", "record_id", "length", "digest")
    right = second.join(differing, inside, "left_semi").select(
        F.col("offset").alias("_offset"), F.col("record_id").alias("_id"), F.col("length").alias("found_length"), F.col("digest").alias("found_digest")
    )
    pairs = left.join(right, F.col("offset") == F.col("_offset"), "full_outer")
    same = F.col("digest").eqNullSafe(F.col("found_digest")) & F.col("length").eqNullSafe(F.col("found_length"))
    return pairs.where(~same).select(
        F.coalesce("offset", "_offset").alias("offset"),
        F.coalesce("record_id", "_id").alias("record_id"),
        "length", "found_length", "digest", "found_digest",
        F.when(F.col("found_digest").isNull(), "missing").when(F.col("digest").isNull(), "extra").otherwise("changed").alias("kind"),
    )


def damaged_replica(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """An archive of ``pages`` and a copy of it in which some records were changed, cut or lost.

    Two hex digits of the MD5 of a page's id say what befell its record: 00 a changed
    byte, 01 lost, 02 cut in half.
    """
    lot = F.substring(F.md5(F.coalesce(F.col("page_id").cast("string"), F.lit("")).cast("binary")), 1, 2)
    records = pages.select(F.col("page_id").alias("record_id"), warc_record().alias("record"), lot.alias("lot"))
    hurt = (
        F.when(F.col("lot") == "00", F.concat(F.lit("X"), F.expr("substring(record, 2)")))
        .when(F.col("lot") == "02", F.expr("substring(record, 1, int(length(record) / 2))"))
        .otherwise(F.col("record"))
    )
    records = records.withColumn("hurt", hurt)
    records = records.select("record_id", "record", "lot", F.octet_length("hurt").cast("bigint").alias("hurt_length"), F.sha2("hurt", 256).alias("hurt_digest"))
    layout = stored(laid_out(records))
    copy = layout.where("lot <> '01'").select("record_id", "offset", F.col("hurt_length").alias("length"), F.col("hurt_digest").alias("digest"))
    return layout.select("record_id", "offset", "length", "digest"), copy
