"""A Merkle manifest of a dataset, and proofs of its rows by Octopus multiproofs.

Every row is a leaf. The leaves of a source make a tree of runs of ``FANOUT`` neighbours, the roots
of the sources make one more tree. A node's coordinate is ``(tree, level, idx)``: the
tree is the source's rank, ``TOP`` for the tree above the sources.

To prove its leaves, a partition of ``PART`` consecutive leaves works out which siblings on
their paths it can neither hold nor derive, fetches these once, derives all inner nodes that
its leaves share, and cuts each single proof out of them.
"""

from __future__ import annotations

from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stopweave.llm.ordering import ordered_positions
from stopweave.session import stored

FANOUT = 16
#: Consecutive leaves that are proved together, at most.
PART = 4096
#: The tree whose leaves are the roots of the sources.
TOP = -1

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def leaf_digest(**changed: Column) -> Column:
    """SHA-256 of the fields of a row, each as length and value, or ``-`` if null; in hex."""

    def field(name: str) -> Column:
        text = changed.get(name, F.col(name)).cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*(field(name) for name in FIELDS)), 256)


def lowered_share(docs: DataFrame) -> DataFrame:
    """``(doc_id, source, leaf, tampered)``: digests of each row, and of the row as tampered with.

    Where 5 divides the CRC-32 of the id, the text's A-Z are lower-cased. ``tampered`` is
    null for all other rows, and for rows whose id is null.
    """
    lottery = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    hurt = leaf_digest(text=F.translate("text", CAPITALS, SMALL))
    return docs.select("doc_id", "source", leaf_digest().alias("leaf"), F.when(lottery, hurt).alias("tampered"))


def placed_leaves(leaves: DataFrame) -> DataFrame:
    """``leaves`` with ``pos`` in the whole, ``tree`` (rank of the source), ``idx`` in it and its ``size``.

    Sources go by their bytes, null first, rows by ``doc_id``, null first, then by digest;
    equal rows are leaves of their own. Digests become 32 bytes.
    """
    packed = leaves.withColumns({c: F.unhex(c) for c in ("leaf", "tampered")})
    # Rows equal in all else are told apart by where they are read, so that copies can be dealt out.
    packed = packed.withColumn("_one", F.lit(1)).withColumn("_read", F.monotonically_increasing_id())
    placed = stored(ordered_positions(packed, ["source", "doc_id", "leaf", "_read"], "_one").drop("before", "_one", "_read"))
    sources = placed.groupBy("source").agg(F.min("pos").alias("_first"), F.count(F.lit(1)).alias("size"))
    ranked = ordered_positions(sources, ["source"], "size").select(
        F.col("source").alias("_source"), F.col("pos").alias("tree"), "_first", "size"
    )
    joined = placed.join(stored(ranked), F.col("source").eqNullSafe(F.col("_source")))
    return joined.withColumn("idx", F.col("pos") - F.col("_first")).drop("_source", "_first")


def _grown(level: DataFrame, fanout: int) -> list[DataFrame]:
    """All levels ``(tree, level, idx, size, hash)`` over ``level``; a tree ends where one node is left."""
    levels, depth = [level], 0
    most = level.agg(F.max("size")).first()[0] or 0
    while most > 1:
        children = F.array_sort(F.collect_list(F.struct("idx", "hash")))
        text = F.array_join(F.transform(children, lambda x: F.lower(F.hex(x["hash"]))), "")
        runs = levels[-1].where("size > 1").groupBy("tree", F.expr(f"idx div {fanout}").alias("idx"))
        above = runs.agg(F.ceil(F.first("size") / fanout).alias("size"), F.unhex(F.sha2(text, 256)).alias("hash"))
        depth, most = depth + 1, -(-most // fanout)
        levels.append(stored(above.select("tree", F.lit(depth).alias("level"), "idx", "size", "hash")))
    return levels


def merkle_nodes(placed: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """``(tree, level, idx, size, hash)`` of all nodes; ``size`` is the number of nodes on the level.

    No group holds more than ``fanout`` rows, however large a source is. The
    root is the one node of ``TOP`` with ``size`` 1.
    """
    leaves = placed.select("tree", F.lit(0).alias("level"), "idx", "size", F.col("leaf").alias("hash"))
    levels = _grown(leaves, fanout)
    roots = levels[0].where("size = 1")
    for level in levels[1:]:
        roots = roots.union(level.where("size = 1"))
    roots = stored(roots.select(F.col("tree").alias("idx"), "hash"))
    top = roots.select(F.lit(TOP).cast("bigint").alias("tree"), F.lit(0).alias("level"), "idx", F.lit(roots.count()).alias("size"), "hash")
    nodes = levels[0]
    for level in [*levels[1:], *_grown(top, fanout)]:
        nodes = nodes.union(level)
    return nodes


# --- multiproofs --------------------------------------------------------------------


def _siblings(known: np.ndarray, size: int, fanout: int):
    """For each level up: the coordinates missing beside ``known`` and those derived above."""
    while size > 1:
        runs = np.unique(known // fanout)
        members = (runs[:, None] * fanout + np.arange(fanout)).ravel()
        yield np.setdiff1d(members[members < size], known, assume_unique=True)
        known, size = runs, -(-size // fanout)


def missing_nodes(leaves: pa.Table, sources: int, fanout: int = FANOUT) -> list[tuple[int, int, int]]:
    """The least set of coordinates that proves all of ``leaves(tree, idx, size)``, and the root's."""
    trees, index, sizes = (leaves.column(c).to_numpy() for c in ("tree", "idx", "size"))
    order = np.lexsort((index, trees))
    trees, index, sizes = trees[order], index[order], sizes[order]
    starts = np.flatnonzero(np.r_[True, trees[1:] != trees[:-1]])
    out = []
    for a, b in zip(starts, [*starts[1:], len(trees)], strict=True):
        for level, lacking in enumerate(_siblings(index[a:b], int(sizes[a]), fanout)):
            out += [(int(trees[a]), level, int(i)) for i in lacking]
    height = 0
    for level, lacking in enumerate(_siblings(trees[starts], sources, fanout)):
        out += [(TOP, level, int(i)) for i in lacking]
        height = level + 1
    return [*out, (TOP, height, 0)]


def _requests(leaves: pa.Table, sources: int, fanout: int) -> pa.Table:
    wanted = np.array(missing_nodes(leaves, sources, fanout), np.int64)
    part = np.full(len(wanted), leaves.column("part")[0].as_py())
    return pa.table({"part": part, "tree": wanted[:, 0], "level": wanted[:, 1].astype(np.int32), "idx": wanted[:, 2]})


class _Paths:
    """The nodes that a partition holds, fetched or derives."""

    def __init__(self, hashes: dict[tuple[int, int, int], bytes], sizes: dict[int, int], fanout: int):
        self.hashes, self.sizes, self.fanout = hashes, sizes, fanout
        self.joined: dict[tuple[int, int, int], bytes] = {}
        self.tails: dict[tuple[int, int, int], bytes] = {}

    def above(self, tree: int, level: int, idx: int) -> tuple[int, int, int] | None:
        """The node over this one; the root of a source is also a leaf of the top."""
        if -(-self.sizes[tree] // self.fanout**level) > 1:
            return tree, level + 1, idx // self.fanout
        return (TOP, 0, tree) if tree != TOP else None

    def run(self, tree: int, level: int, idx: int) -> bytes:
        """The digests of a node and its siblings, joined."""
        key = tree, level, idx // self.fanout
        if key not in self.joined:
            begin = key[2] * self.fanout
            end = min(begin + self.fanout, -(-self.sizes[tree] // self.fanout**level))
            self.joined[key] = b"".join(self.hashes[tree, level, i] for i in range(begin, end))
        return self.joined[key]

    def derive(self, nodes: list[tuple[int, int, int]]) -> None:
        """All nodes above ``nodes``: first to the roots of their sources, then to the top's.

        Level by level, as a run is complete only with all that is derived for it.
        """
        roots: dict[tuple[int, int, int], None] = {}
        for waiting in (nodes, roots):
            while waiting:
                ups = {up: node for node in waiting if (up := self.above(*node)) is not None}
                for up, node in ups.items():
                    self.hashes[up] = self.hashes[node] if up[0] != node[0] else sha256(self.run(*node)).hexdigest().encode()
                if waiting is not roots and waiting[0][0] != TOP:
                    roots |= dict.fromkeys(up for up in ups if up[0] == TOP)
                    ups = {up: node for up, node in ups.items() if up[0] != TOP}
                waiting = list(ups)

    def others(self, tree: int, level: int, idx: int) -> bytes:
        """The siblings of a node, then those of the nodes above it, to the root."""
        key = tree, level, idx
        if key not in self.tails:
            up = self.above(*key)
            if up is None:
                return b""
            if up[0] != tree:
                self.tails[key] = self.others(*up)
            else:
                run, at = self.run(*key), 64 * (idx % self.fanout)
                self.tails[key] = run[:at] + run[at + 64 :] + self.others(*up)
        return self.tails[key]

    def subroot(self, tree: int) -> bytes:
        return self.hashes[TOP, 0, tree]

    def folded(self, digest: bytes, node: tuple[int, int, int]) -> bytes:
        """The root if ``node`` had this digest and all siblings were as they are."""
        while (up := self.above(*node)) is not None:
            if up[0] == node[0]:
                run, at = self.run(*node), 64 * (node[2] % self.fanout)
                digest = sha256(run[:at] + digest + run[at + 64 :]).hexdigest().encode()
            node = up
        return digest


def _proved(leaves: pa.Table, fetched: pa.Table, sources: int, fanout: int) -> pa.Table:
    def hexes(table: pa.Table, name: str) -> list[bytes | None]:
        return [None if x is None else x.hex().encode() for x in table.column(name).to_pylist()]

    trees, index, sizes = (leaves.column(c).to_pylist() for c in ("tree", "idx", "size"))
    own = [(t, 0, i) for t, i in zip(trees, index, strict=True)]
    digests, hurt = hexes(leaves, "leaf"), hexes(leaves, "tampered")
    coordinates = zip(*(fetched.column(c).to_pylist() for c in ("tree", "level", "idx")), strict=True)
    hashes = dict(zip(coordinates, hexes(fetched, "hash"), strict=True))
    height = max(level for tree, level, _ in hashes if tree == TOP)
    root = hashes.pop((TOP, height, 0))
    hashes |= dict(zip(own, digests, strict=True))
    paths = _Paths(hashes, dict(zip(trees, sizes, strict=True)) | {TOP: sources}, fanout)
    paths.derive(own)
    final, out = hashes[TOP, height, 0], []
    for node, digest, other in zip(own, digests, hurt, strict=True):
        proof = sha256(paths.others(*node)).hexdigest()
        out.append((digest, paths.subroot(node[0]), root, proof, final if other in (None, digest) else paths.folded(other, node)))
    columns = [[x if isinstance(x, str) else x.decode() for x in column] for column in zip(*out, strict=True)]
    names = ("leaf", "subroot", "root", "proof_sha256", "folded_root")
    verified = [a == b for a, b in zip(columns[2], columns[4], strict=True)]
    return pa.table({"doc_id": leaves.column("doc_id")} | dict(zip(names, columns, strict=True)) | {"verified": verified})


def prove(placed: DataFrame, nodes: DataFrame, part: int = PART, fanout: int = FANOUT) -> DataFrame:
    """``(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified)`` of each leaf of ``placed``.

    ``placed`` may be any selection of the leaves that ``nodes`` was made of. ``root`` is the
    manifest's; ``folded_root`` is what the tampered, else the original, leaf and the
    original siblings give.
    """
    last = nodes.where(F.col("tree") == TOP).agg(F.max(F.when(F.col("level") == 0, F.col("size")))).first()[0]
    kind = placed.schema["doc_id"].dataType.simpleString()
    result = f"doc_id {kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    if last is None:
        return placed.sparkSession.createDataFrame([], result)
    sources = int(last)
    parted = placed.withColumn("part", F.expr(f"pos div {part}"))
    requests = parted.select("part", "tree", "idx", "size").groupBy("part").applyInArrow(
        lambda leaves: _requests(leaves, sources, fanout), "part bigint, tree bigint, level int, idx bigint"
    )
    fetched = requests.join(nodes.select("tree", "level", "idx", "hash"), ["tree", "level", "idx"])
    grouped = parted.groupBy("part").cogroup(fetched.groupBy("part"))
    return grouped.applyInArrow(lambda leaves, found: _proved(leaves, found, sources, fanout), result)


def prove_rows(docs: DataFrame) -> DataFrame:
    """The manifest of ``docs`` and the proof of each row, some of them tampered with.

    Extra columns play no part. Nulls are leaves like any other, repeated rows are one leaf
    each, no rows give no rows.
    """
    placed = stored(placed_leaves(lowered_share(docs)))
    return prove(placed, merkle_nodes(placed))
