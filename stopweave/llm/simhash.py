"""Near-duplicates by SimHash: fingerprints compared through the generalised pigeonhole.

The 64 bits are cut into groups of correlated bits. If two fingerprints differ
in at most ``t`` bits and the groups have thresholds that add up to
``t - groups + 1``, then in some group they differ by no more than its
threshold (a group of threshold -1 is never looked at). Each group is an index
by its own bits; every fingerprint probes it with its bits changed in up to
``threshold`` places. Thresholds are those of the least expected work, found by
dynamic programming over candidate counts estimated from all fingerprints.
"""

from __future__ import annotations

from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stopweave.llm.common import KEYS, batches_of, row_keys
from stopweave.llm.components import connected_components
from stopweave.session import stored

BITS = 64
DISTANCE = 2
SHINGLE_WORDS = 3
#: A bucket of the index with more fingerprints is not compared pair by pair. Comparing
#: costs far less than the 65 rows that a fingerprint needs otherwise.
BUCKET = 512


def shingle_hashes(text: bytes, shingle_words: int = SHINGLE_WORDS) -> np.ndarray:
    """The hash of each run of so many lower-cased words, or of all of fewer words."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, "<u8")
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    span = min(shingle_words, len(words))
    digest = xxhash.xxh64_intdigest
    froms, tos = starts[: len(words) - span + 1].tolist(), ends[span - 1 :].tolist()
    return np.fromiter((digest(joined[a:b], 42) for a, b in zip(froms, tos, strict=True)), "<u8", len(froms))


def fingerprint(text: bytes, shingle_words: int = SHINGLE_WORDS) -> int:
    """Bits set in more than half of the hashes of the shingles; 0 without words."""
    hashes = shingle_hashes(text, shingle_words)
    counts = np.zeros(BITS, np.int64)
    for k in range(0, len(hashes), 1 << 14):
        bits = np.unpackbits(hashes[k : k + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<u8")[0])


def _fingerprints(batches, shingle_words: int):
    for whole in batches:
        for batch in batches_of(whole, "text"):
            texts = (x.as_buffer() for x in batch.column("text").cast(pa.large_binary()))
            prints = [fingerprint(b"" if x is None else x.to_pybytes(), shingle_words) for x in texts]
            column = pa.array(np.array(prints, dtype=np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(name) for name in ("doc_id", *KEYS)] + [column],
                names=["doc_id", *KEYS, "fp"],
            )


def fingerprints(docs: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """``(doc_id, _key1, _key2, fp)`` of each row; ``fp`` holds the 64 bits as a signed number."""
    plain = docs.select("doc_id", F.col("text").cast("string").alias("text"), *row_keys())
    kind = plain.schema["doc_id"].dataType.simpleString()
    return plain.mapInArrow(
        lambda batches: _fingerprints(batches, shingle_words),
        f"doc_id {kind}, _key1 bigint, _key2 int, fp bigint",
    )


# --- statistics of all fingerprints -------------------------------------------------


def _bit_products(batches):
    total = np.zeros((BITS, BITS))
    for batch in batches:
        prints = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
        for k in range(0, len(prints), 1 << 16):
            raw = np.ascontiguousarray(prints[k : k + (1 << 16)]).view(np.uint8).reshape(-1, 8)
            bits = np.unpackbits(raw, axis=1, bitorder="little").astype(np.float32)
            total += bits.T @ bits
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.repeat(np.arange(BITS), BITS)), pa.array(np.tile(np.arange(BITS), BITS)), pa.array(total.ravel())],
        names=["i", "j", "n"],
    )


def bit_statistics(prints: DataFrame) -> tuple[int, np.ndarray]:
    """How many fingerprints have bits i and j both set: 64 x 64 sums over all of them."""
    sums = prints.select("fp").mapInArrow(_bit_products, "i bigint, j bigint, n double")
    both = np.zeros((BITS, BITS))
    for i, j, n in sums.groupBy("i", "j").agg(F.sum("n")).collect():
        both[i, j] = n
    return prints.count(), both


def correlated_groups(n: int, both: np.ndarray, groups: int) -> list[list[int]]:
    """The bits dealt into ``groups`` groups; each grows by the bit closest to its own."""
    mean = np.diag(both) / max(n, 1)
    spread = np.sqrt(np.maximum(mean * (1 - mean), 1e-12))
    close = np.abs((both / max(n, 1) - np.outer(mean, mean)) / np.outer(spread, spread))
    np.fill_diagonal(close, 0)
    left, dealt = set(range(BITS)), []
    for k in range(groups):
        size = len(left) // (groups - k)
        rest = sorted(left)
        part = close[np.ix_(rest, rest)]
        group = [rest[int(part.sum(axis=1).argmax())]]
        while len(group) < size:
            rest = sorted(left - set(group))
            group.append(rest[int(close[np.ix_(rest, group)].sum(axis=1).argmax())])
        left -= set(group)
        dealt.append(sorted(group))
    return dealt


def signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


def mask_of(bits: list[int]) -> int:
    return signed(sum(1 << b for b in bits))


def candidate_estimates(
    n: int, both: np.ndarray, group: list[int], pairs_equal: float, most: int
) -> list[float]:
    """Expected work of a group for thresholds -1 to ``most``: probes and candidate pairs.

    ``pairs_equal`` counts the pairs with equal bits here, over all
    fingerprints. For each further differing bit they are multiplied by its odds
    of differing, as if bits were independent.
    """
    mean = np.diag(both)[group] / max(n, 1)
    differ = np.clip(2 * mean * (1 - mean), 1e-9, 0.5)
    odds = differ / (1 - differ)
    products = np.zeros(most + 1)
    products[0] = 1
    for x in odds:
        products[1:] += products[:-1] * x
    found = np.cumsum(products) * pairs_equal
    probes = np.cumsum([comb(len(group), e) for e in range(most + 1)]) * n + n
    return [0.0, *(found + probes)]


def allocate(work: list[list[float]], total: int) -> tuple[float, list[int]]:
    """Thresholds, -1 or more each, that add up to ``total`` at the least work."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for row in work:
        following: dict[int, tuple[float, list[int]]] = {}
        for so_far, (cost, chosen) in best.items():
            for k, extra in enumerate(row):
                found = (cost + extra, [*chosen, k - 1])
                at = so_far + k - 1
                if at not in following or found[0] < following[at][0]:
                    following[at] = found
        best = following
    return best[total]


def plan(prints: DataFrame, distance: int = DISTANCE) -> list[tuple[list[int], int]]:
    """Groups of bits with thresholds of 0 or more, of the cheapest of several cuts."""
    n, both = bit_statistics(prints)
    cuts = {m: correlated_groups(n, both, m) for m in range(1, distance + 3)}
    flat = [(m, g) for m, groups in cuts.items() for g in groups]
    masks = F.array(*(F.lit(mask_of(g)).cast("bigint") for _, g in flat))
    shown = prints.select(F.posexplode(masks).alias("k", "mask"), "fp")
    sizes = shown.groupBy("k", F.expr("fp & mask").alias("value")).agg(F.count(F.lit(1)).alias("c"))
    equal = sizes.groupBy("k").agg(F.sum(F.expr("c * (c - 1.0D) / 2")).alias("pairs"))
    pairs = {k: p for k, p in equal.collect()}
    options = []
    for m, groups in cuts.items():
        at = [k for k, (cut, _) in enumerate(flat) if cut == m]
        work = [candidate_estimates(n, both, g, pairs.get(k, 0.0), distance) for k, g in zip(at, groups)]
        cost, thresholds = allocate(work, distance - m + 1)
        options.append((cost, [(g, t) for g, t in zip(groups, thresholds) if t >= 0]))
    return min(options)[1]


# --- probing ------------------------------------------------------------------------


def _explode_changed(value: Column, bits: list[int], most: int) -> Column:
    """A row for ``value`` with each choice of up to ``most`` of the bits flipped."""
    flips = [signed(sum(1 << b for b in c)) for e in range(most + 1) for c in combinations(bits, e)]
    flips = F.array(*(F.lit(x).cast("bigint") for x in flips))
    return F.explode(F.transform(flips, lambda flip: value.bitwiseXOR(flip)))


def links(prints: DataFrame, distance: int = DISTANCE, bucket: int = BUCKET) -> DataFrame:
    """``(u, v)``: pairs of distinct fingerprints ``fp`` with the components of all links.

    Buckets of up to ``bucket`` fingerprints are probed and verified pair by
    pair. Fingerprints that meet a larger bucket are instead linked through the
    values within ``distance / 2`` bits of them: two of them share such a value
    if, and only if, they differ in ``distance`` bits or fewer, and each is
    linked to the least that shares it. That is linear in their number, and
    gives the same components.
    """
    if distance != 2:
        raise ValueError("larger buckets are linked through single changed bits: distance 2")
    chosen = plan(prints, distance)
    entries = prints.select(
        F.posexplode(F.array(*(F.expr(f"fp & {mask_of(g)}L") for g, _ in chosen))).alias("k", "key"), "fp"
    )
    sized = entries.groupBy("k", "key").agg(F.count(F.lit(1)).alias("n"))
    large = stored(sized.where(F.col("n") > bucket))
    probes = None
    for k, (group, threshold) in enumerate(chosen):
        changed = _explode_changed(F.expr(f"fp & {mask_of(group)}L"), group, threshold)
        part = prints.select(F.lit(k).alias("k"), changed.alias("key"), F.col("fp").alias("probe"))
        probes = part if probes is None else probes.union(part)
    few = entries.join(large, ["k", "key"], "left_anti")
    near = F.bit_count(F.col("fp").bitwiseXOR(F.col("probe"))) <= distance
    pairs = few.join(probes, (few.k == probes.k) & (few.key == probes.key) & (F.col("fp") < F.col("probe")) & near)
    verified = pairs.select(F.col("fp").alias("u"), F.col("probe").alias("v"))
    if large.isEmpty():
        return verified.distinct()
    crowded = probes.join(large, ["k", "key"], "left_semi").select(F.col("probe").alias("fp")).distinct()
    around = _explode_changed(F.col("fp"), list(range(BITS)), 1)
    spread = crowded.select("fp", around.alias("value"))
    least = spread.groupBy("value").agg(F.min("fp").alias("m"), F.max("fp").alias("x")).where("m < x")
    starred = spread.join(least, "value").where("m < fp").select(F.col("m").alias("u"), F.col("fp").alias("v"))
    return verified.union(starred).distinct()


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``(doc_id, _key1, _key2, fp, component_id, first_key)`` for each row of ``docs(doc_id, text)``.

    ``component_id`` is the least ``doc_id`` reachable through fingerprints that
    differ in 2 bits or fewer; ``first_key`` identifies the component's first row
    by ``doc_id``, then text. Null and blank texts have the fingerprint 0 and
    link like any other. Equal fingerprints are one node, so copies are never
    paired. A null ``doc_id`` comes last; alone it gives a null component.
    """
    rows = stored(fingerprints(docs))
    first = F.struct(F.col("doc_id").isNull(), "doc_id", *KEYS)
    nodes = stored(rows.groupBy("fp").agg(F.min(first).alias("first")))
    roots = connected_components(stored(links(nodes.select("fp"))))
    labelled = nodes.join(roots, nodes.fp == roots.node, "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), "first"
    )
    firsts = labelled.groupBy("root").agg(F.min("first").alias("first"))
    labels = labelled.select("fp", "root").join(firsts, "root").select("fp", "first")
    return rows.join(labels, "fp").select(
        "doc_id", *KEYS, "fp", F.col("first.doc_id").alias("component_id"),
        F.struct("first._key1", "first._key2").alias("first_key"),
    )
