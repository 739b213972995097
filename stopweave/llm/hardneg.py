"""Hard negatives by a vertical scan with shrinking bounds (BOND).

Vectors are kept in blocks, dimension by dimension. For each anchor a block's dimensions
are read in the order of the anchor's magnitudes; what the rest can still add lies between
bounds made of each dimension's least and greatest value in the block. Rows whose bounds rule them out leave
the bitmap of candidates, until few are left or all dimensions are read; their sums are then exact.

Two scans: the nearest rows of the same label are an anchor's positives; then, for every
positive, the nearest rows of other labels within a window below its score.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stopweave.session import stored

SCALE = 256
#: Positives of an anchor, and negatives of a positive.
MOST = 5
#: Negatives score from so many hundredths of the positive's score up to all of it.
LEAST_PERCENT = 80
#: Rows of a block, and dimensions read between two looks at the bounds.
BLOCK, STEP = 4096, 8
#: Numbers of the anchors that one scan carries, at most: 64 MB.
ANCHOR_NUMBERS = 1 << 23

_BLOCK_SCHEMA = "ids array<bigint>, rows array<bigint>, labels array<string>, dims int, columns binary"
_FOUND = "anchor bigint, k int, id bigint, score bigint"


def whole_numbers(vectors: np.ndarray) -> np.ndarray:
    """``floor(256 x)``, held where a sum of products over all dimensions still fits 64 bits."""
    most = math.isqrt((1 << 62) // max(vectors.shape[-1], 1))
    return np.clip(np.floor(SCALE * vectors.astype(np.float64)), -most, most).astype(np.int64)


def usable(rows: DataFrame) -> DataFrame:
    """``(row, id, label, vector)`` of the rows with a label and finite components, each with a number of its own."""
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    kept = rows.where(F.col("label").isNotNull() & F.col("embedding").isNotNull() & ~bad)
    return stored(
        kept.select(
            F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("bigint").alias("id"),
            F.col("label").cast("string").alias("label"), F.col("embedding").cast("array<double>").alias("vector"),
        )
    )


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors as rows; shorter ones end in zeros, which add nothing to a product."""
    lengths = column.value_lengths().to_numpy()
    width = int(lengths.max(initial=0))
    out = np.zeros((len(column), width))
    out[np.arange(width) < lengths[:, None]] = column.flatten().to_numpy()
    return out


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for k in range(0, whole.num_rows, BLOCK):
            batch = whole.slice(k, BLOCK)
            numbers = whole_numbers(_matrix(batch.column("vector")))
            lists = [pa.array([batch.column(c).to_pylist()], t) for c, t in (("id", pa.list_(pa.int64())), ("row", pa.list_(pa.int64())), ("label", pa.list_(pa.string())))]
            columns = [*lists, pa.array([numbers.shape[1]], pa.int32()), pa.array([np.ascontiguousarray(numbers.T).tobytes()], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["ids", "rows", "labels", "dims", "columns"])


def columnar_blocks(rows: DataFrame) -> DataFrame:
    """``rows`` packed into blocks of up to ``BLOCK`` vectors, one dimension after another."""
    return stored(rows.mapInArrow(_packed, _BLOCK_SCHEMA))


class Block:
    """A block of vectors: its columns, and the least and greatest value of each."""

    def __init__(self, ids, rows, labels, dims: int, columns: bytes):
        # A null id comes last among equal scores.
        self.known = np.array([x is not None for x in ids], bool)
        self.ids = np.array([0 if x is None else x for x in ids], np.int64)
        self.rows = np.array(rows, np.int64)
        names, self.codes = np.unique(np.array(labels, object).astype(str), return_inverse=True)
        self.code_of = {name: k for k, name in enumerate(names.tolist())}
        self.columns = np.frombuffer(columns, np.int64).reshape(dims, len(self.ids))
        self.low, self.high = self.columns.min(axis=1), self.columns.max(axis=1)
        self.largest = int(np.abs(self.columns).max(initial=0))
        self.floats = self.columns.astype(np.float64)

    def scan(self, anchor: np.ndarray, candidates: np.ndarray, prune) -> tuple[np.ndarray, np.ndarray]:
        """The candidates that ``prune(low, high)`` never ruled out, and their exact products."""
        dims = min(len(anchor), len(self.columns))
        weights = anchor[:dims]
        # Products below 2^53 are exact as floating point, which is faster.
        exact = max(int(np.abs(weights).max(initial=0)), 1) * max(self.largest, 1) * max(dims, 1) < 1 << 53
        columns = self.floats if exact else self.columns
        weights = weights.astype(columns.dtype)
        order = np.argsort(-np.abs(weights), kind="stable")
        ends = weights * self.low[:dims], weights * self.high[:dims]
        rest_low = np.r_[np.cumsum(np.minimum(*ends)[order][::-1])[::-1], 0]
        rest_high = np.r_[np.cumsum(np.maximum(*ends)[order][::-1])[::-1], 0]
        sums = np.zeros(len(candidates), columns.dtype)
        for at in range(0, dims, STEP):
            read = order[at : at + STEP]
            sums = sums + weights[read] @ columns[np.ix_(read, candidates)]
            kept = prune(sums + rest_low[at + len(read)], sums + rest_high[at + len(read)])
            candidates, sums = candidates[kept], sums[kept]
            if not len(candidates):
                break
        return candidates, sums.astype(np.int64)

    def first(self, places: np.ndarray, scores: np.ndarray, most: int) -> list[tuple[int, bool, int]]:
        """The highest scores, ties by smaller id."""
        order = np.lexsort((self.ids[places], ~self.known[places], -scores))[:most]
        return [(int(scores[i]), bool(self.known[places[i]]), int(self.ids[places[i]])) for i in order]


def _merged(best: list, found: list, most: int) -> list:
    return sorted([*best, *found], key=lambda x: (-x[0], not x[1], x[2]))[:most]


def _kth(values: np.ndarray, most: int):
    """The ``most``-th greatest value, or none if there are fewer."""
    return np.partition(values, len(values) - most)[len(values) - most] if len(values) >= most else None


def nearest_alike(block: Block, anchor, best: list, most: int = MOST) -> list:
    """``best`` merged with the block's nearest rows of the anchor's label, itself excluded."""
    row, label, vector = anchor
    code = block.code_of.get(label)
    candidates = np.flatnonzero((block.codes == code) & (block.rows != row)) if code is not None else np.zeros(0, int)
    if not len(candidates):
        return best
    reached = best[-1][0] if len(best) == most else None

    def prune(low, high):
        needed = [x for x in (reached, _kth(low, most)) if x is not None]
        return high >= max(needed) if needed else np.ones(len(low), bool)

    places, scores = block.scan(vector, candidates, prune)
    return _merged(best, block.first(places, scores, most), most)


def window(score: int, percent: int = LEAST_PERCENT) -> tuple[int, int]:
    """The scores a negative may have beside a positive's; empty if that is below zero."""
    return -(-percent * score // 100), score


def nearest_unlike(block: Block, anchor, windows: list[tuple[int, int]], best: list[list], most: int = MOST) -> list[list]:
    """Each window's ``best`` merged with the block's nearest rows of other labels inside it."""
    _, label, vector = anchor
    code = block.code_of.get(label)
    candidates = np.flatnonzero(block.codes != code) if code is not None else np.arange(len(block.codes))
    open_ = [k for k, (low, high) in enumerate(windows) if low <= high]
    if not len(candidates) or not open_:
        return best

    def prune(low, high):
        alive = np.zeros(len(low), bool)
        for k in open_:
            least, greatest = windows[k]
            sure = low[(low >= least) & (high <= greatest)]
            needed = [x for x in (least, best[k][-1][0] if len(best[k]) == most else None, _kth(sure, most)) if x is not None]
            alive |= (high >= max(needed)) & (low <= greatest)
        return alive

    places, scores = block.scan(vector, candidates, prune)
    out = list(best)
    for k in open_:
        inside = (scores >= windows[k][0]) & (scores <= windows[k][1])
        out[k] = _merged(best[k], block.first(places[inside], scores[inside], most), most)
    return out


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
    for batch in batches:
        for row in batch.to_pylist():
            yield Block(row["ids"], row["rows"], row["labels"], row["dims"], row["columns"])


def _rows(found: list[tuple[int, int, bool, int, int]]) -> Iterator[pa.RecordBatch]:
    anchors, ks, known, ids, scores = zip(*found, strict=True) if found else ((),) * 5
    ids = [i if k else None for i, k in zip(ids, known, strict=True)]
    yield pa.RecordBatch.from_arrays(
        [pa.array(anchors, pa.int64()), pa.array(ks, pa.int32()), pa.array(ids, pa.int64()), pa.array(scores, pa.int64())],
        names=["anchor", "k", "id", "score"],
    )


def _positive_scan(held, most: int):
    def scan(batches):
        anchors = held.value
        best = [[] for _ in anchors]
        for block in _blocks(batches):
            for i, anchor in enumerate(anchors):
                best[i] = nearest_alike(block, anchor, best[i], most)
        yield from _rows([(a[0], 0, known, i, s) for a, rows in zip(anchors, best, strict=True) for s, known, i in rows])

    return scan


def _negative_scan(held, most: int):
    def scan(batches):
        anchors, windows = held.value
        best = [[[] for _ in w] for w in windows]
        for block in _blocks(batches):
            for i, anchor in enumerate(anchors):
                best[i] = nearest_unlike(block, anchor, windows[i], best[i], most)
        yield from _rows(
            [(a[0], k + 1, known, i, s) for a, lists in zip(anchors, best, strict=True) for k, rows in enumerate(lists) for s, known, i in rows]
        )

    return scan


def _ranked(found: DataFrame, most: int) -> DataFrame:
    """The first of what the tasks found, which is at most ``most`` rows of each."""
    order = Window.partitionBy("anchor", "k").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def hard_negatives(
    rows: DataFrame, every: int = 100, most: int = MOST, percent: int = LEAST_PERCENT, numbers: int = ANCHOR_NUMBERS
) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    ``rows(vec_id, label, embedding)``; anchors are the rows whose ``vec_id`` is divisible by
    ``every``. Rows with a null label, a null vector, or a null or non-finite component
    take no part. Vectors of other lengths multiply over the dimensions both have;
    components beyond about a million stand for that bound, so that products fit
    64 bits. A repeated row is a row of its own: another copy can be an
    anchor's positive, or its anchor once more. A null ``vec_id`` is no anchor, and comes last among equal scores.

    The anchors pass over the blocks in batches of at most ``numbers`` numbers,
    whatever their count; each task hands on the first ``most`` it met.
    """
    spark = rows.sparkSession
    vectors = usable(rows)
    blocks = columnar_blocks(vectors)
    asking = stored(vectors.where(F.col("id") % every == 0))
    count, width = asking.agg(F.count(F.lit(1)), F.max(F.size("vector"))).first()
    batches = max(1, -(-count * max(width or 1, 1) // max(numbers // 2, 1)))
    out = None
    for number in range(batches):
        # Dealt by hash: about half of ``numbers`` each, so that none comes near the bound.
        mine = asking.where(F.pmod(F.xxhash64("row"), F.lit(batches)) == number)
        table = mine.select("row", "label", "vector").toArrow().sort_by("row")
        numbers_of = whole_numbers(_matrix(table.column("vector").combine_chunks())) if table.num_rows else []
        anchors = list(zip(table.column("row").to_pylist(), table.column("label").to_pylist(), numbers_of, strict=True))
        held = spark.sparkContext.broadcast(anchors)
        alike = stored(_ranked(blocks.mapInArrow(_positive_scan(held, most), _FOUND), most))
        scores = {}
        for anchor, rank, score in _triples(alike):
            scores.setdefault(anchor, {})[rank] = score
        windows = [[window(s, percent) for _, s in sorted(scores.get(a[0], {}).items())] for a in anchors]
        both = spark.sparkContext.broadcast((anchors, windows))
        unlike = _ranked(blocks.mapInArrow(_negative_scan(both, most), _FOUND), most)
        positives = alike.select("anchor", F.col("rank").alias("k"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
        found = unlike.select("anchor", "k", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
        pairs = stored(positives.join(found, ["anchor", "k"]))
        out = pairs if out is None else out.union(pairs)
    names = asking.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id"))
    return out.join(names, "anchor").select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def _triples(alike: DataFrame) -> Iterator[tuple[int, int, int]]:
    table = alike.select("anchor", "rank", "score").toArrow()
    return zip(*(table.column(c).to_pylist() for c in ("anchor", "rank", "score")), strict=True)
