"""Helpers of several operators: row keys, repeated rows, words in byte buffers."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes of ASCII blanks: a word is what stands between them.
BLANKS = b" \t\n\x0b\x0c\r"
#: Words of letters and digits: every other ASCII character separates them.
WORD_PATTERN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The regular expression of words between blanks, for SQL functions.
BLANK_WORD_PATTERN = r"[^\x20\x09-\x0D]+"

_PIECE = 1 << 20
_BASE = 0x9E3779B97F4A7C15


def row_keys(*columns: str) -> list[Column]:
    """96 bits that tell a row from all with other values in ``columns``: id and text by default.

    Both hashes pass over nulls, so each column goes with whether it is null.
    """
    marked = [x for c in columns or ("doc_id", "text") for x in (F.isnull(c), F.col(c))]
    return [F.xxhash64(*marked).alias("_key1"), F.hash(*reversed(marked)).alias("_key2")]


KEYS = ["_key1", "_key2"]


def keyed(docs: DataFrame, *columns: str) -> DataFrame:
    """``(row, _key1, _key2)``: rows as one column each, so that no name of theirs meets another."""
    whole = F.struct(*(F.col("`" + c.replace("`", "``") + "`") for c in docs.columns))
    return docs.select(whole.alias("row"), *row_keys(*columns))


def one_of_each(rows: DataFrame) -> DataFrame:
    """One ``row`` for each pair of keys; merged before the shuffle, so copies don't pile up."""
    return rows.groupBy(*KEYS).agg(F.first("row").alias("row"))


def batches_of(batch: pa.RecordBatch, column: str, most_bytes: int = 1 << 22):
    """Slices of a batch with about ``most_bytes`` of text each, one row at least."""
    sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0)
    ends = np.cumsum(sizes.to_numpy(zero_copy_only=False).astype(np.int64))
    begin = 0
    while begin < batch.num_rows:
        before = ends[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, before + most_bytes, side="right")))
        yield batch.slice(begin, end - begin)
        begin = end


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in a row, and where each begins and ends; null is empty."""
    column = column.cast(pa.large_string())
    column = pa.compute.fill_null(column, "")
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)
    offsets = offsets[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    flat = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return flat[offsets[0] : offsets[-1]], offsets - offsets[0]


def lower_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[ord("A") : ord("Z") + 1] += 32
    return table


def word_table() -> np.ndarray:
    """True for bytes of words: digits, small letters, and all beyond ASCII."""
    table = np.zeros(256, dtype=bool)
    table[ord("0") : ord("9") + 1] = True
    table[ord("a") : ord("z") + 1] = True
    table[128:] = True
    return table


def word_spans(flat: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where words begin and end in lower-cased bytes; none spans two texts."""
    inside = word_table()[flat]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(flat))]
    begins[edges] = inside[edges]
    ends[edges - 1] = inside[edges - 1]
    return np.flatnonzero(begins), np.flatnonzero(ends) + 1


def word_hashes(flat: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the words, computed for a piece of the bytes at a time."""
    out = np.empty(len(begins), dtype=np.uint64)
    first = 0
    with np.errstate(over="ignore"):
        while first < len(begins):
            start = begins[first]
            last = max(first + 1, int(np.searchsorted(ends, start + _PIECE, side="right")))
            stop = int(ends[last - 1])
            powers = np.full(stop - start + 1, _BASE, dtype=np.uint64)
            powers[0] = 1
            powers = np.multiply.accumulate(powers)
            sums = np.zeros(stop - start + 1, dtype=np.uint64)
            np.cumsum((flat[start:stop].astype(np.uint64) + np.uint64(1)) * powers[:-1], out=sums[1:])
            at, to = begins[first:last] - start, ends[first:last] - start
            # Multiplied up to one common power instead of divided by each word's own.
            value = (sums[to] - sums[at]) * powers[len(powers) - 1 - at]
            value *= np.uint64(pow(pow(_BASE, int(stop - start), 1 << 64), -1, 1 << 64))
            value ^= value >> np.uint64(32)
            value *= np.uint64(0xD6E8FEB86659FD93)
            value ^= value >> np.uint64(29)
            out[first:last] = value
            first = last
    return out


def token_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-cased words of all texts, and each text's first word."""
    flat, offsets = text_bytes(column)
    flat = lower_table()[flat]
    begins, ends = word_spans(flat, offsets)
    return word_hashes(flat, begins, ends), np.searchsorted(begins, offsets)
