"""Stupid-backoff language model scores of documents, n-grams counted and looked up slice by slice.

The score of a word after its predecessors is the share of the n-gram in its
context; where the model has not seen the n-gram, ``BACKOFF`` times the score after one
word fewer. Different texts are packed into blocks. A block sends each different n-gram of
its own once, with its count, to the bucket of the n-gram's hash; the bucket adds up
what all blocks send and answers each with the sums, from which the block scores its
words. Buckets are done a slice at a time, so that the disk holds the n-grams of one slice only.
"""

from __future__ import annotations

from functools import reduce
from math import ceil, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stopweave.llm.common import KEYS, batches_of, lower_table, row_keys, text_bytes, token_hashes, word_spans
from stopweave.session import shuffles_dropped, stored

ORDER = 3
BACKOFF = 0.4
#: Parts in which the n-grams are counted, one after the other; each reads all texts again.
SLICES = 4
#: Bytes of text in a block, and for which there is a bucket; least number of buckets.
BLOCK = 1 << 22
BUCKET = 1 << 23
LEAST_BUCKETS = 256
_MIX = 0x9E3779B97F4A7C15
_BLOCKS = "_key1 bigint, _key2 int, keys1 array<bigint>, keys2 array<int>, texts array<string>, copies array<bigint>, wanted array<boolean>, bytes bigint, words bigint"
_REQUESTS = "n int, bucket int, _key1 bigint, _key2 int, grams binary, counts binary, width int, wanted boolean"
_ANSWERS = "_key1 bigint, _key2 int, n int, bucket int, counts binary, width int"
_SCORES = "_key1 bigint, _key2 int, n_words bigint, log_score double"


def _grams(hashes: np.ndarray, firsts: np.ndarray, order: int):
    """For orders 1 to ``order``: a hash of the n-gram that ends at each word, 0 if it would begin before the text."""
    starts = np.repeat(firsts[:-1], np.diff(firsts))
    place = np.arange(len(hashes)) - starts
    grams = hashes | np.uint64(1)
    yield grams
    for n in range(2, order + 1):
        longer = np.zeros(len(hashes), np.uint64)
        with np.errstate(over="ignore"):
            mixed = (grams[:-1] * np.uint64(_MIX)) ^ (hashes[1:] + np.uint64(n))
            mixed ^= mixed >> np.uint64(31)
            longer[1:] = mixed * np.uint64(_MIX) | np.uint64(1)
        longer[place < n - 1] = 0
        grams = longer
        yield grams


def _block(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    """All rows as one, named by the keys of its first text."""
    rows = pa.Table.from_batches(batches).combine_chunks()
    flat, offsets = text_bytes(rows["text"])
    firsts = np.searchsorted(word_spans(lower_table()[flat], offsets)[0], offsets)
    words = int((np.diff(firsts) * rows["copies"].to_numpy()).sum())
    listed = [pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), rows[c].combine_chunks()) for c in (*KEYS, "text", "copies", "wanted")]
    sums = [pa.array([x], pa.int64()) for x in (len(flat), words)]
    return pa.RecordBatch.from_arrays(
        [*(rows[c].slice(0, 1).combine_chunks() for c in KEYS), *listed, *sums],
        names=[*KEYS, "keys1", "keys2", "texts", "copies", "wanted", "bytes", "words"],
    )


def _blocks(batches, most_bytes: int):
    waiting, size = [], 0
    for whole in batches:
        for batch in batches_of(whole, "text", most_bytes):
            more = batch.column("text").nbytes
            if waiting and size + more > most_bytes:
                yield _block(waiting)
                waiting, size = [], 0
            waiting.append(batch)
            size += more
    if waiting:
        yield _block(waiting)


def text_blocks(docs: DataFrame, corpus: DataFrame, block: int = BLOCK) -> DataFrame:
    """Rows of about ``block`` bytes: different texts, how often ``corpus`` has each, and whether ``docs`` has it."""
    text = F.col("text").cast("string").alias("text")
    if corpus is docs:
        rows = docs.select(text, F.lit(1).alias("copies"), F.lit(True).alias("wanted"))
    else:
        rows = docs.select(text, F.lit(0).alias("copies"), F.lit(True).alias("wanted")).unionAll(
            corpus.select(text, F.lit(1).alias("copies"), F.lit(False).alias("wanted"))
        )
    texts = rows.groupBy(*row_keys("text")).agg(
        F.first("text").alias("text"), F.sum("copies").alias("copies"), F.max("wanted").alias("wanted")
    )
    return texts.mapInArrow(lambda b: _blocks(b, block), _BLOCKS)


def _written(arrays: list[np.ndarray]) -> list[pa.Array]:
    """Counts in as few bytes as the largest of each array needs, and that width."""
    narrow = [x.astype(np.min_scalar_type(x.max())) for x in arrays]
    return [pa.array([x.tobytes() for x in narrow], pa.binary()), pa.array([x.itemsize for x in narrow], pa.int32())]


def _read(table: pa.Table) -> list[np.ndarray]:
    return [np.frombuffer(x.as_buffer(), f"u{width}").astype(np.int64) for x, width in zip(table["counts"], table["width"].to_pylist())]


def _runs(sorted_values: np.ndarray) -> np.ndarray:
    """Where each run of equal values begins."""
    return np.flatnonzero(np.r_[True, sorted_values[1:] != sorted_values[:-1]][: len(sorted_values)])


def _requests(batches, order: int, buckets: int, first: int, last: int):
    """The n-grams of each block in buckets ``first`` to ``last - 1``, ascending, with their counts in the corpus.

    A bucket is a range of hashes.
    """
    edges = np.array([b * 2**64 // buckets for b in range(buckets)], np.uint64)
    for batch in batches:
        for at in range(batch.num_rows):
            block = {c: batch.column(c)[at] for c in batch.schema.names}
            hashes, firsts = token_hashes(block["texts"].values)
            copies = np.repeat(block["copies"].values.to_numpy(), np.diff(firsts))
            wanted = bool(block["wanted"].values.true_count)
            for n, grams in enumerate(_grams(hashes, firsts, order), 1):
                chosen = (grams != 0) & (grams >= edges[first])
                if last < buckets:
                    chosen &= grams < edges[last]
                keys = grams[chosen]
                ordered = np.argsort(keys)
                keys = keys[ordered]
                begins = _runs(keys)
                if not len(begins):
                    continue
                counts = np.add.reduceat(copies[chosen][ordered], begins)
                keys = keys[begins]
                cuts = [*np.searchsorted(keys, edges[first:last]).tolist(), len(keys)]
                there = [b for b in range(last - first) if cuts[b] < cuts[b + 1]]
                size = len(there)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([n] * size, pa.int32()), pa.array([first + b for b in there], pa.int32()),
                        pa.array([block["_key1"].as_py()] * size, pa.int64()), pa.array([block["_key2"].as_py()] * size, pa.int32()),
                        pa.array([keys[cuts[b] : cuts[b + 1]].tobytes() for b in there], pa.binary()),
                        *_written([counts[cuts[b] : cuts[b + 1]] for b in there]),
                        pa.array([wanted] * size),
                    ],
                    names=["n", "bucket", *KEYS, "grams", "counts", "width", "wanted"],
                )


def _answers(table: pa.Table) -> pa.Table:
    """For each block that has texts to score, the counts in the whole corpus of the n-grams it sent, in its order."""
    sent = [np.frombuffer(x.as_buffer(), np.uint64) for x in table["grams"]]
    grams, counts = np.concatenate(sent), np.concatenate(_read(table))
    ordered = np.argsort(grams)
    begins = _runs(grams[ordered])
    sums = np.add.reduceat(counts[ordered], begins)
    whole = np.empty(len(grams), np.int64)
    whole[ordered] = np.repeat(sums, np.diff(np.r_[begins, len(grams)]))
    ends = np.cumsum([len(x) for x in sent])
    answers = table.select([*KEYS, "n", "bucket"])
    for name, column in zip(("counts", "width"), _written(np.split(whole, ends[:-1]))):
        answers = answers.append_column(name, column)
    return answers.filter(table["wanted"])


def _scores(blocks: pa.Table, answers: pa.Table, total: int, order: int, backoff: float) -> pa.Table:
    """The wanted texts of a block, scored by the answers of all buckets."""
    answers = answers.sort_by([("n", "ascending"), ("bucket", "ascending")])
    block = {c: blocks[c][0] for c in blocks.column_names}
    hashes, firsts = token_hashes(block["texts"].values)
    score = np.full(len(hashes), log(1 / total) + (order - 1) * log(backoff))
    shorter = np.full(len(hashes) + 1, total)
    for n, grams in enumerate(_grams(hashes, firsts, order), 1):
        there = grams != 0
        known = np.concatenate([np.zeros(0, np.int64), *_read(answers.filter(pa.compute.equal(answers["n"], n)))])
        counts = np.zeros(len(grams), np.int64)
        counts[there] = known[np.unique(grams[there], return_inverse=True)[1]]
        seen = counts > 0
        score[seen] = np.log(counts[seen] / shorter[: len(grams)][seen]) + (order - n) * log(backoff)
        shorter = np.r_[0, counts]
    sizes = np.diff(firsts)
    sums = np.bincount(np.repeat(np.arange(len(sizes)), sizes), weights=score, minlength=len(sizes))
    columns = [block["keys1"].values, block["keys2"].values, pa.array(sizes, pa.int64()), pa.array(sums, pa.float64())]
    return pa.table(columns, names=[*KEYS, "n_words", "log_score"]).filter(block["wanted"].values)


def score_documents(
    docs: DataFrame, corpus: DataFrame, order: int = ORDER, backoff: float = BACKOFF, slices: int = SLICES, block: int = BLOCK
) -> DataFrame:
    """``(doc_id, n_words, log_score, mean_log_score)`` for each row of ``docs(doc_id, text)``.

    The model counts all of ``corpus(text)``. A word the model has never seen scores as if
    seen once. Null and empty texts have no words, a sum of 0 and no mean. Equal texts get equal scores.
    """
    with shuffles_dropped(docs.sparkSession):
        blocks = stored(text_blocks(docs, corpus, block))
        size, total = (x or 1 for x in blocks.agg(F.sum("bytes"), F.sum("words")).first())
        buckets = max(LEAST_BUCKETS, slices, ceil(size / BUCKET))
        edges = [s * buckets // slices for s in range(slices + 1)]
        parts = []
        for first, last in zip(edges, edges[1:]):
            sent = blocks.select(*KEYS, "texts", "copies", "wanted").mapInArrow(
                lambda b, first=first, last=last: _requests(b, order, buckets, first, last), _REQUESTS
            )
            parts.append(stored(sent.groupBy("n", "bucket").applyInArrow(_answers, _ANSWERS)))
        wanted = blocks.where(F.exists("wanted", lambda x: x)).drop("copies", "bytes", "words")
        answers = reduce(DataFrame.unionAll, parts)
        scored = wanted.groupBy(*KEYS).cogroup(answers.groupBy(*KEYS)).applyInArrow(
            lambda b, a: _scores(b, a, total, order, backoff), _SCORES
        )
        scores = stored(scored)
    named = docs.select("doc_id", F.col("text").cast("string").alias("text")).select("doc_id", *row_keys("text"))
    joined = named.join(scores, KEYS, "left")
    return joined.select("doc_id", "n_words", "log_score", F.when(F.col("n_words") > 0, F.col("log_score") / F.col("n_words")).alias("mean_log_score"))
