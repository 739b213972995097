"""Benchmark passages in documents, found with a positional inverted index.

The index holds where in which document the anchor terms stand: of each window
of benchmark words, the terms that are rarest over all documents. Shifted by their
place in the benchmark item, the lists of two anchors meet where a document may repeat the window;
there the words themselves are compared. The same index gives proximity matches: places where most of
the rarest terms of a block of benchmark words stand close together, in any order.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stopweave.llm.common import KEYS, WORD_PATTERN, batches_of, row_keys, token_hashes
from stopweave.session import stored

WINDOW = 10
#: Rarest terms that stand for a window; a place needs as many of them.
ANCHORS = 2
#: Rarest different terms that stand for a block in proximity matches, how many of them have
#: to be near one another, and how many words longer than the block the place may be.
TERMS = 5
NEEDED = 4
SLACK = 5
#: Pairs of a rare term's place and a block looked at in one step.
PROBES = 1 << 15
#: Benchmark words whose terms are looked for in one pass over the documents.
WORDS_AT_ONCE = 2_000_000


def words_of(text: str | None) -> list[str]:
    """Words of a text after lower-casing A-Z; null has none."""
    if not text:
        return []
    lowered = text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
    return regex.findall(WORD_PATTERN, lowered)


def _term_counts(batches, vocabulary):
    """Words of each row, and how often each term of the vocabulary occurs in a batch."""
    terms = np.sort(vocabulary.value)
    for whole in batches:
        for batch in batches_of(whole, "text"):
            hashes, firsts = token_hashes(batch.column("text"))
            counts = np.diff(firsts)
            at = np.minimum(np.searchsorted(terms, hashes), len(terms) - 1)
            found, n = np.unique(at[terms[at] == hashes], return_counts=True) if len(terms) else ([], [])
            rows = batch.num_rows
            nothing = [None] * len(found)
            yield pa.RecordBatch.from_arrays(
                [pa.concat_arrays([batch.column(c), pa.array(nothing, batch.column(c).type)]) for c in ("doc_id", *KEYS)]
                + [
                    pa.array([*counts.tolist(), *nothing], pa.int64()),
                    pa.array([None] * rows + (terms[found].view(np.int64).tolist() if len(found) else []), pa.int64()),
                    pa.array([None] * rows + list(map(int, n)), pa.int64()),
                ],
                names=["doc_id", *KEYS, "n_words", "term", "n"],
            )


def _postings(batches, anchors):
    """Where in which row the anchor terms stand."""
    terms = np.sort(anchors.value)
    for whole in batches:
        for batch in batches_of(whole, "text"):
            hashes, firsts = token_hashes(batch.column("text"))
            at = np.minimum(np.searchsorted(terms, hashes), len(terms) - 1)
            hit = np.flatnonzero(terms[at] == hashes)
            row = np.searchsorted(firsts, hit, side="right") - 1
            columns = [batch.column(c).take(pa.array(row)) for c in KEYS]
            places = [pa.array(hashes[hit].view(np.int64)), pa.array(hit - firsts[row])]
            yield pa.RecordBatch.from_arrays([*columns, *places], names=[*KEYS, "term", "pos"])


def _item_words(batches):
    for batch in batches:
        hashes, firsts = token_hashes(batch.column("text"))
        counts = np.diff(firsts)
        lists = pa.ListArray.from_arrays(pa.array(firsts, pa.int32()), pa.array(hashes.view(np.int64)))
        yield pa.RecordBatch.from_arrays(
            [batch.column("item_id"), batch.column("text"), lists, pa.array(counts)],
            names=["item_id", "text", "terms", "n"],
        )


def benchmark_items(benchmark: DataFrame) -> DataFrame:
    """``(item, item_id, text, terms, n)`` of each different item with words."""
    plain = benchmark.select(F.col("item_id").cast("string"), F.col("text").cast("string").alias("text")).distinct()
    split = plain.mapInArrow(_item_words, "item_id string, text string, terms array<bigint>, n bigint")
    return split.where("n > 0").withColumn("item", F.xxhash64("item_id", "text"))


def anchor_places(items: DataFrame, counts: DataFrame, window: int, anchors: int) -> DataFrame:
    """``(item, term, offset, need)``: the rarest terms of each window of each item.

    ``need``: as many different places as any window of the item has anchors.
    Words that no document holds rule their windows out.
    """
    spread = items.select("item", "n", F.posexplode("terms").alias("offset", "term"))
    counted = spread.join(counts, "term", "left").select("item", "n", "offset", "term", F.coalesce("c", F.lit(0)).alias("c"))
    ranked = counted.groupBy("item", "n").agg(F.array_sort(F.collect_list(F.struct("offset", "c", "term"))).alias("words"))
    size = F.least(F.col("n"), F.lit(window)).cast("int")
    parts = ranked.select(
        "item", "n", F.explode(F.sequence(F.lit(1), (F.col("n") - size + 1).cast("int"))).alias("start"), "words", size.alias("size")
    ).select("item", "n", F.slice("words", F.col("start"), F.col("size")).alias("words"))
    # Of equally rare words, as where one is repeated, neighbouring windows choose the same places.
    aligned = F.transform(
        "words", lambda w: F.struct(w["c"].alias("c"), (w["offset"] % window).alias("turn"), w["offset"].alias("offset"), w["term"].alias("term"))
    )
    rarest = F.slice(F.array_sort(aligned), 1, anchors)
    chosen = parts.select("item", "n", rarest.alias("rarest")).where(F.col("rarest")[0]["c"] > 0)
    need = F.least(F.col("n"), F.lit(anchors))
    return chosen.select("item", need.alias("need"), F.inline("rarest")).select("item", "term", F.col("offset").cast("bigint"), "need").distinct()


def near_blocks(items: DataFrame, counts: DataFrame, window: int, terms: int, needed: int) -> DataFrame:
    """``(block, item_id, offset, size, need, terms)``: the rarest different terms of consecutive blocks of each item.

    Blocks have ``window`` words; an item's last one reaches back to have as many, if the item has.
    Blocks of one word repeated are left to exact phrases. Blocks with equal terms are one ``block``.
    """
    spread = items.select("item", "item_id", "n", F.posexplode("terms").alias("offset", "term"))
    counted = spread.join(counts, "term", "left").withColumn("c", F.coalesce("c", F.lit(0)))
    ranked = counted.groupBy("item", "item_id", "n").agg(F.array_sort(F.collect_list(F.struct("offset", "c", "term"))).alias("words"))
    size = F.least(F.col("n"), F.lit(window)).cast("int")
    starts = F.array_distinct(F.transform(F.sequence(F.lit(0), F.col("n") - 1, F.lit(window).cast("bigint")), lambda x: F.least(x, F.col("n") - size)))
    parts = ranked.select("item_id", "words", size.alias("size"), F.explode(starts.cast("array<int>")).alias("offset"))
    words = F.slice("words", F.col("offset") + 1, F.col("size"))
    different = F.array_sort(F.array_distinct(F.transform(words, lambda w: F.struct(w["c"].alias("c"), w["term"].alias("term")))))
    chosen = parts.select("item_id", "offset", "size", F.slice(different, 1, terms).alias("rarest")).where(F.size("rarest") > 1)
    need = F.least(F.size("rarest"), F.lit(needed))
    blocks = chosen.select("item_id", "offset", "size", need.alias("need"), F.transform("rarest", lambda x: x["term"]).alias("terms"))
    return blocks.withColumn("block", F.xxhash64("size", "need", "terms"))


def _block_table(plain: list) -> tuple:
    """Blocks as arrays: their terms by number, and for each term the blocks that have it among their rarest.

    A match may lack a few of a block's terms, so it holds one of the first few.
    """
    terms = np.unique(np.array([t for row in plain for t in row.terms], np.int64).view(np.uint64))
    members = np.full((len(plain), max(len(row.terms) for row in plain)), -2, np.int64)
    for k, row in enumerate(plain):
        members[k, : len(row.terms)] = np.searchsorted(terms, np.array(row.terms, np.int64).view(np.uint64))
    first = [(members[k, j], k) for k, row in enumerate(plain) for j in range(len(row.terms) - row.need + 1)]
    term, block = np.array(sorted(first), np.int64).T
    ids, span, need = (np.array([row[c] for row in plain], np.int64) for c in ("block", "span", "need"))
    return terms, ids, members, need, span, np.searchsorted(term, np.arange(len(terms) + 1)), block


def _near_postings(batches, table):
    """Postings of blocks' terms, only from where enough of a block's terms stand around one of its rarest."""
    terms, block_ids, members, need, span, firsts_of, blocks_of = table.value
    steps = np.arange(1 - int(span.max()), int(span.max()))
    for whole in batches:
        for batch in batches_of(whole, "text"):
            hashes, firsts = token_hashes(batch.column("text"))
            at = np.minimum(np.searchsorted(terms, hashes), len(terms) - 1)
            ids = np.where(terms[at] == hashes, at, -1)
            n = np.where(ids >= 0, firsts_of[ids + 1] - firsts_of[ids], 0)
            hits = np.flatnonzero(n)
            n, ends = n[hits], np.cumsum(n[hits])
            begin = 0
            while begin < len(hits):
                before = ends[begin] - n[begin]
                end = max(begin + 1, int(np.searchsorted(ends, before + PROBES, side="right")))
                times = n[begin:end]
                word = np.repeat(hits[begin:end], times)
                turn = np.arange(len(word)) - np.repeat(ends[begin:end] - times - before, times)
                block = blocks_of[firsts_of[ids[word]] + turn]
                row = np.searchsorted(firsts, word, side="right") - 1
                where = word[:, None] + steps
                inside = (where >= firsts[row][:, None]) & (where < firsts[row + 1][:, None]) & (np.abs(steps) < span[block][:, None])
                near = np.where(inside, ids[np.clip(where, 0, len(ids) - 1)], -1)
                held, different = np.zeros(near.shape, bool), np.zeros(len(word), np.int64)
                for member in members[block].T:
                    there = near == member[:, None]
                    held |= there
                    different += there.any(axis=1)
                held &= (different >= need[block])[:, None]
                i, j = np.nonzero(held)
                begin = end
                if not len(i):
                    continue
                place, found = np.unique(np.stack([where[i, j], block[i]], axis=1), axis=0).T
                row = np.searchsorted(firsts, place, side="right") - 1
                yield pa.RecordBatch.from_arrays(
                    [batch.column(c).take(pa.array(row)) for c in KEYS]
                    + [pa.array(block_ids[found]), pa.array(hashes[place].view(np.int64)), pa.array(place - firsts[row])],
                    names=[*KEYS, "block", "term", "pos"],
                )


def _near(plain: DataFrame, blocks: DataFrame, slack: int) -> DataFrame | None:
    """Runs of words of each row in which every match of a block begins and ends; nothing if there are no blocks.

    A row's postings of a block are at most its words, and a window's frame at most a place's words.
    The blocks that go to every task are bounded by ``WORDS_AT_ONCE``.
    """
    needs = blocks.select("block", (F.col("size") + slack).alias("span"), "need", "terms").dropDuplicates(["block"])
    rows = needs.collect()
    if not rows:
        return None
    table = plain.sparkSession.sparkContext.broadcast(_block_table(rows))
    index = plain.mapInArrow(lambda batches: _near_postings(batches, table), "_key1 bigint, _key2 int, block bigint, term bigint, pos bigint")
    index = stored(index)
    widest = max(row.span for row in rows)
    posted = index.distinct().join(needs.select("block", "span", "need"), "block")
    group = [*KEYS, "block"]
    frame = Window.partitionBy(*group).orderBy("pos").rangeBetween(1 - widest, 0)
    # The frame is as wide as the widest block; shorter blocks look at its last part.
    seen = F.filter(F.collect_list(F.struct("pos", "term")).over(frame), lambda x: x["pos"] > F.col("pos") - F.col("span"))
    matched = posted.withColumn("seen", seen).where(F.size(F.array_distinct(F.transform("seen", lambda x: x["term"]))) >= F.col("need"))
    ends = matched.select(*group, "span", F.array_min(F.transform("seen", lambda x: x["pos"])).alias("from"), F.col("pos").alias("to"))
    before = Window.partitionBy(*group).orderBy("to")
    new = F.coalesce((F.col("from") > F.lag("to").over(before)).cast("int"), F.lit(1))
    runs = ends.withColumn("new", new).withColumn("run", F.sum("new").over(before.rowsBetween(Window.unboundedPreceding, 0)))
    return runs.groupBy(*group, "run", "span").agg(F.min("from").alias("start"), (F.max("to") + 1).alias("stop"))


def _windows_in(words: list[str], item: list[str], starts: list[int], size: int) -> list[tuple[int, int]]:
    """Where windows of the item stand among the words: runs compared at the starts, or, if these are many, window by window."""
    found = []
    if len(starts) * len(item) > len(words) + len(item):
        windows = {tuple(item[k : k + size]) for k in range(len(item) - size + 1)}
        firsts = {window[0] for window in windows}
        for k in range(len(words) - size + 1):
            if words[k] in firsts and tuple(words[k : k + size]) in windows:
                found.append((k, k + size))
    else:
        for start in starts:
            low, high = max(0, -start), min(len(item), len(words) - start)
            run = 0
            for k in range(low, high + 1):
                if k < high and words[start + k] == item[k]:
                    run += 1
                    continue
                if run >= size:
                    found.append((start + k - run, start + k))
                run = 0
    runs: list[tuple[int, int]] = []
    for begin, end in sorted(found):
        if runs and begin <= runs[-1][1]:
            runs[-1] = (runs[-1][0], max(end, runs[-1][1]))
        else:
            runs.append((begin, end))
    return runs


def _hits(rows: pd.DataFrame, window: int) -> tuple[list, list, list]:
    """Hit words and found items of documents, by comparing words at the candidate places."""
    n_hit, found, spans = [], [], []
    for text, candidates in zip(rows["text"], rows["candidates"], strict=True):
        words = words_of(text)
        marked = np.zeros(len(words) + 1, np.int64)
        ids, places = set(), []
        for candidate in candidates:
            item_id, item = candidate["item_id"], words_of(candidate["text"])
            for begin, end in _windows_in(words, item, [*map(int, candidate["starts"])], min(window, len(item))):
                marked[begin] += 1
                marked[end] -= 1
                ids.add(item_id or "")
                places.append((item_id, begin, end))
        n_hit.append(int((np.cumsum(marked) > 0).sum()))
        found.append(sorted(ids))
        spans.append(places)
    return n_hit, found, spans


def _verified(frames, window: int):
    for rows in frames:
        n_hit, found, spans = _hits(rows, window)
        yield rows[KEYS].assign(n_hit=n_hit, items=found, spans=spans)


def _slices(items: DataFrame, most: int):
    """The items in parts of at most about ``most`` words, by hash."""
    total = items.agg(F.sum("n")).first()[0] or 0
    parts = -(-total // most)
    for k in range(parts):
        yield items.where(F.pmod("item", F.lit(parts)) == k) if parts > 1 else items


def _indexes(plain: DataFrame, benchmark: DataFrame):
    """For each part of the benchmark's items: the part, the rows' sizes with counts of its terms, and a maker of postings.

    The vocabulary of a part, bounded by ``WORDS_AT_ONCE``, goes to every task.
    """
    items = stored(benchmark_items(benchmark))
    context = plain.sparkSession.sparkContext
    kind = plain.schema["doc_id"].dataType.simpleString()

    def postings(terms: DataFrame) -> DataFrame | None:
        wanted = np.array([x for (x,) in terms.distinct().collect()], np.int64)
        if not len(wanted):
            return None
        looked = context.broadcast(wanted.view(np.uint64))
        return stored(plain.mapInArrow(lambda batches: _postings(batches, looked), "_key1 bigint, _key2 int, term bigint, pos bigint"))

    for part in [*_slices(items, WORDS_AT_ONCE)] or [items]:
        terms = np.array([x for (x,) in part.select(F.explode("terms")).distinct().collect()], np.int64)
        vocabulary = context.broadcast(terms.view(np.uint64))
        counted = stored(
            plain.mapInArrow(
                lambda batches, v=vocabulary: _term_counts(batches, v),
                f"doc_id {kind}, _key1 bigint, _key2 int, n_words bigint, term bigint, n bigint",
            )
        )
        yield part, counted, counted.where("term IS NOT NULL").groupBy("term").agg(F.sum("n").alias("c")), postings


def _plain(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.col("text").cast("string").alias("text"), *row_keys())


def find_near(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, terms: int = TERMS, needed: int = NEEDED, slack: int = SLACK
) -> DataFrame:
    """``(doc_id, _key1, _key2, item_id, offset, start, stop, span)``: proximity matches in ``docs(doc_id, text)``.

    ``benchmark(item_id, text)`` is cut into blocks of ``window`` words, the last one of an item ending with it.
    A block matches where ``span`` consecutive words of a document, its size and ``slack`` more, hold ``needed`` of its
    ``terms`` rarest different words (all, if it has fewer), in any order. Matches that share words are one run from ``start``
    to before ``stop``, which begins and ends with such a word; ``offset`` is the block's place in the item. Blocks of one
    word repeated never match, nor do null and empty texts. Equal rows get equal matches, a row each.
    """
    plain = _plain(docs)
    found = _near_matches(plain, _indexes(plain, benchmark), window, terms, needed, slack)
    return plain.select("doc_id", *KEYS).join(found, KEYS).select("doc_id", *found.columns)


def _near_matches(plain: DataFrame, parts, window: int, terms: int, needed: int, slack: int) -> DataFrame:
    found = None
    for part, _, counts, _ in parts:
        blocks = stored(near_blocks(part, counts, window, terms, needed))
        found_runs = _near(plain, blocks, slack)
        if found_runs is None:
            continue
        runs = found_runs.join(blocks.select("block", "item_id", "offset").distinct(), "block")
        runs = runs.select(*KEYS, "item_id", F.col("offset").cast("bigint").alias("offset"), "start", "stop", F.col("span").cast("bigint").alias("span"))
        found = runs if found is None else found.union(runs)
    if found is None:
        empty = "_key1 bigint, _key2 int, item_id string, offset bigint, start bigint, stop bigint, span bigint"
        found = plain.sparkSession.createDataFrame([], empty)
    return found


def find_passages(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, anchors: int = ANCHORS) -> DataFrame:
    """``(doc_id, _key1, _key2, n_words, n_hit, items, spans)`` for each row of ``docs(doc_id, text)``.

    ``benchmark(item_id, text)``. A window is ``window`` consecutive words of an
    item, or all of a shorter item's; ``n_hit`` counts the row's words inside
    occurrences of windows, ``items`` are the ids of the items found, as sorted
    strings, and ``spans`` the runs of words ``(item_id, from, to)``. Null and empty
    texts have no words and no hits; items without words are never found; a
    null ``item_id`` is written as an empty string. Equal rows get equal results.
    """
    plain = _plain(docs)
    return _passages(plain, _indexes(plain, benchmark), window, anchors)


def _passages(plain: DataFrame, parts, window: int, anchors: int) -> DataFrame:
    rows, matches = None, None
    for part, counted, counts, postings in parts:
        rows = counted.where("n_words IS NOT NULL").drop("term", "n") if rows is None else rows
        places = stored(anchor_places(part, counts, window, anchors))
        index = postings(places.select("term"))
        if index is None:
            continue
        met = (
            index.join(places, "term")
            .groupBy(*KEYS, "item", (F.col("pos") - F.col("offset")).alias("start"))
            .agg(F.count_distinct("offset").alias("met"), F.first("need").alias("need"))
            .where("met >= need")
        )
        met = met.groupBy(*KEYS, "item").agg(F.sort_array(F.collect_set("start")).alias("starts"))
        named = met.join(part.select("item", "item_id", "text"), "item")
        matches = named if matches is None else matches.union(named)
    if matches is None:
        return rows.select("*", F.lit(0).cast("bigint").alias("n_hit"), F.array().cast("array<string>").alias("items"), F.array().cast("array<struct<item_id:string,start:bigint,stop:bigint>>").alias("spans"))
    candidates = stored(matches.groupBy(*KEYS).agg(F.collect_list(F.struct("item_id", "text", "starts")).alias("candidates")))
    texts = plain.select(*KEYS, "text").join(candidates, KEYS)
    checked = texts.mapInPandas(
        lambda frames: _verified(frames, window),
        "_key1 bigint, _key2 int, n_hit bigint, items array<string>, spans array<struct<item_id:string,start:bigint,stop:bigint>>",
    )
    checked = stored(checked.where("n_hit > 0").dropDuplicates(KEYS))
    return rows.join(checked, KEYS, "left").select(
        "doc_id", *KEYS, "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"), "spans",
    )


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``(doc_id, n_words, n_hit, n_items, items_sha256, contaminated, n_near)`` for each row.

    ``n_near``: items with proximity matches; those of exact phrases are mostly among them.
    """
    plain = _plain(docs)
    parts = [*_indexes(plain, benchmark)]
    near = _near_matches(plain, parts, WINDOW, TERMS, NEEDED, SLACK)
    near = near.groupBy(*KEYS).agg(F.count_distinct(F.coalesce("item_id", F.lit(""))).alias("n_near"))
    return _passages(plain, parts, WINDOW, ANCHORS).join(near, KEYS, "left").select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
    )
