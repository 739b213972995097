"""Secrets in documents: candidates by pattern, false positives removed by a random forest.

Candidates are long strings, and whatever is assigned to a name such as ``token``. The forest sees their length, changes between
kinds of characters, how much of them dictionary words cover, the source they came
from and the words around them, and learns from labelled findings.
"""

from __future__ import annotations

import zlib
from collections import Counter

import pyarrow as pa
import regex
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stopweave.llm.common import batches_of
from stopweave.session import stored

#: Long strings; an equals sign only pads their end.
CANDIDATE = regex.compile(r"(?<![A-Za-z0-9_])(?=[_+/\-]*[A-Za-z0-9])[A-Za-z0-9_+/\-]{12,}+(?:={1,2}+(?![^\s\"'`,;.)\]}]))?")
LETTERS = regex.compile(r"[a-z]{3,}")
WORDS = regex.compile(r"[^\W\d_]{2,}")
#: The assignment that marks a finding as a real secret where no labels are given. Names may
#: be parts of longer ones and quoted; values are of any characters, up to the closing quote if quoted.
ASSIGNMENT = regex.compile(
    r"""(?i)(?:token|secret|password|passwd|api[_-]?key)(?:[_-][a-z0-9_-]*+)?["'`]?\s*+(?::=|=>|[=:])\s*+"""
    r"""(?:"(?P<value>(?:[^"\\\n]|\\.){4,}+)"|'(?P<value>(?:[^'\\\n]|\\.){4,}+)'|["'`]?(?P<value>(?:(?!&[\w.-]+=)[^\s"'`]){4,}+))"""
)
#: Marks of the sentence or list that a value without quotes stands in.
CLOSING = ",;.)]}>"
#: Words kept as dictionary: the most frequent ones of all documents.
DICTIONARY = 5000
#: Labelled findings to learn from, in expectation; of more, a sample by hash.
MOST_LABELLED = 20_000
WORD_BUCKETS = 16
TREES, DEPTH = 20, 6


def _word_counts(batches):
    for whole in batches:
        for batch in batches_of(whole, "text"):
            counts = Counter()
            for text in batch["text"].to_pylist():
                counts.update(LETTERS.findall((text or "").lower()))
            yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])


def dictionary(docs: DataFrame, most: int = DICTIONARY) -> list[str]:
    """The ``most`` words that all documents hold most often."""
    words = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(_word_counts, "word string, n bigint")
    top = words.groupBy("word").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "word").limit(most)
    return [word for (word,) in top.select("word").collect()]


def _kind(c: str) -> int:
    return 0 if c.isdigit() else 1 if c.islower() else 2 if c.isupper() else 3


def _bucket(word: str) -> int:
    return zlib.crc32(word.lower().encode()) % WORD_BUCKETS if word else -1


def describe(candidate: str, before: str, after: str, source: str | None, known: set) -> list[float]:
    """The features of a candidate between the texts before and after it."""
    kinds = [_kind(c) for c in candidate]
    n = len(candidate)
    covered = sum(len(w) for w in LETTERS.findall(candidate.lower()) if w in known)
    near = [(WORDS.findall(before) or [""])[-1], (WORDS.findall(after) or [""])[0]]
    values = [
        float(n),
        sum(a != b for a, b in zip(kinds, kinds[1:])) / n,
        *(kinds.count(k) / n for k in range(4)),
        len(set(candidate)) / n,
        covered / n,
        float(zlib.crc32((source or "").encode()) % WORD_BUCKETS),
        float(before.rstrip(" \"'")[-1:] in ("=", ":")),
    ]
    for word in near:
        place = _bucket(word)
        values += [float(place == k) for k in range(WORD_BUCKETS)]
    return values


def spans(text: str) -> list[tuple[int, int, bool]]:
    """Begin and end of each candidate of a text, and whether it is assigned to a name."""
    assigned = []
    for found in ASSIGNMENT.finditer(text):
        begin, end = found.span("value")
        if text[end : end + 1] not in ("'", '"'):
            end = begin + len(text[begin:end].rstrip(CLOSING))
        if end > begin:
            assigned.append((begin, end, True))
    at, kept = 0, []
    for found in CANDIDATE.finditer(text):
        while at < len(assigned) and assigned[at][1] <= found.start():
            at += 1
        if at == len(assigned) or found.end() <= assigned[at][0]:
            kept.append((*found.span(), False))
    return sorted(assigned + kept)


def _findings(batches, known_words):
    known = known_words.value
    for whole in batches:
        for batch in batches_of(whole, "text"):
            rows, begins, ends, marked, features = [], [], [], [], []
            for at, (text, source) in enumerate(zip(batch["text"].to_pylist(), batch["source"].to_pylist(), strict=True)):
                for begin, end, assigned in spans(text or ""):
                    before, after = text[max(0, begin - 60) : begin], text[end : end + 60]
                    rows.append(at)
                    begins.append(begin)
                    ends.append(end)
                    marked.append(int(assigned))
                    features.append(describe(text[begin:end], before, after, source, known))
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"].take(pa.array(rows, pa.int64())), pa.array(begins, pa.int64()), pa.array(ends, pa.int64()), pa.array(marked, pa.int32()), pa.array(features, pa.list_(pa.float64()))],
                names=["doc_id", "begin", "end", "marked", "features"],
            )


def candidates(docs: DataFrame) -> DataFrame:
    """``(doc_id, begin, end, marked, features)`` of every candidate in whole texts.

    ``docs(doc_id, text, source)``; null texts have none. ``marked``: it is assigned to
    a name such as ``token``. Long strings have 12 characters or more, assigned ones 4.
    """
    known = docs.sparkSession.sparkContext.broadcast(set(dictionary(docs)))
    plain = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.col("source").cast("string").alias("source"))
    kind = plain.schema["doc_id"].dataType.simpleString()
    return plain.mapInArrow(lambda b: _findings(b, known), f"doc_id {kind}, begin bigint, end bigint, marked int, features array<double>")


def scan_secrets(docs: DataFrame, labels: DataFrame | None = None, most: int = MOST_LABELLED) -> DataFrame:
    """``(doc_id, begin, end, marked, score, secret)`` of every candidate.

    ``labels(doc_id, begin, end, label)`` are findings judged before; without them
    ``marked`` is the label of four fifths of the documents. ``secret``: a score over 0.5.
    If the labels are of one kind only, nothing can be learned and the score is that label.
    """
    found = stored(candidates(docs))
    if labels is None:
        judged = found.where(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) != 0).withColumn("label", F.col("marked"))
    else:
        judged = found.join(labels.where("label IS NOT NULL").dropDuplicates(["doc_id", "begin", "end"]), ["doc_id", "begin", "end"])
    counts = {label: n for label, n in judged.groupBy("label").agg(F.count(F.lit(1))).collect()}
    columns = ["doc_id", "begin", "end", "marked"]
    if len(counts) < 2:
        score = F.lit(float(next(iter(counts), 0)))
        return found.select(*columns, score.alias("score"), (score > 0.5).alias("secret"))
    rate = F.lit(0.0)
    for label, n in counts.items():
        rate = F.when(F.col("label") == label, F.lit(min(1.0, most / 2 / n))).otherwise(rate)
    chance = F.pmod(F.xxhash64("doc_id", "begin"), F.lit(1 << 30)) / float(1 << 30)
    sample = stored(judged.where(chance < rate).select(F.col("label").cast("double").alias("label"), "features"))
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=7, featuresCol="vector", labelCol="label")
    model = forest.fit(sample.withColumn("vector", array_to_vector("features")))
    scored = model.transform(found.withColumn("vector", array_to_vector("features")))
    score = vector_to_array("probability")[1]
    return scored.select(*columns, score.alias("score"), (score > 0.5).alias("secret"))
