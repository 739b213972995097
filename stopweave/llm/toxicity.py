"""Toxic documents and their offending sentences: multiple-instance learning with noisy-or.

A document is toxic if one of its sentences is. Each sentence has the chance
``sigmoid(bias + weights of its words)``; a document's score is the chance that not
all sentences are harmless, ``1 - prod(1 - p)``. The weights are learned from
labels of documents alone, and then say which sentences made a document toxic.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stopweave.llm.common import WORD_PATTERN, batches_of
from stopweave.session import stored

FOLDS = 5
#: Labelled documents to learn from, in expectation; of more, a sample by hash.
MOST_LABELLED = 20_000
#: Words and beginnings of words that tell most, kept as features.
FEATURES = 4096
PREFIXES = (4, 5, 6)
LEAST_DOCUMENTS = 3
STEPS = 400
#: Variance of the weights expected before learning.
SPREAD = 9.0

SENTENCE = regex.compile(r"[^.!?\n]+")
WORD = regex.compile(WORD_PATTERN)
SPANS = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64()), ("chance", pa.float64())]))


@dataclass(frozen=True)
class ToxicityModel:
    bias: float
    weights: dict[str, float] = field(default_factory=dict)


def held_out(doc_id: Column) -> Column:
    """Documents whose labels are never learned."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(FOLDS)) == 0


def features_of(word: str) -> list[str]:
    """The word, and its beginnings, marked by a hyphen that no word holds."""
    return [word, *(f"{word[:k]}-" for k in PREFIXES if len(word) > k)]


def sentence_words(text: str) -> list[tuple[int, int, set[str]]]:
    """Begin, end and different lower-cased words of each sentence of a text."""
    found = []
    for part in SENTENCE.finditer(text):
        words = set(WORD.findall(part.group().lower()))
        if words:
            found.append((part.start(), part.end(), words))
    return found


def _document_features(batches):
    """In how many toxic and other documents of a batch each feature occurs."""
    for whole in batches:
        for batch in batches_of(whole, "text"):
            counts: list[Counter] = [Counter(), Counter()]
            for text, label in zip(batch["text"].to_pylist(), batch["label"].to_pylist(), strict=True):
                counts[label].update({f for *_, words in sentence_words(text or "") for w in words for f in features_of(w)})
            for label, counted in enumerate(counts):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(list(counted), pa.string()),
                        pa.array([n * (1 - label) for n in counted.values()], pa.int64()),
                        pa.array([n * label for n in counted.values()], pa.int64()),
                    ],
                    names=["feature", "other", "toxic"],
                )


def _bags(batches, chosen):
    """Per document: sentences without features, and the features of the others."""
    place = chosen.value
    for whole in batches:
        for batch in batches_of(whole, "text"):
            plain, bags = [], []
            for text in batch["text"].to_pylist():
                found = [[place[f] for w in sorted(words) for f in features_of(w) if f in place] for *_, words in sentence_words(text or "")]
                plain.append(sum(not x for x in found))
                bags.append([x for x in found if x])
            yield pa.RecordBatch.from_arrays(
                [batch["label"], batch["weight"], pa.array(plain, pa.int64()), pa.array(bags, pa.list_(pa.list_(pa.int32())))],
                names=["label", "weight", "plain", "bags"],
            )


def _learn(rows: pa.Table, n_features: int) -> tuple[float, np.ndarray]:
    """Weights of the least regularised loss of the noisy-or, by Adam over all rows."""
    label, weight, plain = (rows.column(c).to_numpy().astype(float) for c in ("label", "weight", "plain"))
    bags = pa.concat_arrays(rows.column("bags").chunks)
    owner = np.repeat(np.arange(len(rows)), pa.compute.list_value_length(bags).to_numpy())
    sentences = bags.flatten()
    sizes = pa.compute.list_value_length(sentences).to_numpy()
    flat = sentences.flatten().to_numpy()
    sentence = np.repeat(np.arange(len(sizes)), sizes)
    w, b = np.zeros(n_features), -4.0
    m, v = np.zeros(n_features + 1), np.zeros(n_features + 1)
    for step in range(1, STEPS + 1):
        s = b + np.bincount(sentence, w[flat], len(sizes)) if len(sizes) else np.zeros(0)
        odds = np.logaddexp(0, s)
        total = plain * np.logaddexp(0, b) + np.bincount(owner, odds, len(rows))
        harmless = np.exp(-np.maximum(total, 1e-12))
        slope = weight * np.where(label > 0, -harmless / np.maximum(1 - harmless, 1e-12), 1.0)
        per_sentence = slope[owner] / (1 + np.exp(-s))
        grad_w = np.bincount(flat, per_sentence[sentence], n_features) + w / SPREAD
        grad_b = per_sentence.sum() + (slope * plain).sum() / (1 + np.exp(-b))
        grad = np.append(grad_w, grad_b)
        m = 0.9 * m + 0.1 * grad
        v = 0.999 * v + 0.001 * grad * grad
        move = 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    return float(b), w


def train_toxicity(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELLED) -> ToxicityModel:
    """A model from ``labels(doc_id, toxic)`` outside the held-out part and the texts of ``docs``.

    Learns from about ``most`` labelled documents, toxic ones first, chosen by
    a hash of the id; others count by the share that was taken. Null labels
    and ids are left out; of several labels of an id the largest holds. Without toxic
    or without other documents the model finds nothing.
    """
    spark = docs.sparkSession
    usable = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
    known = usable.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = known.select("doc_id", (F.col("toxic") > 0).cast("int").alias("label"))
    toxic, other = known.agg(F.count_if(F.col("label") == 1), F.count_if(F.col("label") == 0)).first()
    if not toxic or not other:
        return ToxicityModel(-20.0)
    share = [min(1.0, (most - min(toxic, most // 2)) / other), min(1.0, most / 2 / toxic)]
    rate = F.when(F.col("label") == 1, F.lit(share[1])).otherwise(F.lit(share[0]))
    chance = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    sample = known.where(chance < rate).withColumn("weight", 1 / rate)
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    # The sample has about ``most`` rows at any size of the tables.
    learned = stored(texts.join(F.broadcast(sample), "doc_id").select("text", "label", "weight"))
    counts = learned.mapInArrow(_document_features, "feature string, other bigint, toxic bigint")
    counts = counts.groupBy("feature").agg(F.sum("other").alias("other"), F.sum("toxic").alias("toxic"))
    n = learned.agg(F.count_if(F.col("label") == 1), F.count_if(F.col("label") == 0)).first()
    if not n[0] or not n[1]:
        return ToxicityModel(-20.0)
    odds = F.log((F.col("toxic") + 0.5) / (n[0] + 1.0)) - F.log((F.col("other") + 0.5) / (n[1] + 1.0))
    tells = F.abs(odds) * F.sqrt(F.col("toxic") + F.col("other"))
    top = counts.where(F.col("toxic") + F.col("other") >= LEAST_DOCUMENTS).orderBy(F.desc(tells), "feature").limit(FEATURES)
    chosen = [x for (x,) in top.select("feature").collect()]
    place = spark.sparkContext.broadcast({x: i for i, x in enumerate(chosen)})
    bags = learned.mapInArrow(lambda batches: _bags(batches, place), "label int, weight double, plain bigint, bags array<array<int>>")
    bias, weights = _learn(bags.toArrow(), len(chosen))
    return ToxicityModel(bias, {x: float(w) for x, w in zip(chosen, weights) if abs(w) > 1e-3})


class _WordWeights(dict):
    """Weight of a word with its beginnings, kept for as long as there is room."""

    def __init__(self, weights):
        super().__init__()
        self.weights = weights

    def __missing__(self, word):
        if len(self) > 500_000:
            self.clear()
        value = self[word] = sum(self.weights.get(f, 0.0) for f in features_of(word))
        return value


def _sentence_chances(text: str, known: _WordWeights, bias: float) -> tuple[list, np.ndarray]:
    found = sentence_words(text)
    odds = np.array([bias + sum(known[w] for w in sorted(words)) for *_, words in found])
    return found, odds


def _scored(batches, model, kept, clean_only):
    bias, weights = model.value
    known = _WordWeights(weights)
    for whole in batches:
        for batch in batches_of(whole, "text"):
            scores, offending, begins, ends, sentences = [], [], [], [], []
            for text in batch["text"].to_pylist():
                found, odds = _sentence_chances(text or "", known, bias)
                scores.append(float(-np.expm1(-np.logaddexp(0, odds).sum())))
                offending.append(int((odds >= 0).sum()))
                worst = found[int(odds.argmax())] if found else (None, None)
                begins.append(worst[0])
                ends.append(worst[1])
                # A text toxic by many doubtful sentences has its worst one listed.
                listed = odds >= 0
                if len(odds) and scores[-1] >= 0.5:
                    listed[int(odds.argmax())] = True
                chances = 1 / (1 + np.exp(-odds))
                sentences.append([{"begin": found[k][0], "end": found[k][1], "chance": float(chances[k])} for k in np.flatnonzero(listed)])
            if clean_only:
                yield batch.filter(pa.array([s < 0.5 for s in scores], pa.bool_()))
                continue
            yield pa.RecordBatch.from_arrays(
                [*(batch[c] for c in kept), pa.array(scores, pa.float64()), pa.array(offending, pa.int32()), pa.array(begins, pa.int64()), pa.array(ends, pa.int64()), pa.array(sentences, SPANS)],
                names=[*kept, "score", "n_offending", "worst_begin", "worst_end", "offending"],
            )


def score_toxicity(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """``(doc_id, held_out, score, predicted, n_offending, worst_begin, worst_end, offending)`` per row.

    The whole text is scored. ``n_offending`` counts sentences that are more likely
    toxic than not; the characters from ``worst_begin`` to before ``worst_end`` are the likeliest.
    ``offending`` has ``(begin, end, chance)`` of every sentence so counted, in the order of
    the text, and, if the document is toxic, of the likeliest in any case.
    A null text, or one without words, scores 0 and has no worst sentence.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.bias, model.weights))
    plain = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = plain.schema["doc_id"].dataType.simpleString()
    scored = plain.mapInArrow(
        lambda batches: _scored(batches, shared, ["doc_id"], False),
        f"doc_id {kind}, score double, n_offending int, worst_begin bigint, worst_end bigint, offending array<struct<begin:bigint,end:bigint,chance:double>>",
    )
    return scored.select(
        "doc_id",
        F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "n_offending",
        "worst_begin",
        "worst_end",
        "offending",
    )


def without_toxic(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """The rows of ``docs`` with a score under 0.5, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast((model.bias, model.weights))
    return docs.mapInArrow(lambda batches: _scored(batches, shared, [], True), docs.schema)
