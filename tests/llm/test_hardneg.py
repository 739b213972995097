"""Hard negatives against a comparison of all anchors with all rows."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest

from stopweave.llm import hardneg

SCHEMA = "vec_id long, label string, embedding array<double>, row string, id string, anchor string"
COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def make_rows():
    rng = random.Random(3)
    rows = []
    for k in range(400):
        label = "abc"[k % 3] if k % 5 else "hot"
        centre = {"a": 0.3, "b": -0.2, "c": 0.1, "hot": 0.25}[label]
        vector = [round(rng.gauss(centre, 0.2), 2) for _ in range(12)]
        rows.append((k, label, vector))
    rows[40] = (40, "a", [])
    rows[41] = (41, "a", [1.0, 2.0])
    rows[60] = (60, "hot", [0.0] * 12)
    rows[80] = (80, "b", [3e5] * 12)
    rows[81] = (81, "b", [-3e5] * 12)
    rows += [rows[20]] * 4 + [rows[100], rows[7], rows[7]]
    rows += [(None, "a", rows[20][2]), (None, "hot", rows[20][2]), (500, None, rows[20][2]), (520, "a", None)]
    rows += [(540, "a", [1.0, None] + [0.0] * 10), (560, "a", [math.nan] * 12), (580, "b", [math.inf] * 12)]
    return [(*row, "x", "y", "z") for row in rows]


def brute_force(rows, every=20, most=5, percent=80):
    kept = [
        (i, label, [math.floor(256 * x) for x in vector])
        for i, label, vector, *_ in rows
        if label is not None and vector is not None and all(x is not None and math.isfinite(x) for x in vector)
    ]

    def first(found):
        return sorted(found, key=lambda x: (-x[0], x[1] is None, x[1] or 0))[:most]

    out = []
    for a, (anchor, label, vector) in enumerate(kept):
        if anchor is None or anchor % every:
            continue
        scored = [(sum(x * y for x, y in zip(vector, v)), i, lab == label) for b, (i, lab, v) in enumerate(kept) if b != a]
        for score, positive in first([(s, i) for s, i, alike in scored if alike]):
            inside = [(s, i) for s, i, alike in scored if not alike and percent * score <= 100 * s <= 100 * score]
            out += [(anchor, positive, rank + 1, i, score, s) for rank, (s, i) in enumerate(first(inside))]
    return out


def in_order(rows):
    return sorted(rows, key=repr)


@pytest.mark.parametrize(("parts", "numbers"), [(1, 1 << 23), (7, 1 << 23), (3, 120)])
def test_rows_equal_those_of_all_pairs(spark, parts, numbers):
    rows = make_rows()
    df = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    found = hardneg.hard_negatives(df, every=20, numbers=numbers).select(*COLUMNS)
    assert in_order(map(tuple, found.collect())) == in_order(brute_force(rows))


def test_no_rows_and_no_anchors(spark):
    empty = hardneg.hard_negatives(spark.createDataFrame([], SCHEMA))
    assert empty.columns == COLUMNS and empty.isEmpty()
    assert hardneg.hard_negatives(spark.createDataFrame([(1, "a", [1.0], "", "", "")], SCHEMA)).isEmpty()
    assert hardneg.hard_negatives(spark.createDataFrame([(100, "a", [1.0], "", "", "")], SCHEMA)).isEmpty()


def test_bounds_rule_rows_out_before_all_dimensions_are_read():
    rng = np.random.default_rng(1)
    vectors = hardneg.whole_numbers(rng.normal(0, 0.05, (500, 64)))
    vectors[:, 5] += np.where(np.arange(500) < 20, 4000, -4000)
    block = hardneg.Block(range(500), range(500), ["a"] * 500, 64, np.ascontiguousarray(vectors.T).tobytes())
    anchor = np.zeros(64, np.int64)
    anchor[5], anchor[6] = 100, 1
    looks = []

    def prune(low, high):
        looks.append(len(low))
        return high >= 0

    places, scores = block.scan(anchor, np.arange(500), prune)
    assert looks[:2] == [500, 20] and sorted(places) == list(range(20))
    assert (scores == vectors[places] @ anchor).all()


def test_large_products_stay_whole():
    vectors = np.array([[1 << 28] * 4, [-(1 << 28) + 1] * 4], np.int64)
    block = hardneg.Block([1, 2], [1, 2], ["a", "a"], 4, np.ascontiguousarray(vectors.T).tobytes())
    places, scores = block.scan(vectors[1], np.arange(2), lambda low, high: np.ones(len(low), bool))
    exact = [sum(int(x) * int(y) for x, y in zip(v, vectors[1])) for v in vectors]
    assert scores.tolist() == exact
