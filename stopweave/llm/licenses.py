"""License notices in text blocks: exact set-similarity join with notice templates.

A block is a window of consecutive words, a quarter longer than the template, and may
run over line ends and comment marks. It holds a template if it has at least ``CONTAINED`` of the
template's different words, or all of them if they are fewer than ``SHORT``. Template words are ordered by how often they
occur in all documents, rarest first. As a block may miss only a few of a
template's words, it has one of the first few (prefix filter), enough template words in all (length
filter), and enough of them after its rarest one (positional filter); what
passes is counted exactly. Only column expressions and joins are used.
"""

from __future__ import annotations

import math
import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stopweave.llm.common import KEYS, row_keys
from stopweave.session import stored

CONTAINED = 0.8
#: Templates of fewer different words than this must be contained whole.
SHORT = 10
#: Words of a block for each word of the template.
STRETCH = 1.25
#: Template words of a text looked at as one piece.
PIECE = 64
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: Words of the phrases, and their labels.
PHRASES = {
    ("mit", "license"): "mit",
    ("apache", "license"): "apache",
    ("general", "public", "license"): "gpl",
}
#: Well-known license notices.
TEMPLATES = [
    ("apache", "licensed under the apache license version 2 0"),
    ("apache", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("epl", "this program and the accompanying materials are made available under the terms of the eclipse public license"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("mit", "released under the mit license"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
]


def _text() -> Column:
    return F.coalesce(F.col("text").cast("string"), F.lit(""))


def _lowered() -> Column:
    """Lower case of every alphabet: good for counting words, and for finding texts worth a look."""
    return F.lower(_text())


def _lowered_ascii() -> Column:
    return F.translate(_text(), string.ascii_uppercase, string.ascii_lowercase)


def _words(text: Column) -> Column:
    return F.filter(F.split(text, SEPARATORS), lambda word: word != "")


def _n_words(text: Column) -> Column:
    """Words between separators; splitting leaves an empty string where one begins or ends the text."""
    parts = F.split(text, SEPARATORS)
    last = F.element_at(parts, -1)
    blanks = (parts[0] == "").cast("int") + ((F.size(parts) > 1) & (last == "")).cast("int")
    return (F.size(parts) - blanks).cast("bigint")


def token_order(docs: DataFrame, templates: list[tuple[str, str]]) -> dict[str, int]:
    """Ranks of the templates' words by their count in all documents, rarest first.

    As many rows come back as the templates have words.
    """
    vocabulary = sorted({word for _, text in templates for word in text.split()})
    words = docs.select(F.explode(F.split(_lowered(), SEPARATORS)).alias("word"))
    counts = words.where(F.col("word").isin(vocabulary)).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    found = {word: n for word, n in counts.collect()}
    ordered = sorted(vocabulary, key=lambda word: (found.get(word, 0), word))
    return {word: rank for rank, word in enumerate(ordered)}


def _prefixes(templates, order: dict[str, int], contained: float) -> list[tuple]:
    """A row for each prefix word: template, label, ranks, rank of the word, words needed, words of a block."""
    rows = []
    for k, (label, text) in enumerate(templates):
        ranks = sorted({order[word] for word in text.split()})
        need = math.ceil(contained * len(ranks) - 1e-9) if len(ranks) >= SHORT else len(ranks)
        span = math.ceil(STRETCH * len(text.split()))
        rows += [(k, label, ranks, rank, need, span) for rank in ranks[: len(ranks) - need + 1]]
    return rows


def template_hits(
    docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, contained: float = CONTAINED
) -> DataFrame:
    """``(_key1, _key2, template, label, begin, score)``: every block that holds a template.

    Of the blocks around one of the template's rarest words only the best is returned. ``begin`` is
    its first word, counted from 0; ``score`` is the share of the template's different words in it.
    """
    order = token_order(docs, templates)
    prefixes = _prefixes(templates, order, contained)
    schema = "template int, label string, ranks array<int>, rank int, need int, span int"
    table = docs.sparkSession.createDataFrame(prefixes, schema)
    first = sorted({row[3] for row in prefixes})
    widest = max(row[5] for row in prefixes)
    name = {rank: word for word, rank in order.items()}
    starters = F.array(*(F.lit(name[rank]) for rank in first))
    near = docs.where(F.arrays_overlap(F.split(_lowered(), SEPARATORS), starters))
    near = near.select(*row_keys(), _words(_lowered_ascii()).alias("words"))
    ranks = F.create_map(*(F.lit(x) for pair in order.items() for x in pair))
    placed = F.transform("words", lambda word, pos: F.struct(pos.alias("pos"), word.alias("word")))
    met = F.filter(placed, lambda x: x["word"].isin(*order))
    known = F.transform(met, lambda x: F.struct(x["pos"].alias("pos"), F.try_element_at(ranks, x["word"]).alias("rank")))
    known = near.select(*KEYS, known.alias("known")).where(F.size("known") > 0)
    # Overlapping pieces: each word's block lies within its piece, however long the text.
    begins = F.sequence(F.lit(0), F.size("known") - 1, F.lit(PIECE))
    pieces = F.transform(
        begins,
        lambda at: F.struct(
            F.least(at, F.lit(widest)).alias("lead"),
            F.slice("known", F.greatest(at - widest, F.lit(0)) + 1, F.least(at, F.lit(widest)) + PIECE + widest).alias("near"),
        ),
    )
    pieces = known.select(*KEYS, F.inline(pieces))
    own = F.slice("near", F.col("lead") + 1, F.lit(PIECE))
    probes = pieces.select(*KEYS, "near", F.inline(F.filter(own, lambda x: x["rank"].isin(*first))))
    # The table has a fixed number of rows: words of the templates' prefixes.
    joined = probes.join(F.broadcast(table), "rank")

    def different(entries: Column) -> Column:
        return F.size(F.array_distinct(F.transform(entries, lambda x: x["rank"])))

    # The block's rarest template word finds it, so the words before that one in the order are left out.
    around = F.filter(
        "near",
        lambda x: (x["rank"] >= F.col("rank")) & (F.abs(x["pos"] - F.col("pos")) < F.col("span")) & F.array_contains("ranks", x["rank"]),
    )
    possible = joined.select(*KEYS, "template", "label", "ranks", "need", "span", "pos", around.alias("around")).where(different(F.col("around")) >= F.col("need"))

    def block(e: Column) -> Column:
        held = F.filter("around", lambda x: (x["pos"] >= e["pos"]) & (x["pos"] < e["pos"] + F.col("span")))
        return F.struct(different(held).alias("common"), (-e["pos"]).alias("from"))

    best = F.array_max(F.transform(F.filter("around", lambda e: e["pos"] <= F.col("pos")), block))
    return (
        possible.select(*KEYS, "template", "label", "ranks", "need", best.alias("best"))
        .where(F.col("best.common") >= F.col("need"))
        .select(
            *KEYS, "template", "label", (-F.col("best.from")).cast("bigint").alias("begin"),
            (F.col("best.common") / F.size("ranks")).alias("score"),
        )
        .distinct()
    )


def phrase_hits(docs: DataFrame) -> DataFrame:
    """``(_key1, _key2, pos, label)``: places where the words of a phrase stand consecutively."""
    gap = SEPARATORS
    some = "|".join(gap.join(words) for words in PHRASES)
    near = docs.where(_lowered().rlike(some))
    words = near.select(*row_keys(), _words(_lowered_ascii()).alias("words"))
    longest = max(map(len, PHRASES))
    shifted = [F.slice("words", k + 1, F.greatest(F.size("words"), F.lit(1))).alias(f"w{k}") for k in range(longest)]
    placed = words.select(*KEYS, F.posexplode(F.arrays_zip(*shifted)).alias("pos", "w"))
    label = None
    for phrase, text in PHRASES.items():
        here = F.lit(True)
        for k, word in enumerate(phrase):
            here = here & (F.col("w")[f"w{k}"] == word)
        label = F.when(here, text) if label is None else label.when(here, text)
    return placed.select(*KEYS, F.col("pos").cast("bigint"), label.alias("label")).where(F.col("label").isNotNull())


def license_scan(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score)`` per row.

    ``docs(doc_id, text)``; null texts are empty. ``score`` is 1 where a phrase stands, else
    the largest share of a template in a block, or 0. Equal rows get equal results.
    """
    base = phrase_hits(docs).select(*KEYS, "pos", "label", F.lit(1.0).alias("score"))
    added = template_hits(docs).select(*KEYS, F.lit(None).cast("bigint").alias("pos"), "label", "score")
    place = F.when(F.col("pos").isNotNull(), F.struct("pos", "label"))
    found = (
        base.union(added)
        .groupBy(*KEYS)
        .agg(
            F.count_distinct(place).alias("n_base"),
            F.min("pos").alias("first_word"),
            F.max("pos").alias("last_word"),
            F.concat_ws(",", F.array_sort(F.collect_set(F.when(F.col("pos").isNotNull(), F.col("label"))))).alias("base_labels"),
            F.concat_ws(",", F.array_sort(F.collect_set("label"))).alias("labels"),
            F.max("score").alias("score"),
        )
    )
    rows = docs.select("doc_id", *row_keys(), _n_words(_lowered()).alias("n_words"))
    return rows.join(found, KEYS, "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_base", F.lit(0)).alias("n_base"),
        "first_word",
        "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
