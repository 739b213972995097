"""Corpus operators against brute force, on rows with nulls, copies, blanks and long texts."""

from __future__ import annotations

import hashlib
import math
import random
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from stopweave.llm import (
    backoff, components, decontamination, fixity, licenses, mixing, neighbours, ordering, secretscan,
    sharding, simhash, toxicity,
)
from stopweave.session import stored

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, shard string, pos string"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
PASSAGE = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"


def low(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def words(text):
    return WORD.findall(low(text))


def make_docs():
    rng = random.Random(5)
    vocabulary = [f"w{k}é" if k % 7 == 0 else f"w{k}" for k in range(300)]
    texts = [" ".join(rng.choice(vocabulary) for _ in range(rng.randrange(1, 60))) for _ in range(80)]
    texts += [None, "", " \t\n ", "...", "One", "one", "ONE two"]
    texts += [texts[0]] * 30 + [texts[1].upper()] * 2
    texts += [" ".join(rng.choice(vocabulary) for _ in range(20_000))]
    texts += ["x " + PASSAGE.upper().replace(" ", ", ") + " y", PASSAGE[6:] + " " + PASSAGE, "short ITEM here"]
    texts += ["Released under the MIT License.\nfoo", "a general, public license; mit-license", "licensed under cc by nc"]
    rows = [(i, t, "en", None if i % 11 == 0 else f"s{i % 4}" if i % 3 else "big", 0, "z", "q", "p") for i, t in enumerate(texts)]
    return rows + [rows[5], rows[5], (None, "no id", None, None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(make_docs(), SCHEMA).repartition(5).cache()


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def bits_of(text):
    parts = [w for w in re.split(r"[\x20\x09-\x0D]+", low(text)) if w]
    grams = [" ".join(parts[i : i + 3]) for i in range(max(1, len(parts) - 2))] if parts else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def brute_components(values, linked):
    parent = list(range(len(values)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(values)):
        for j in range(i):
            if linked(values[i], values[j]):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return [root(i) for i in range(len(values))]


@pytest.mark.parametrize("bucket", [1, 512])
def test_links_join_what_differs_in_two_bits(spark, bucket):
    rng = random.Random(bucket)
    prints = {rng.getrandbits(64) for _ in range(150)}
    for base in sorted(prints)[:3]:
        prints |= {base ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(40)}
    prints = sorted(simhash.signed(p) for p in prints)
    nodes = spark.createDataFrame([(p,) for p in prints], "fp long")
    roots = {r.node: r.root for r in components.connected_components(simhash.links(nodes, bucket=bucket)).collect()}
    expected = brute_components(prints, lambda a, b: ((a ^ b) & (2**64 - 1)).bit_count() <= 2)
    assert [roots.get(p, p) for p in prints] == [prints[r] for r in expected]


def test_thresholds_add_up_and_are_cheapest():
    cost, chosen = simhash.allocate([[0, 5, 9], [0, 1, 2], [0, 7, 8]], 0)
    assert sum(chosen) == 0 and cost == 9 and chosen == [1, 0, -1] or cost <= 9


def test_near_duplicates(docs, nothing):
    rows = simhash.near_duplicates(docs).collect()
    assert len(rows) == docs.count()
    texts = [(r[0], r[1]) for r in make_docs()]
    prints = {t: bits_of(t) for _, t in texts}
    values = [prints[t] for _, t in texts]
    roots = brute_components(values, lambda a, b: (a ^ b).bit_count() <= 2)
    least = defaultdict(lambda: None)
    for (i, _), r in zip(texts, roots):
        if i is not None:
            least[r] = i if least[r] is None else min(least[r], i)
    expected = Counter((i, values[k], least[roots[k]]) for k, (i, _) in enumerate(texts))
    assert Counter((r.doc_id, r.fp & (2**64 - 1), r.component_id) for r in rows) == expected
    assert simhash.near_duplicates(nothing).count() == 0


def test_passages(spark, docs, nothing):
    items = [(1, PASSAGE), (2, "short item"), (30, "absent words " * 8), (4, None), (5, ""), (2, "short item"), (None, "one two")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    windows = defaultdict(set)
    for i, t in items:
        w = words(t)
        for k in range(len(w) - min(10, len(w)) + 1 if w else 0):
            windows[tuple(w[k : k + min(10, len(w))])].add("" if i is None else str(i))
    expected = Counter()
    for i, t, *_ in make_docs():
        w, hit, found = words(t), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in windows:
                    hit.update(range(k, k + n))
                    found |= windows[tuple(w[k : k + n])]
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        expected[i, len(w), len(hit), len(found), digest, bool(hit)] += 1
    assert Counter(tuple(r)[:6] for r in decontamination.contamination(docs, benchmark).collect()) == expected
    assert decontamination.contamination(nothing, benchmark).count() == 0
    assert not decontamination.contamination(docs, benchmark.limit(0)).where("contaminated").count()


def brute_near(texts, items, window, terms, needed, slack):
    counts = Counter(x for t in texts for x in words(t))
    by_hash = {x: h for x, h in zip(sorted(counts), decontamination.token_hashes(pa.array(sorted(counts)))[0].view(np.int64).tolist())}
    found = set()
    for item_id, item in {(None if i is None else str(i), t) for i, t in items}:
        w = words(item)
        size = min(window, len(w))
        for offset in {min(k, len(w) - size) for k in range(0, len(w), window)}:
            block = sorted({(counts[x], by_hash.get(x, decontamination.token_hashes(pa.array([x]))[0].view(np.int64).tolist()[0]), x) for x in w[offset : offset + size]})
            rarest = {x for *_, x in block[:terms]}
            if len(rarest) < 2:
                continue
            for k, t in enumerate(texts):
                d, runs = words(t), []
                for end in range(len(d)):
                    begin = max(0, end - size - slack + 1)
                    held = [p for p in range(begin, end + 1) if d[p] in rarest]
                    if d[end] not in rarest or len({d[p] for p in held}) < min(needed, len(rarest)):
                        continue
                    if runs and held[0] <= runs[-1][1]:
                        runs[-1] = (min(runs[-1][0], held[0]), end)
                    else:
                        runs.append((held[0], end))
                found |= {(k, item_id, offset, a, b + 1, size + slack) for a, b in runs}
    return found


@pytest.mark.parametrize("at_once", [8, 2_000_000])
def test_proximity(spark, monkeypatch, at_once):
    monkeypatch.setattr(decontamination, "WORDS_AT_ONCE", at_once)
    rng = random.Random(11)
    text = [f"w{k}" for k in range(30)]
    items = [(1, PASSAGE), (2, "short item"), (3, " ".join(rng.choices(text, k=37))), (4, None), (5, ""), (6, "the " * 30), (None, "one two"), (2, "short item"), (7, "w1 w2 w1 w2 w3 w3")]
    broken = PASSAGE.split()
    shuffled = rng.sample(broken, len(broken))
    texts = [" ".join(broken[:5] + ["inserted"] + broken[5:]), " ".join(broken[:4] + broken[5:]), " ".join(shuffled), " x ".join(broken), "item of a short", "two, ONE"]
    texts += [" ".join(rng.choices(text, k=rng.randrange(1, 80))) for _ in range(25)] + ["the " * 50, None, "", " x" * 200 + " " + PASSAGE + " y" * 90]
    rows = [(k, t) for k, t in enumerate(texts)]
    docs, benchmark = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = [(r.doc_id, r.item_id, r.offset, r.start, r.stop, r.span) for r in decontamination.find_near(docs, benchmark).collect()]
    expected = brute_near(texts, items, 10, 5, 4, 5)
    assert {k for k, i, *_ in expected if i == "1"} >= {0, 1, 2, len(texts) - 1} and (4, "2", 0, 0, 4, 7) in expected
    assert len(got) == len(set(got)) and set(got) == expected
    assert not decontamination.find_near(docs.limit(0), benchmark).count() and not decontamination.find_near(docs, benchmark.limit(0)).count()


def test_passages_of_one_repeated_word(spark):
    docs = spark.createDataFrame([(k, "the " * 200 + "end " + "the " * (k % 15)) for k in range(400)], "doc_id long, text string")
    benchmark = spark.createDataFrame([(1, "the " * 200), (2, "the " * 12)], "item_id long, text string")
    begun = time.monotonic()
    rows = decontamination.find_passages(docs, benchmark).collect()
    assert time.monotonic() - begun < 30
    for r in rows:
        tail = r.doc_id % 15 if r.doc_id % 15 >= 10 else 0
        assert r.n_hit == 200 + tail and r["items"] == ["1", "2"]
        assert {tuple(x) for x in r.spans} == {(i, a, b) for i in "12" for a, b in [(0, 200), (201, 201 + tail)] if b > a}


def test_mixing(docs, nothing):
    rows = mixing.mix(docs).collect()
    assert len(rows) == docs.count()
    sizes, total = defaultdict(int), 0
    for r in make_docs():
        n = len([w for w in re.split(r"[\x20\x09-\x0D]+", r[1] or "") if w])
        sizes[r[3]] += n
        total += n
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: k % 3 + 1 for k, s in enumerate(order)}
    goal, full = {}, set()
    while True:
        left = total - sum(3 * sizes[s] for s in full)
        free = sum(weight[s] for s in order if s not in full)
        goal = {s: 3 * sizes[s] if s in full else left * weight[s] / free for s in order}
        over = {s for s in order if s not in full and goal[s] > 3 * sizes[s]}
        if not over:
            break
        full |= over
    taken = Counter()
    for r in rows:
        assert 0 <= r.taken <= 3 * r.size and r.source_size == sizes[r.source]
        assert r.target == pytest.approx(goal[r.source], rel=1e-9)
        taken[r.source] += r.taken
    for s in order:
        # Whole copies: a source may miss its target by half of its largest document.
        largest = max(r.size for r in rows if r.source == s)
        assert abs(taken[s] - goal[s]) <= largest / 2 + 1
    assert Counter(map(tuple, mixing.mix(docs).collect())) == Counter(map(tuple, rows))
    assert mixing.mix(nothing).count() == 0


def brute_capacity(sizes, shards):
    low_, high = max(sizes), sum(sizes)
    while low_ < high:
        middle, used, at = (low_ + high) // 2, 1, 0
        for s in sizes:
            if at + s > middle:
                used, at = used + 1, 0
            at += s
        low_, high = (low_, middle) if used <= shards else (middle + 1, high)
    return low_


def test_sharding(docs, nothing):
    rows = sharding.shard_documents(docs).collect()
    given = make_docs()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == Counter(
        (i, len((t or "").encode()) + 1, None if t is None else zlib.crc32(t.encode())) for i, t, *_ in given
    )
    texts = {i: t for i, t, *_ in given}
    home = defaultdict(set)
    for r in rows:
        home[texts[r.doc_id]].add(r.shard)
    assert all(len(x) == 1 for x in home.values())
    for k in range(8):
        assert sorted(r.slot for r in rows if r.shard == k) == list(range(sum(r.shard == k for r in rows)))
    placed, cuts = sharding.placed(docs)
    groups = placed.groupBy(*sharding.ORDER).agg(F.sum("_bytes").alias("n"), F.min("before").alias("b")).orderBy("b").collect()
    assert cuts.capacity == brute_capacity([g.n for g in groups], 8)
    assert max(sum(r.size for r in rows if r.shard == k) for k in range(8)) <= cuts.capacity
    assert sharding.shard_documents(nothing).count() == 0
    shards = {r.doc_id: r.shard for r in rows}
    assert all(r.shard == shards[r.doc_id] for r in sharding.with_shards(docs).select("doc_id", "shard").collect())


@pytest.mark.parametrize("held", [-1, 3, 40, 1000])
@pytest.mark.parametrize("hot", [0, 90_000])
def test_capacity_with_few_ends_held(spark, held, hot):
    rng = random.Random(hot)
    sizes = [rng.randrange(1, 3000) for _ in range(120)] + [hot] * bool(hot)
    rng.shuffle(sizes)
    ends = list(np.cumsum(sizes).tolist())
    table = spark.createDataFrame([(e,) for e in ends], "end long").repartition(2)
    cuts = sharding.minimax_cuts(table, ends[-1], max(sizes), 8, held)
    assert cuts.capacity == brute_capacity(sizes, 8)
    edges = [0, *cuts.starts, ends[-1]]
    assert set(edges[1:]) <= set(ends) and len(cuts.starts) < 8
    assert max(b - a for a, b in zip(edges, edges[1:])) <= cuts.capacity


def test_positions(spark):
    df = spark.createDataFrame([(k % 7, k) for k in range(200)], "k int, s long")
    got = ordering.ordered_positions(df, ["k", "s"], "s").orderBy("pos").collect()
    assert [(r.k, r.s) for r in got] == sorted((k % 7, k) for k in range(200))
    assert [r.before for r in got] == [sum(x.s for x in got[:i]) for i in range(200)]


def brute_notices(w):
    best = {}
    for label, template in licenses.TEMPLATES:
        need = set(template.split())
        span = math.ceil(1.25 * len(template.split()))
        common = max((len(need.intersection(w[k : k + span])) for k in range(len(w))), default=0)
        if common >= (0.8 if len(need) >= 10 else 1) * len(need):
            best[label] = max(best.get(label, 0), common / len(need))
    return best


def test_license_scan(docs, nothing):
    rows = {r.doc_id: r for r in licenses.license_scan(docs).collect()}
    for i, t, *_ in make_docs():
        w = words(t)
        places = [(k, label) for phrase, label in licenses.PHRASES.items() for k in range(len(w)) if tuple(w[k : k + len(phrase)]) == phrase]
        best = brute_notices(w)
        best |= {label: 1.0 for _, label in places}
        r = rows[i]
        assert (r.n_words, r.n_base) == (len(w), len(places))
        assert (r.first_word, r.last_word) == ((min(places)[0], max(places)[0]) if places else (None, None))
        assert r.base_labels == ",".join(sorted({x for _, x in places})) and r.labels == ",".join(sorted(best))
        assert r.score == pytest.approx(max(best.values(), default=0))
    assert licenses.license_scan(nothing).count() == 0


BSD = """/*
 * Redistribution and use in source and binary forms, with or without
 * modification, are permitted provided that the following conditions hold
 */"""
MPL = """# This Source Code Form is subject to the terms of the Mozilla Public
# License, v. 2.0. If a copy was not distributed with this file"""


@pytest.mark.parametrize("piece", [2, 64])
def test_notices_wrapped_over_lines(spark, monkeypatch, piece):
    monkeypatch.setattr(licenses, "PIECE", piece)
    rng = random.Random(3)
    known = sorted({word for _, text in licenses.TEMPLATES for word in text.split()})
    texts = [BSD, "é " * 300 + BSD + " x" * 300, MPL, BSD.replace("binary ", ""), BSD.replace("binary forms, with or", "")]
    texts += ["released " + "a " * 9 + "under the " + "b " * 9 + "license mit", "released under the apache", "wor\u212a is licensed under the gnu"]
    texts += ["Released\nUnder\nThe MIT\n\nLicense", " ".join(known * 40), "the " * 5000, None, "", "license"]
    texts += [" ".join(rng.choice(known) for _ in range(300)) for _ in range(20)]
    for _, notice in licenses.TEMPLATES:
        for drop in (0.1, 0.2, 0.3):
            kept = [x for x in notice.split() if rng.random() > drop]
            for _ in range(rng.randrange(4)):
                kept.insert(rng.randrange(len(kept) + 1), "x")
            texts.append("\n * ".join(kept))
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in licenses.license_scan(rows).collect()}
    labels = [brute_notices(words(t)) for t in texts]
    assert [set(x) for x in labels[:9]] == [{"bsd"}, {"bsd"}, {"mpl"}, {"bsd"}, set(), set(), set(), set(), {"mit"}]
    for i, best in enumerate(labels):
        assert set(best) <= set(got[i].labels.split(",")) <= set(best) | set(got[i].base_labels.split(",")) | {""}
        assert got[i].score == pytest.approx(1.0 if got[i].n_base else max(best.values(), default=0))


def test_license_scan_runs_no_python(docs):
    plan = licenses.license_scan(stored(docs))._jdf.queryExecution().toString()
    assert "Python" not in plan and "InPandas" not in plan and "InArrow" not in plan


def test_toxicity(spark, docs, nothing):
    rng = random.Random(1)
    plain = [f"word{k}" for k in range(200)]
    texts, labels = [], []
    for i in range(400):
        sentences = [" ".join(rng.choice(plain) for _ in range(8)) for _ in range(rng.randrange(1, 8))]
        if i % 4 == 0:
            k = rng.randrange(len(sentences))
            sentences[k] += rng.choice([" dreadful", " awful"])
        texts.append((i, ". ".join(sentences) + "."))
        labels.append((i, None if i % 50 == 1 else int(i % 4 == 0)))
    labels += [(None, 1), (3, 0)]
    table = spark.createDataFrame(texts + [(1000, None), (1001, ""), (None, "x")], "doc_id long, text string")
    model = toxicity.train_toxicity(table, spark.createDataFrame(labels, "doc_id long, toxic int"))
    rows = toxicity.score_toxicity(table, model).collect()
    assert len(rows) == 403
    body = dict(texts)
    for r in rows:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
        if r.doc_id is not None and r.doc_id < 1000:
            assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
            assert r.predicted == int(r.doc_id % 4 == 0)
            if r.predicted:
                assert re.search("dreadful|awful", body[r.doc_id][r.worst_begin : r.worst_end])
        else:
            assert r.score < 0.1
    kept = toxicity.without_toxic(table.withColumn("score", F.lit("s")), model)
    assert kept.columns == ["doc_id", "text", "score"] and kept.count() == 303
    empty = toxicity.train_toxicity(nothing, spark.createDataFrame([], "doc_id long, toxic int"))
    assert toxicity.score_toxicity(docs, empty).where("predicted = 1").count() == 0


def test_all_offending_sentences_have_their_places(spark):
    model = toxicity.ToxicityModel(-4.0, {"awful": 8.0, "doubtful": 3.5})
    texts = ["An awful one. A good one! Another AWFUL thing.", "doubtful a. doubtful b. doubtful c. fine", "fine", None, ""]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: r for r in toxicity.score_toxicity(table, model).collect()}
    assert [texts[0][x.begin : x.end].strip() for x in rows[0].offending] == ["An awful one", "Another AWFUL thing"]
    assert all(x.chance == pytest.approx(1 / (1 + math.exp(-4))) for x in rows[0].offending) and rows[0].n_offending == 2
    assert rows[1].predicted == 1 and rows[1].n_offending == 0
    assert [(x.begin, x.end) for x in rows[1].offending] == [(rows[1].worst_begin, rows[1].worst_end)]
    assert rows[2].offending == rows[3].offending == rows[4].offending == []


def test_fixity(spark):
    pages = spark.createDataFrame(
        [(k % 900, f"http://h/{k % 900}", "é" * (k % 300)) for k in range(1000)] + [(None, None, None)], "page_id long, url string, html string"
    )
    first, second = fixity.damaged_replica(pages)
    a = {r.offset: r for r in first.collect()}
    b = {r.offset: r for r in second.collect()}
    ends = sorted((r.offset, r.length) for r in a.values())
    assert all(x + n == y for (x, n), (y, _) in zip(ends, ends[1:])) and len(ends) == 1001
    wrong = {o for o in a if o not in b or b[o].digest != a[o].digest}
    assert wrong
    for size, fanout in ((65536, 64), (1000, 2)):
        found = fixity.audit(first, second, size, fanout).collect()
        assert {r.offset for r in found} == wrong
        assert all((r.kind == "missing") == (r.offset not in b) for r in found)
    extra = fixity.audit(second, first).where("kind = 'extra'").count()
    assert extra == len(a) - len(b)
    assert fixity.audit(first, first).count() == 0
    assert fixity.audit(first.limit(0), first.limit(0)).count() == 0


def test_backoff(spark, docs, nothing):
    corpus = docs.where("doc_id % 2 = 0")
    counts = Counter()
    for r in corpus.collect():
        w = words(r.text)
        for n in (1, 2, 3):
            counts.update(tuple(w[k : k + n]) for k in range(len(w) - n + 1))
        counts[()] += len(w)
    rows = backoff.score_documents(docs, corpus).collect()
    expected = Counter()
    for i, t, *_ in make_docs():
        w, total = words(t), 0.0
        for k in range(len(w)):
            for n in range(3, -1, -1):
                gram = tuple(w[k - n + 1 : k + 1]) if n <= k + 1 else None
                if n and gram and counts[gram]:
                    total += math.log(counts[gram] / counts[gram[:-1]]) + (3 - n) * math.log(0.4)
                    break
                if n == 0:
                    total += math.log(1 / counts[()]) + 2 * math.log(0.4)
        expected[i, len(w), round(total, 6)] += 1
    got = Counter((r.doc_id, r.n_words, round(r.log_score, 6) + 0.0) for r in rows)
    assert got == expected
    assert backoff.score_documents(nothing, nothing).count() == 0


def shuffle_files(spark):
    """Names of the files that shuffles have left on disk."""
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().iterator()
    names = set()
    while files.hasNext():
        names.add(files.next().getName())
    return {x for x in names if x.startswith("shuffle_") and x.endswith(".data")}


def test_backoff_in_slices(spark, docs):
    """Any number of slices and blocks gives the same scores, and no slice's n-grams stay on the disk."""
    corpus = docs.where("doc_id % 2 = 0")
    rounded = lambda rows: Counter((r.doc_id, r.n_words, round(r.log_score, 6) + 0.0) for r in rows.collect())
    whole = rounded(backoff.score_documents(docs, corpus, slices=1))
    before = shuffle_files(spark)
    scored = backoff.score_documents(docs, corpus, slices=7, block=2_000)
    assert not shuffle_files(spark) - before
    assert rounded(scored) == whole
    assert backoff.text_blocks(docs, corpus, block=2_000).count() > 3
    same = docs.select("*")
    assert rounded(backoff.score_documents(docs, docs, block=2_000)) == rounded(backoff.score_documents(docs, same, slices=2))
    words_alone = backoff.score_documents(docs, corpus, order=1, slices=3)
    assert rounded(words_alone) == rounded(backoff.score_documents(docs, corpus, order=1, block=500))


def test_secrets(spark, nothing):
    rng = random.Random(2)
    token = lambda: "".join(rng.choice("0123456789abcdef") for _ in range(40))
    rows = [(i, f'see it token = "{token()}" here', "s") for i in range(60)]
    rows += [(100 + i, f"pay {rng.randrange(10**15, 10**16)} now", "s") for i in range(60)]
    rows += [(300, None, None), (301, "", "s"), (302, f"key {token()}" + " x" * 50_000, "s"), (0, rows[0][1], "s")]
    got = secretscan.scan_secrets(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert len(got) == 122
    assert all(r.secret == (r.doc_id < 100) for r in got if r.doc_id < 300)
    assert secretscan.scan_secrets(nothing).count() == 0


def test_secrets_of_any_characters(spark):
    key = "04dbeb9a04dbeb9a"
    texts = {
        'secret = "wJalrXUtnFEMIKMDENGbPxRfiCYEXAMPLEKEY"': ["wJalrXUtnFEMIKMDENGbPxRfiCYEXAMPLEKEY"],
        "password: p@ss.w0rd!x$9, then": ["p@ss.w0rd!x$9"],
        "passwd='two words'": ["two words"],
        f"see token={key}": [key],
        f'{{"api_key": "{key}"}}': [key],
        f"access_token: {key}.": [key],
        f"AWS_SECRET_KEY={key}==": [f"{key}=="],
        f"http://h/?token={key}&user=me": [key],
        f"pay {key} now": [],
        "plain words": [],
    }
    for text, expected in texts.items():
        assert [text[a:b] for a, b, assigned in secretscan.spans(text) if assigned] == expected, text
    assert ["pay 0123456789abcd== x"[a:b] for a, b, _ in secretscan.spans("pay 0123456789abcd== x")] == ["0123456789abcd=="]
    assert len(secretscan.spans("the wJalrXUtnFEMIKMDENGb alone")) == 1
    rows = [(i, t, "s") for i, t in enumerate(["pay 0123456789abcd now", "x"])]
    lone = secretscan.scan_secrets(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    assert [(r.secret, r.score) for r in lone.collect()] == [(False, 0.0)] and lone.columns[-1] == "secret"


def test_vectors(spark):
    rng = np.random.default_rng(4)
    base = rng.standard_normal((120, 16))
    rows = [(i, base[i].tolist(), i % 2) for i in range(120)]
    rows += [(200 + i, (base[i % 10] + 0.05 * rng.standard_normal(16)).tolist(), i % 2) for i in range(40)]
    rows += [(300 + i, base[3].tolist(), 1) for i in range(20)]
    rows += [(400, None, 1), (401, [], 1), (402, [0.0] * 16, 1), (403, [float("nan")] * 16, 1), (404, [None] * 16, 1), (405, base[0].tolist(), None), (406, [1.0, 2.0], 1)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    vectors = [np.float64(np.float32(v)) if v and None not in v and np.isfinite(v).all() and np.any(v) and lab is not None else None for _, v, lab in rows]

    def linked(a, b):
        (x, la), (y, lb) = a, b
        return x is not None and y is not None and la == lb and len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= 0.93

    pairs = list(zip(vectors, [r[2] for r in rows]))
    roots = brute_components(pairs, linked)
    got = {r.vec_id: r for r in neighbours.near_duplicate_vectors(table).collect()}
    for k, (i, *_) in enumerate(rows):
        n = sum(linked(pairs[k], q) for j, q in enumerate(pairs) if j != k)
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (n, rows[roots[k]][0], roots[k] == k), i
    assert neighbours.near_duplicate_vectors(table.limit(0)).count() == 0


@pytest.mark.parametrize("least,recall", [(1024, 0.98), (7, 0.98), (7, 2)])
def test_vectors_of_tight_groups_joined_by_one_pair(spark, monkeypatch, least, recall):
    rng = np.random.default_rng(6)
    rows, size = [], 24

    def at(turn, lean):
        aside = rng.standard_normal(14)
        return [math.cos(turn) * math.cos(lean), math.sin(turn) * math.cos(lean), *(aside / np.linalg.norm(aside) * math.sin(lean)).tolist()]

    for group, (centre, end) in enumerate(((0, 2), (25, 23))):
        rows.append((size * group, at(math.radians(end), 0), 0))
        rows += [(size * group + k, at(math.radians(centre), math.radians(3)), 0) for k in range(1, size)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    unit = np.float64(np.float32([v for _, v, _ in rows]))
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    links = unit @ unit.T >= 0.93
    assert links[:size, size:].sum() == 1 and links[:size, :size].all()
    monkeypatch.setattr(neighbours, "LEAST_BLOCK", least)
    got = neighbours.near_duplicate_vectors(table, recall=recall).collect()
    assert {r.audited_recall for r in got} == {1.0}
    assert {(r.vec_id, r.n_links, r.component_id) for r in got} == {(i, links[i].sum() - 1, 0) for i, *_ in rows}


@pytest.mark.parametrize("least", [7, 1024])
def test_links_of_vectors_do_not_need_the_graph(spark, monkeypatch, least):
    monkeypatch.setattr(neighbours, "LEAST_BLOCK", least)
    rng = np.random.default_rng(7)
    base = rng.standard_normal((12, 8))
    vectors = np.float32(base[np.arange(60) % 12] + 0.1 * rng.standard_normal((60, 8)))
    nodes = spark.createDataFrame([(k, k % 2, 8, 1 + k % 3, v.tolist()) for k, v in enumerate(vectors)], "node long, label int, dim int, n long, vec array<float>")
    unit = vectors.astype(float) / np.linalg.norm(vectors.astype(float), axis=1, keepdims=True)
    links = (unit @ unit.T >= 0.93) & (np.arange(60)[:, None] % 2 == np.arange(60) % 2) & ~np.eye(60, dtype=bool)
    roots = brute_components(list(range(60)), lambda a, b: links[a, b])
    got = neighbours._linked(None, nodes, 30, 0.93).collect()
    n = 1 + np.arange(60) % 3
    assert {(r.node, r.root, r.links) for r in got} == {(k, roots[k], int(links[k] @ n)) for k in range(60)}


def test_pipeline_stages(spark, docs, tmp_path):
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(100)], "doc_id long, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, PASSAGE)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    kept = corpus_pipeline.near_dedup_stage(spark, docs, str(tmp_path))
    groups = simhash.near_duplicates(docs).select("component_id").distinct().count()
    assert kept.columns == docs.columns and kept.count() == groups
    clean = corpus_pipeline.decontamination_stage(spark, docs, str(tmp_path))
    assert {r.doc_id for r in docs.collect()} - {r.doc_id for r in clean.collect()} == {
        r.doc_id for r in docs.collect() if PASSAGE.split()[1:11] == words(r.text)[2:12] or " ".join(words(r.text)).count(PASSAGE)
    }
    mixed = corpus_pipeline.mixing_stage(spark, docs, str(tmp_path))
    plan = mixing.mix(docs).agg(F.sum("taken")).first()[0]
    size = sum(len((r.text or "").split()) for r in mixed.select("text").collect())
    assert mixed.columns == docs.columns and abs(size - plan) <= 0.05 * plan
    last = docs
    for _, stage in corpus_pipeline.STAGES:
        last = stage(spark, last, str(tmp_path))
    assert last.count() > 0 and set(last.columns) == set(docs.columns)


def test_a_null_is_not_the_value_beside_it(spark):
    """Rows with the same values, one a null in the other's place, keep their own results."""
    text = "released under the mit license"
    docs = spark.createDataFrame([(text, None), (None, text)], "doc_id string, text string")
    found = {r.doc_id: r for r in licenses.license_scan(docs).collect()}
    assert (found[None].n_base, found[None].labels, found[text].n_base, found[text].labels) == (1, "mit", 0, "")
    items = spark.createDataFrame([(1, text)], "item_id long, text string")
    assert {r.doc_id: (r.n_hit, r.contaminated) for r in decontamination.contamination(docs, items).collect()} == {None: (5, True), text: (0, False)}
    scores = {r.doc_id: r.n_words for r in backoff.score_documents(docs, docs).collect()}
    assert scores == {None: 5, text: 0}
    assert {r.doc_id: r.fp == 0 for r in simhash.near_duplicates(docs).collect()} == {None: False, text: True}
    rows = spark.createDataFrame([(1, "a b c", None), (1, None, "a b c")], "doc_id long, text string, source string")
    mixed = [tuple(r) for r in corpus_pipeline.mixing_stage(spark, rows, "").collect()]
    assert mixed.count((1, "a b c", None)) <= 3 and mixed.count((1, None, "a b c")) <= 3
    kept = corpus_pipeline.near_dedup_stage(spark, rows, "").collect()
    assert {tuple(r) for r in kept} == set(map(tuple, rows.collect()))


def test_pipeline_stages_keep_columns_of_any_name(spark, docs, tmp_path):
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(100)], "doc_id long, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, PASSAGE)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    extra = {c: F.concat(F.lit(f"{c} of "), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))) for c in ("n", "copies", "_key1", "row", "_row", "begin", "odd name")}
    clashing = docs.drop("shard").withColumns(extra)
    for name, stage in corpus_pipeline.STAGES:
        plain = stage(spark, docs, str(tmp_path)).groupBy("doc_id").count().collect()
        result = stage(spark, clashing, str(tmp_path))
        assert result.columns == clashing.columns + ["shard"] * (name == "sharding")
        assert sorted(map(repr, plain)) == sorted(map(repr, result.groupBy("doc_id").count().collect()))
        for c in extra:
            wrong = f"NOT `{c}` <=> concat('{c} of ', coalesce(string(doc_id), 'none'))"
            assert result.where(wrong).isEmpty()
