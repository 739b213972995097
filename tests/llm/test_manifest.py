"""The manifest and its proofs against trees built one by one."""

from __future__ import annotations

import random
import zlib
from collections import defaultdict
from hashlib import sha256

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from stopweave.llm import manifest
from stopweave.session import stored

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, part string, tree string, leaf string"


def make_docs():
    rng = random.Random(2)
    rows = []
    for k in range(700):
        source = "big" if k % 3 == 0 else rng.choice(["ß", "a", "A", "zz", None, f"s{k % 40}"])
        rows.append((k, f"Text É {k} " * rng.randrange(3), "en", source, k * 7))
    rows += [(1000, None, None, "lone", None), (1001, "", "", "", 0), (None, "No Id", None, "big", 1), (None, "No Id", None, "big", 1)]
    rows += [(1002, "Long " * 50_000, "en", "zz", 9)] + [(1003, "COPY", "en", "big", 4)] * 300
    rows += [(1003, "other", "en", "big", 4)]
    return [(*row, "x", "y", "z", "w") for row in rows]


def joined_hash(children):
    return sha256("".join(children).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def digest(row, text):
    doc_id, _, lang, source, n_chars = row[:5]
    return sha256("".join(map(field, (doc_id, source, lang, n_chars, text))).encode()).hexdigest()


def lowered(text):
    return None if text is None else "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def grown(leaves, fanout):
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([joined_hash(levels[-1][k : k + fanout]) for k in range(0, len(levels[-1]), fanout)])
    return levels


def climb(levels, at, folded, fanout):
    """The siblings on the way up, and the root that ``folded`` leads to."""
    siblings = []
    for level in levels[:-1]:
        begin = at // fanout * fanout
        run = level[begin : begin + fanout]
        siblings += run[: at - begin] + run[at - begin + 1 :]
        folded = joined_hash(run[: at - begin] + [folded] + run[at - begin + 1 :])
        at //= fanout
    return siblings, folded


def brute_force(rows, fanout=16):
    by_source = defaultdict(list)
    for row in rows:
        by_source[row[3]].append((row, digest(row, row[1])))
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for source, leaves in by_source.items():
        leaves.sort(key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1]))
        trees[source] = grown([h for _, h in leaves], fanout)
    top = grown([trees[s][-1][0] for s in order], fanout)
    out = []
    for rank, source in enumerate(order):
        for at, (row, leaf) in enumerate(by_source[source]):
            hurt = leaf
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0:
                hurt = digest(row, lowered(row[1]))
            below, subroot = climb(trees[source], at, hurt, fanout)
            above, root = climb(top, rank, subroot, fanout)
            proof = sha256("".join(below + above).encode()).hexdigest()
            out.append((row[0], leaf, trees[source][-1][0], top[-1][0], proof, root, root == top[-1][0]))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(make_docs(), SCHEMA).repartition(5)


def test_proofs_equal_those_of_whole_trees(docs):
    found = sorted(map(tuple, manifest.prove_rows(docs).collect()), key=repr)
    assert found == brute_force(make_docs())
    assert 0 < sum(not row[-1] for row in found) < len(found) / 2


@pytest.mark.parametrize(("part", "fanout"), [(1, 16), (7, 2), (40, 3), (1000, 16)])
def test_partitions_and_fanouts(docs, part, fanout):
    placed = stored(manifest.placed_leaves(manifest.lowered_share(docs)))
    proved = manifest.prove(placed, manifest.merkle_nodes(placed, fanout), part, fanout)
    assert sorted(map(tuple, proved.collect()), key=repr) == brute_force(make_docs(), fanout)


def test_chosen_leaves_are_proved_like_all(docs):
    placed = stored(manifest.placed_leaves(manifest.lowered_share(docs)))
    nodes = manifest.merkle_nodes(placed)
    chosen = placed.where(F.pmod(F.xxhash64("pos"), F.lit(9)) == 0)
    every = {repr(tuple(row)) for row in manifest.prove(placed, nodes).collect()}
    some = [repr(tuple(row)) for row in manifest.prove(chosen, nodes, part=100).collect()]
    assert len(some) == chosen.count() and set(some) <= every


def test_a_changed_node_is_noticed(docs):
    placed = stored(manifest.placed_leaves(manifest.lowered_share(docs).withColumn("tampered", F.lit(None).cast("string"))))
    nodes = manifest.merkle_nodes(placed)
    assert manifest.prove(placed, nodes).where("not verified").isEmpty()
    wrong = nodes.withColumn("hash", F.when((F.col("tree") == manifest.TOP) & (F.col("level") == 0) & (F.col("idx") == 3), F.unhex(F.sha2(F.lit("x"), 256))).otherwise(F.col("hash")))
    proved = manifest.prove(placed, wrong, part=40)
    trees = defaultdict(set)
    for row in placed.select("pos", "tree").collect():
        trees[row["pos"] // 40].add(row["tree"])
    # Partitions with a leaf below that node derive it; those with none below its run fetch the run's hash.
    fetching = [p for p, held in trees.items() if 3 not in held and min(held) < 16]
    refused = sum(row["count"] for row in proved.groupBy("verified").count().collect() if not row["verified"])
    assert refused == placed.where(F.expr("pos div 40").isin(fetching)).count() > 0


def test_no_node_is_fetched_that_can_be_derived():
    rng = random.Random(4)
    sizes = [1, 5, 40, 300, 1, 17]
    for _ in range(20):
        own = {(t, i) for t, n in enumerate(sizes) for i in range(n) if rng.random() < rng.choice((0.02, 0.3, 0.9))} or {(0, 0)}
        table = pa.table({"tree": [t for t, _ in own], "idx": [i for _, i in own], "size": [sizes[t] for t, _ in own]})
        found = manifest.missing_nodes(table, len(sizes), 4)

        def path(tree, i, size):
            level = 0
            while size > 1:
                yield level, i, size
                level, i, size = level + 1, i // 4, -(-size // 4)

        paths = {(t, level, i, n) for t, k in own for level, i, n in path(t, k, sizes[t])}
        paths |= {(manifest.TOP, level, i, n) for t, _ in own for level, i, n in path(0, t, len(sizes))}
        known = {x[:3] for x in paths}
        siblings = {(t, level, j) for t, level, i, n in paths for j in range(i // 4 * 4, min(i // 4 * 4 + 4, n))}
        assert sorted(found) == sorted((siblings - known) | {(manifest.TOP, 2, 0)})


def test_one_row_and_none(spark):
    assert manifest.prove_rows(spark.createDataFrame([], SCHEMA)).isEmpty()
    row = (7, "A", None, None, 1, "", "", "", "")
    (found,) = manifest.prove_rows(spark.createDataFrame([row], SCHEMA)).collect()
    assert found["leaf"] == found["subroot"] == found["root"] == digest(row, "A")
    assert found["proof_sha256"] == sha256(b"").hexdigest() and [tuple(found)] == brute_force([row])
