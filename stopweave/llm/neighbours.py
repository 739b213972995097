"""Near-duplicate vectors through a neighbour graph refined by NN-descent.

Vectors start with neighbours from buckets of random hyperplanes. In each round the
neighbours of a vector, and those it is a neighbour of, are compared with one another, and
each keeps its nearest, until no round finds a new link. Links at or over the threshold make components.
A list that is full of links says nothing about what lies beyond, so the descent is
repeated with lists of neighbours in other components, until it joins none. Within a
component all links are counted. A sample of vectors compared with all others measures what
part of the links was found; if that is too little, all vectors of a label are compared, block by block.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stopweave.llm.components import connected_components
from stopweave.session import stored

THRESHOLD = 0.93
NEIGHBOURS = 10
TABLES = 6
BUCKET = 256
#: Most rounds of a descent, and most descents. What they leave is for the audit to find.
ROUNDS = 6
DESCENTS = 4
#: Vectors of the audit, about, and the part of their links that must be found.
AUDITED = 512
RECALL = 0.98
#: Vectors in components compared in one step.
SMALL = 4096
#: Least and most vectors of a block; blocks grow with the largest label, so that each
#: vector is sent to few.
LEAST_BLOCK, MOST_BLOCK = 1024, 8192
STRIP = 256


def _unit(column) -> np.ndarray:
    vectors = np.stack(column.to_numpy()).astype(np.float64)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def _codes(frames, tables: int, bits: int, seed: int):
    """For each vector and table, the sides of that table's hyperplanes it lies on."""
    for rows in frames:
        for _, part in rows.groupby("dim"):
            planes = np.random.default_rng((seed, int(part["dim"].iloc[0]))).standard_normal((int(part["dim"].iloc[0]), tables * bits))
            sides = (np.stack(part["vec"].to_numpy()).astype(np.float64) @ planes > 0).reshape(len(part), tables, bits)
            codes = sides @ (1 << np.arange(bits))
            for t in range(tables):
                yield pd.DataFrame({"node": part["node"], "label": part["label"], "dim": part["dim"], "root": part["root"], "t": t, "code": codes[:, t], "vec": part["vec"]})


def _bucket_edges(rows: pd.DataFrame, most: int) -> pd.DataFrame:
    nodes, unit = rows["node"].to_numpy(), _unit(rows["vec"])
    near, root = unit @ unit.T, rows["root"].to_numpy()
    near[root[:, None] == root] = -2
    k = min(most, len(nodes) - 1)
    best = np.argpartition(-near, k - 1, axis=1)[:, :k] if k > 0 else np.zeros((len(nodes), 0), int)
    u, v = np.repeat(np.arange(len(nodes)), best.shape[1]), best.ravel()
    u, v = u[near[u, v] > -2], v[near[u, v] > -2]
    return pd.DataFrame({"u": nodes[u], "v": nodes[v], "sim": near[u, v]})


def _local_joins(rows: pd.DataFrame) -> pd.DataFrame:
    """Pairs of members of one list that are nearer than what one of them has."""
    rows = rows.sort_values(["v", "chunk"], kind="stable")
    nodes, worst, root, unit = rows["member"].to_numpy(), rows["worst"].to_numpy(), rows["root"].to_numpy(), _unit(rows["vec"])
    keys = rows[["v", "chunk"]].to_numpy()
    starts = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(axis=1)])
    us, vs, sims = [], [], []
    for a, b in zip(starts, [*starts[1:], len(rows)]):
        near = unit[a:b] @ unit[a:b].T
        nearer = (near > np.minimum(worst[a:b, None], worst[None, a:b])) & (root[a:b, None] != root[None, a:b])
        i, j = np.nonzero(np.triu(nearer, 1))
        us.append(nodes[a + i])
        vs.append(nodes[a + j])
        sims.append(near[i, j])
    u, v, s = (np.concatenate(x) if x else np.zeros(0) for x in (us, vs, sims))
    return pd.DataFrame({"u": np.r_[u, v], "v": np.r_[v, u], "sim": np.r_[s, s]}).drop_duplicates(["u", "v"])


def _packed(rows: pd.DataFrame) -> pd.DataFrame:
    """The rows of a block as one row."""
    vectors = np.stack(rows["vec"].to_numpy()).astype(np.float32)
    held = {c: [rows[c].to_numpy().astype(np.int64).tobytes()] for c in ("node", "n", "root")}
    return pd.DataFrame({c: rows[c].iloc[:1].to_numpy() for c in ("label", "dim", "blk", "blocks")} | held | {"vec": [vectors.tobytes()]})


def _unpacked(row) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    vectors = np.frombuffer(row.vec, np.float32).reshape(-1, row.dim).astype(np.float64)
    node, n, root = (np.frombuffer(x, np.int64) for x in (row.node, row.n, row.root))
    return node, n, root, vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def _block_links(rows: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """How many vectors of the other block, or of its own, each is linked with, and linked roots that differ."""
    blocks = [_unpacked(row) for row in rows.sort_values("blk").itertuples()]
    (node, n, root, left), (node2, n2, root2, right) = blocks[0], blocks[-1]
    own = len(blocks) == 1
    counts, counts2, joined = np.zeros(len(node), np.int64), np.zeros(len(node2), np.int64), []
    for a in range(0, len(node), STRIP):
        linked = left[a : a + STRIP] @ right.T >= threshold
        if own:
            linked[np.arange(len(linked)), a + np.arange(len(linked))] = False
        else:
            counts2 += n[a : a + STRIP] @ linked
        counts[a : a + STRIP] = linked @ n2
        i, j = np.nonzero(linked & (root[a : a + STRIP, None] != root2[None]))
        joined.append(np.unique(np.stack([root[a + i], root2[j]], axis=1), axis=0))
    found = pd.DataFrame({"node": node, "links": counts})
    if not own:
        found = pd.concat([found, pd.DataFrame({"node": node2, "links": counts2})])
    pairs = np.unique(np.concatenate(joined), axis=0)
    edges = pd.DataFrame({"u": pairs[:, 0], "v": pairs[:, 1]}, dtype="Int64")
    return pd.concat([found[found["links"] > 0].astype("Int64"), edges])[["node", "links", "u", "v"]]


def _nearest(edges: DataFrame, most: int, threshold: float) -> DataFrame:
    """The nearest ``most`` of each vector; twice as many where the first are all links."""
    edges = edges.groupBy("u", "v").agg(F.max("sim").alias("sim"))
    rank = F.row_number().over(Window.partitionBy("u").orderBy(F.desc("sim"), "v"))
    ranked = edges.withColumn("rank", rank).where(F.col("rank") <= 2 * most)
    full = F.max(F.when((F.col("rank") == most) & (F.col("sim") >= threshold), 1)).over(Window.partitionBy("u"))
    kept = ranked.withColumn("full", full).where((F.col("rank") <= most) | F.col("full").isNotNull())
    return stored(kept.select("u", "v", "sim"))


def _start(nodes: DataFrame, seed: int, bits: int) -> DataFrame:
    schema = "node bigint, label int, dim int, root bigint, t int, code bigint, vec array<float>"
    coded = nodes.select("node", "label", "dim", "root", "vec").mapInPandas(lambda f: _codes(f, TABLES, bits, seed), schema)
    coded = stored(coded)
    bucket = ["t", "label", "dim", "code"]
    sizes = coded.groupBy(*bucket).agg(F.ceil(F.count(F.lit(1)) / BUCKET).alias("parts"))
    dealt = coded.join(sizes, bucket).withColumn("part", F.pmod(F.xxhash64("node", "t"), F.col("parts")))
    edges = dealt.groupBy(*bucket, "part").applyInPandas(lambda rows: _bucket_edges(rows, NEIGHBOURS), "u bigint, v bigint, sim double")
    return edges


def _round(graph: DataFrame, nodes: DataFrame, n: int, threshold: float) -> DataFrame:
    worst = graph.groupBy("u").agg(F.when(F.count(F.lit(1)) >= NEIGHBOURS, F.min("sim")).alias("worst"))
    both = graph.select(F.col("u").alias("v"), F.col("v").alias("member")).union(graph.select("v", F.col("u").alias("member"))).distinct()
    sizes = both.groupBy("v").agg(F.ceil(F.count(F.lit(1)) / 64).alias("parts"))
    dealt = both.join(sizes, "v").select("v", "member", F.pmod(F.xxhash64("member"), F.col("parts")).alias("chunk"))
    vectors = nodes.select(F.col("node").alias("member"), "root", "vec").join(worst.withColumnRenamed("u", "member"), "member", "left")
    whole = dealt.join(vectors.withColumn("worst", F.coalesce("worst", F.lit(-2.0))), "member")
    buckets = max(1, n // 1024)
    whole = whole.withColumn("_bucket", F.pmod(F.xxhash64("v", "chunk"), F.lit(buckets)))
    found = whole.groupBy("_bucket").applyInPandas(lambda rows: _local_joins(rows), "u bigint, v bigint, sim double")
    return _nearest(graph.union(found), NEIGHBOURS, threshold)


def _compared(members: DataFrame, group: str, threshold: float) -> DataFrame:
    """Links of each node ``(node, links)`` and linked roots ``(u, v)``, from every pair within ``group``.

    ``members`` has ``(node, dim, n, root, vec, blocks)``: a group is dealt into so many blocks, and each pair of blocks compared once.
    """
    dealt = members.withColumn("label", F.col(group)).withColumn("blk", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    packed = dealt.groupBy("label", "dim", "blk").applyInPandas(
        _packed, "label bigint, dim int, blk int, blocks int, node binary, n binary, root binary, vec binary"
    )
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    spread = stored(packed).withColumn("other", other).withColumns({"i": F.least("blk", "other"), "j": F.greatest("blk", "other")})
    return stored(
        spread.groupBy("label", "dim", "i", "j").applyInPandas(
            lambda rows: _block_links(rows.drop(columns=["label", "blocks", "other", "i", "j"]), threshold), "node bigint, links bigint, u bigint, v bigint"
        )
    )


def _linked(known: DataFrame | None, nodes: DataFrame, largest: int, threshold: float) -> DataFrame:
    """``(node, root, links)`` of all nodes, by comparing every pair of a label once.

    Nothing hangs on the roots ``known`` already; they need not be joined again.
    """
    if known is None:
        known = nodes.withColumn("root", F.col("node"))
    rooted = stored(nodes.drop("root").join(known.select("node", "root"), "node"))
    block = min(MOST_BLOCK, max(LEAST_BLOCK, largest // 16))
    sizes = nodes.groupBy("label", "dim").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
    compared = _compared(rooted.join(sizes, ["label", "dim"]), "label", threshold)
    links = compared.where("node IS NOT NULL").groupBy("node").agg(F.sum("links").alias("links"))
    joined = connected_components(compared.where("u IS NOT NULL").select("u", "v"))
    joined = joined.select(F.col("node").alias("root"), F.col("root").alias("_root"))
    whole = rooted.select("node", "root").join(joined, "root", "left").join(links, "node", "left")
    return stored(whole.select("node", F.coalesce("_root", "root").alias("root"), F.coalesce("links", F.lit(0)).alias("links")))


def _descent(nodes: DataFrame, n: int, bits: int, seed: int, threshold: float) -> DataFrame:
    """Links ``(u, v)`` between vectors of different roots, by NN-descent until a round finds no new one."""
    graph = _nearest(_start(nodes, seed, bits), NEIGHBOURS, threshold)
    linked = F.col("sim") >= threshold
    before = graph.where(linked).count()
    for _ in range(ROUNDS):
        graph = _round(graph, nodes, n, threshold)
        now = graph.where(linked).count()
        if now == before:
            break
        before = now
    return graph.where(linked).select("u", "v")


def _merged(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """The nodes, with one root for the roots that links join."""
    root = nodes.select("node", "root")
    ends = links.join(root.toDF("u", "a"), "u").join(root.toDF("v", "b"), "v").select(F.col("a").alias("u"), F.col("b").alias("v")).distinct()
    joined = connected_components(ends).select(F.col("node").alias("root"), F.col("root").alias("_root"))
    return stored(nodes.join(joined, "root", "left").withColumn("root", F.coalesce("_root", "root")).drop("_root"))


def _audited(frames, sample: list, threshold: float):
    """For each sampled vector its links, and how many of them join two roots."""
    groups: dict[tuple, list] = {}
    for row in sample:
        groups.setdefault((row.label, row.dim), []).append(row)
    for rows in frames:
        for key, part in rows.groupby(["label", "dim"]):
            if key not in groups:
                continue
            node, root = (np.array([row[c] for row in groups[key]], np.int64)[:, None] for c in ("node", "root"))
            linked = (_unit(pd.Series([row.vec for row in groups[key]])) @ _unit(part["vec"]).T >= threshold) & (node != part["node"].to_numpy())
            missed = linked & (root != part["root"].to_numpy())
            yield pd.DataFrame({"node": node[:, 0], "links": linked.sum(axis=1), "missed": missed.sum(axis=1)})


def audited_recall(nodes: DataFrame, n: int, threshold: float) -> float:
    """Mean part of a vector's links that lie within its component; 1 if no sampled vector has a link.

    The sample is chosen by hash, about ``AUDITED`` vectors whatever the table's size, and compared with all of their label.
    """
    chosen = F.pmod(F.xxhash64("node", F.lit(1)), F.lit(max(1, n // AUDITED))) == 0
    sample = nodes.where(chosen).select("node", "label", "dim", "root", "vec").collect()
    counted = nodes.select("node", "label", "dim", "root", "vec").mapInPandas(
        lambda frames: _audited(frames, sample, threshold), "node bigint, links bigint, missed bigint"
    )
    each = counted.groupBy("node").agg(F.sum("links").alias("links"), F.sum("missed").alias("missed")).where("links > 0")
    found = each.agg(F.avg(1 - F.col("missed") / F.col("links"))).first()[0]
    return 1.0 if found is None else found


def _component_links(rows: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """How many vectors of its own component each is linked with; components stand whole in the rows."""
    found = []
    for _, part in rows.groupby("root"):
        unit = _unit(part["vec"])
        linked = unit @ unit.T >= threshold
        np.fill_diagonal(linked, False)
        found.append(pd.DataFrame({"node": part["node"], "links": linked @ part["n"].to_numpy()}))
    return pd.concat(found)


def _counted(nodes: DataFrame, threshold: float) -> DataFrame:
    """``(node, root, links)``: all links within each component, large components block by block."""
    sizes = nodes.groupBy("root").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    held = stored(nodes.select("node", "dim", "n", "vec", "root").join(sizes, "root"))
    small = held.where(F.col("size") <= LEAST_BLOCK)
    buckets = max(1, small.count() // SMALL)
    dealt = small.withColumn("_bucket", F.pmod(F.xxhash64("root"), F.lit(buckets)))
    links = dealt.groupBy("_bucket").applyInPandas(lambda rows: _component_links(rows, threshold), "node bigint, links bigint")
    large = held.where(F.col("size") > LEAST_BLOCK)
    most = large.agg(F.max("size")).first()[0]
    if most:
        block = min(MOST_BLOCK, max(LEAST_BLOCK, most // 16))
        blocked = _compared(large.withColumn("blocks", F.ceil(F.col("size") / block).cast("int")), "root", threshold)
        links = links.union(blocked.where("node IS NOT NULL").groupBy("node").agg(F.sum("links").alias("links")))
    return stored(nodes.select("node", "root").join(links, "node", "left").withColumn("links", F.coalesce("links", F.lit(0))))


def near_duplicate_vectors(embeddings: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """``(vec_id, n_links, component_id, kept, audited_recall)`` for each row of ``embeddings(vec_id, embedding, label)``.

    Only rows with the same label link, at a cosine of ``threshold`` or more in double precision.
    Vectors that are null, empty or zero, or hold null or infinite components, rows without a label
    or an id, and lone rows are their own component. Equal vectors are one
    node of the graph and count as links of each other. All links between vectors of one component are counted;
    a link between two components was missed. ``audited_recall`` is the measured part of links found. Where it is
    under ``recall``, all vectors of a label are compared instead, and it is 1; ``recall`` above 1 asks for that at once.
    """
    rows = embeddings.select("vec_id", F.col("embedding").cast("array<float>").alias("vec"), F.col("label").cast("int").alias("label"))
    sound = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vec", lambda x: x != 0)
    usable = F.coalesce(sound & F.col("label").isNotNull() & F.col("vec_id").isNotNull(), F.lit(False))
    rows = rows.withColumn("node", F.when(usable, F.xxhash64("label", "vec")))
    grouped = rows.where("node IS NOT NULL").groupBy("node").agg(F.first("label").alias("label"), F.first("vec").alias("vec"), F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("least"))
    nodes = stored(grouped.withColumn("dim", F.size("vec")))
    n = nodes.count()
    largest = nodes.groupBy("label", "dim").count().agg(F.max("count")).first()[0] or 1
    bits = max(1, math.ceil(math.log2(max(2, largest / 64))))
    if recall > 1:
        linked, measured = _linked(None, nodes, largest, threshold), 1.0
    else:
        rooted, measured = stored(nodes.withColumn("root", F.col("node"))), 0.0
        for seed in range(DESCENTS):
            links = _descent(rooted, n, bits, seed, threshold)
            joined = bool(links.limit(1).count())
            rooted = _merged(rooted, links) if joined else rooted
            measured = audited_recall(rooted, n, threshold) if not joined or seed == DESCENTS - 1 else measured
            if measured >= recall:
                break
        linked = _counted(rooted, threshold) if measured >= recall else _linked(rooted, nodes, largest, threshold)
        measured = measured if measured >= recall else 1.0
    own = nodes.select("node", "n", "least").join(linked, "node")
    least = own.groupBy("root").agg(F.min("least").alias("component_id"))
    found = own.join(least, "root").select("node", (F.col("links") + F.col("n") - 1).alias("n_links"), "component_id")
    return rows.join(found, "node", "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        F.coalesce("component_id", "vec_id").eqNullSafe(F.col("vec_id")).alias("kept"),
        F.lit(float(measured)).alias("audited_recall"),
    )
