"""Mixing sources to target weights by entropy balancing.

Every document gets the rate closest (by relative entropy) to one copy each
under which its source yields as many words as the target says, at ``MOST``
copies or fewer. The solution is ``min(MOST, exp(lambda * size / mean size))``
with one ``lambda`` for each source, the root of a convex dual. All sources
take Newton steps together, each step one aggregate over how often each size
occurs; rates are then rounded into whole copies.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

import pandas as pd

from stopweave.llm.common import BLANK_WORD_PATTERN
from stopweave.llm.ordering import ordered_positions
from stopweave.session import stored

#: Copies of a document, and words of a source in relation to its size, at most.
MOST = 3
WEIGHTS = (1, 2, 3)
STEPS = 60
#: Documents rounded together.
CHUNK = 2048


def sized(docs: DataFrame) -> DataFrame:
    """``(doc_id, source, size)``: words between blanks of each row; none for null."""
    words = F.regexp_count(F.col("text"), F.lit(BLANK_WORD_PATTERN)).cast("bigint")
    return docs.select("doc_id", F.col("source").cast("string").alias("source"), F.coalesce(words, F.lit(0)).alias("size"))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """``(source, source_size, target)``: shares of all words by weight, none above ``most`` sizes.

    Sources take the weights in the order of their code points, null last, again
    and again. What a source can't hold goes to the others by weight until none is above.
    """
    spark = sizes.sparkSession
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    totals = totals.withColumn("_last", F.col("source").isNull()).withColumn("_one", F.lit(1))
    placed = ordered_positions(totals, ["_last", "source"], "_one")
    weight = F.array(*(F.lit(float(w)) for w in weights))[(F.col("pos") % len(weights)).cast("int")]
    table = stored(placed.select("source", "source_size", weight.alias("weight")))
    everything = table.agg(F.sum("source_size")).first()[0] or 0
    # Full sources are those under a water level; each pass raises it.
    level, full = 0.0, -1
    hold = F.col("source_size") * float(most)
    while True:
        over = F.col("weight") * F.lit(level) > hold
        count, held, free = table.agg(
            F.count_if(over), F.sum(F.when(over, hold)), F.sum(F.when(~over, F.col("weight")))
        ).first()
        if count == full or not free:
            break
        full, level = count, (everything - (held or 0.0)) / free
    target = F.when(F.col("weight") * F.lit(level) > hold, hold).otherwise(F.col("weight") * F.lit(level))
    return table.select("source", "source_size", target.alias("target"))


def _rate(tilt: Column, size: Column, mean: Column, most: int = MOST) -> Column:
    return F.exp(F.least(tilt * size / mean, F.lit(math.log(most))))


def tilts(histogram: DataFrame, goals: DataFrame, most: int = MOST) -> DataFrame:
    """``(source, tilt, mean)``: for each source the tilt at which its rates give its target.

    ``histogram(source, size, n)`` counts the documents. Newton steps that leave
    what earlier steps have bracketed are replaced by halving it. Sums are exact
    decimals, so reruns agree whatever the order of rows. A source at its limit has an
    infinite tilt: the most copies of everything.
    """
    means = histogram.where("size > 0").groupBy("source").agg((F.sum(F.col("size") * F.col("n")) / F.sum("n")).alias("mean"))
    state = stored(
        goals.where("source_size > 0")
        .join(means, goals.source.eqNullSafe(means.source))
        .select(
            goals.source,
            "target",
            "mean",
            F.when(F.col("target") >= most * F.col("source_size"), F.lit(math.inf)).otherwise(F.lit(0.0)).alias("tilt"),
            F.lit(-1e4).alias("low"),
            F.lit(1e4).alias("high"),
            (F.col("target") >= most * F.col("source_size")).alias("done"),
        )
    )
    present = histogram.where("size > 0").withColumnRenamed("source", "of")
    size = F.col("size").cast("double")
    rate = _rate(F.col("tilt"), size, F.col("mean"), most)
    words = F.sum((rate * size * F.col("n")).cast("decimal(38,6)")).cast("double")
    free = F.col("tilt") * size / F.col("mean") < math.log(most)
    slope = F.sum(F.when(free, rate * size * size * F.col("n") / F.col("mean")).cast("decimal(38,6)")).cast("double")
    for _ in range(STEPS):
        if state.where("not done").isEmpty():
            break
        sums = (
            present.join(state.where("not done"), F.col("of").eqNullSafe(F.col("source")))
            .groupBy("of")
            .agg(words.alias("words"), slope.alias("slope"))
        )
        joined = state.join(sums, state.source.eqNullSafe(sums.of), "left")
        over = F.col("words") - F.col("target")
        low = F.when(over < 0, F.col("tilt")).otherwise(F.col("low"))
        high = F.when(over > 0, F.col("tilt")).otherwise(F.col("high"))
        newton = F.col("tilt") - over / F.col("slope")
        half = (F.col("low2") + F.col("high2")) / 2
        kept = (F.col("newton") > F.col("low2")) & (F.col("newton") < F.col("high2"))
        near = F.abs(over) <= F.greatest(F.lit(0.5), 1e-9 * F.col("target"))
        state = stored(
            joined.withColumns({"low2": low, "high2": high, "newton": newton, "done2": F.col("done") | near}).select(
                "source",
                "target",
                "mean",
                F.when(F.col("done2"), F.col("tilt")).when(kept, F.col("newton")).otherwise(half).alias("tilt"),
                F.coalesce("low2", "low").alias("low"),
                F.coalesce("high2", "high").alias("high"),
                "done2",
            ).withColumnRenamed("done2", "done")
        )
    return state.select("source", "tilt", "mean")


def _rounded(chunk: pd.DataFrame) -> pd.DataFrame:
    """Whole copies for a chunk, largest documents first; each passes what it is off to the next.

    A row stands for ``n`` documents that can't be told apart.
    """
    chunk = chunk.sort_values(["size", "doc_id"], ascending=[False, True], na_position="last", kind="stable")
    copies, off = [], 0.0
    for size, n, rate, most in zip(chunk["size"], chunk["n"], chunk["rate"], chunk["most"], strict=True):
        wanted = rate * n + off / size
        taken = min(max(math.floor(wanted + 0.5), 0), most * n)
        off += (rate * n - taken) * size
        copies.append(taken)
    chunk = chunk.assign(copies=copies)
    return chunk[["doc_id", "source", "size", "n", "rate", "copies"]]


def entropy_balanced(
    sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST
) -> DataFrame:
    """``(doc_id, source, size, n, rate, copies, source_size, target)``.

    A row for each different ``(doc_id, source, size)`` of ``sizes``, which
    occurs ``n`` times and gets ``copies`` copies in all. Rows without words get one copy.
    Chunks of a source are rounded on their own; each ends with about half of its
    smallest document to spare.
    """
    units = stored(sizes.groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("n")))
    goals = stored(targets(units.select("source", (F.col("size") * F.col("n")).alias("size")), weights, most))
    histogram = stored(units.groupBy("source", "size").agg(F.sum("n").alias("n")))
    tilt = tilts(histogram, goals, most)
    counts = histogram.where("size > 0").groupBy("source").agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("docs"))
    chunks = F.ceil(F.col("docs") / CHUNK)
    of = goals.join(tilt.withColumnRenamed("source", "s1"), goals.source.eqNullSafe(F.col("s1")), "left")
    of = of.join(counts.withColumnRenamed("source", "s2"), of.source.eqNullSafe(F.col("s2")), "left").select(
        F.col("source").alias("_source"), "source_size", "target", "tilt", "mean", chunks.alias("chunks")
    )
    of = stored(of)
    rated = units.where("size > 0").join(of, units.source.eqNullSafe(of._source)).select(
        "doc_id", "source", "size", "n",
        _rate(F.col("tilt"), F.col("size"), F.col("mean"), most).alias("rate"),
        F.lit(most).alias("most"),
        F.pmod(F.xxhash64("doc_id", "size"), F.col("chunks")).alias("chunk"),
    )
    kind = units.schema["doc_id"].dataType.simpleString()
    rounded = rated.groupBy("source", "chunk").applyInPandas(
        _rounded, f"doc_id {kind}, source string, size bigint, n bigint, rate double, copies bigint"
    )
    empty = units.where("size = 0").select("doc_id", "source", "size", "n", F.lit(1.0).alias("rate"), F.col("n").alias("copies"))
    every = rounded.union(empty)
    return every.join(of.select("_source", "source_size", "target"), every.source.eqNullSafe(of._source)).drop("_source")


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """``(doc_id, size, source_size, target, taken, source, rate)`` for each row of ``docs``.

    ``docs(doc_id, source, text)``; ``taken`` is the words of the row's copies, 0
    to ``most`` times its size. Rows that can't be told apart share their copies
    as evenly as whole copies allow. A source without words has the target 0; no rows give none.
    """
    plan = entropy_balanced(stored(sized(docs)), weights, most)
    # Many equal rows are dealt out in runs, so that no long array is made.
    runs = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1, F.lit(4096).cast("bigint")))
    plan = plan.withColumn("_from", runs)
    one = F.explode(F.sequence(F.col("_from"), F.least(F.col("_from") + 4095, F.col("n") - 1)))
    plan = plan.withColumn("_at", one)
    share = F.floor(F.col("copies") / F.col("n")) + (F.col("_at") < F.col("copies") % F.col("n")).cast("int")
    return plan.select(
        "doc_id", "size", "source_size", "target", (share * F.col("size")).cast("bigint").alias("taken"), "source", "rate"
    )
