"""From raw documents to shards of training text, in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows that its
predecessor kept. All but the last return the columns of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stopweave.llm import decontamination, mixing, sharding, simhash, toxicity
from stopweave.llm.common import KEYS, keyed, one_of_each
from stopweave.session import stored


#: What tells rows apart when they are mixed.
IDENTITY = ("doc_id", "text", "source")


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are likelier toxic than not go; the model learns from ``labels``."""
    model = toxicity.train_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.without_toxic(docs, model)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: that of the least id, then text hash.

    Near copies have fingerprints, of shingles of three words, that differ in 2 bits or fewer.
    """
    rows = stored(simhash.near_duplicates(docs))
    own = F.struct(*KEYS)
    kept = rows.where((F.col("first_key") == own) & F.col("doc_id").eqNullSafe(F.col("component_id")))
    counts = stored(kept.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n")))
    single = _joined(docs, counts.where("n = 1").select(*KEYS), "left_semi")
    if counts.where("n > 1").isEmpty():
        return single.select("row.*")
    # Equal rows are merged where they are read, before any shuffle.
    repeated = _joined(docs, counts.where("n > 1").select(*KEYS), "left_semi")
    return single.select("row.*").union(one_of_each(repeated).select("row.*"))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with passages of ``benchmark`` items go."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontamination.find_passages(docs, benchmark).where("n_hit > 0")
    return _joined(docs, found.select(*KEYS).distinct(), "left_anti").select("row.*")


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its rate says, 0 to 3 times."""
    rows = keyed(docs, *IDENTITY)
    sizes = mixing.sized(rows.select(F.concat_ws(" ", *KEYS).alias("doc_id"), "row.source", "row.text"))
    plan = stored(mixing.entropy_balanced(stored(sizes)))
    key = F.split("doc_id", " ")
    plan = plan.where("copies > 0").select(key[0].cast("bigint").alias("_key1"), key[1].cast("int").alias("_key2"), "n", "copies")
    single = _joined(docs, plan.where("n = 1").select(*KEYS, "copies"), "inner", IDENTITY)
    single = single.select("row", F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int"))))
    repeated = plan.where("n > 1")
    if repeated.isEmpty():
        return single.select("row.*")
    # Equal rows become one, which stands for all their copies; these are made in runs.
    one = one_of_each(_joined(docs, repeated.select(*KEYS), "left_semi", IDENTITY)).join(repeated, KEYS)
    run = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("copies") - 1, F.lit(4096).cast("bigint")))
    many = one.select("row", "copies", run.alias("begin"))
    many = many.select("row", F.explode(F.sequence(F.col("begin"), F.least(F.col("begin") + 4095, F.col("copies") - 1))))
    return single.select("row.*").union(many.select("row.*"))


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Eight shards of near equal bytes; equal texts share a shard."""
    return sharding.with_shards(docs)


def _joined(docs: DataFrame, keys: DataFrame, how: str, columns: tuple[str, ...] = ()) -> DataFrame:
    return keyed(docs, *columns).join(keys, KEYS, how)


STAGES = [
    ("toxicity", toxicity_stage),
    ("simhash near-dedup", near_dedup_stage),
    ("benchmark decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("sharding", sharding_stage),
]

#: Learning, fingerprints and iterations have no SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stored and read by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
