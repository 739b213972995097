"""Registered queries of the corpus operators and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from stopweave.llm import (
    backoff, decontamination, extraction, fixity, hardneg, licenses, manifest, mixing, neighbours, oracle, secretscan,
    sharding, simhash, toxicity,
)

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train_toxicity(docs, table(spark, sf_dir, "labels"))
    return toxicity.score_toxicity(docs, model).drop("offending")


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return groups.select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def op3_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixity.audit(*fixity.damaged_replica(table(spark, sf_dir, "pages")))


def op8_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.near_duplicate_vectors(table(spark, sf_dir, "embeddings"))


def op4_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return backoff.score_documents(docs, docs)


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secretscan.scan_secrets(table(spark, sf_dir, "documents"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(table(spark, sf_dir, "documents"))


def op11_hardneg(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hardneg.hard_negatives(rows.withColumn("label", label))


def op12_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.prove_rows(table(spark, sf_dir, "documents"))


def op13_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return extraction.extract(pages, extraction.train_extractor(extraction.annotated_pages(pages)))


def queries() -> dict[str, Query]:
    return {
        "op1_toxicity": op1_toxicity,
        "op2_simhash": op2_simhash,
        "op3_fixity": op3_fixity,
        "op4_backoff": op4_backoff,
        "op5_secrets": op5_secrets,
        "op6_mixing": op6_mixing,
        "op7_decontamination": op7_decontamination,
        "op8_neighbours": op8_neighbours,
        "op9_sharding": op9_sharding,
        "op10_licenses": op10_licenses,
        "op11_hardneg": op11_hardneg,
        "op12_manifest": op12_manifest,
        "op13_extraction": op13_extraction,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op3_fixity": oracle.FIXITY,
        "op10_licenses": oracle.license_sql(),
        "op11_hardneg": oracle.HARD_NEGATIVES,
        "op12_manifest": oracle.manifest_sql(),
        "op13_extraction": oracle.ARTICLES,
    }
