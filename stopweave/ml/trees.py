"""Fitted trees as a table, and predictions by joins with it."""

from __future__ import annotations

import uuid

from pyspark.ml import Model
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stopweave.session import shared_folder
from stopweave.sources.writers import save_model


def tree_table(features: DataFrame, model: Model) -> DataFrame:
    """``(tree, node, weight, feature, threshold, left_values, left, right, value)`` of an ensemble.

    A node without ``left`` is a leaf. A value goes left if it is at most ``threshold`` or,
    for a category, among ``left_values``. The table is what Spark itself writes for the model.
    """
    spark = features.sparkSession
    path = f"{shared_folder(spark)}/trees-{uuid.uuid4().hex}"
    save_model(model, path)
    weights = F.array(*map(F.lit, map(float, model.treeWeights)))
    inner = F.col("nodeData.leftChild") >= 0
    category = F.col("nodeData.split.numCategories") >= 0
    values = F.col("nodeData.split.leftCategoriesOrThreshold")
    return spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"),
        F.col("nodeData.id").alias("node"),
        weights[F.col("treeID")].alias("weight"),
        F.when(inner, F.col("nodeData.split.featureIndex")).alias("feature"),
        F.when(inner & ~category, values[0]).alias("threshold"),
        F.when(inner & category, values).alias("left_values"),
        F.when(inner, F.col("nodeData.leftChild")).alias("left"),
        F.when(inner, F.col("nodeData.rightChild")).alias("right"),
        F.col("nodeData.prediction").alias("value"),
    )


def scored_by_table(rows: DataFrame, table: DataFrame, keys: list[str], depth: int, mean: bool = False) -> DataFrame:
    """``keys`` and ``prediction``: every tree is walked by one join for each level.

    ``mean`` for forests, whose trees are averaged; boosted trees are summed by weight. The
    table has as many rows as the model has nodes, which the depth and the number of trees bound.
    """
    weights = table.select("tree", "weight").distinct().orderBy("tree").collect()
    each = F.array(*(F.struct(F.lit(tree).alias("tree"), F.lit(weight).alias("weight")) for tree, weight in weights))
    at = rows.select(*keys, vector_to_array("features").alias("x"), F.inline(each)).withColumn("node", F.lit(0))
    nodes = F.broadcast(table.drop("weight"))
    for _ in range(depth):
        met = at.join(nodes, ["tree", "node"])
        # Features count from 0, as do elements taken by index.
        value = F.col("x")[F.coalesce("feature", F.lit(0))]
        goes_left = F.coalesce(value <= F.col("threshold"), F.array_contains("left_values", value))
        step = F.when(F.col("left").isNull(), F.col("node")).when(goes_left, F.col("left")).otherwise(F.col("right"))
        at = met.select(*keys, "x", "tree", "weight", step.alias("node"))
    leaves = at.join(nodes, ["tree", "node"])
    total = F.sum(F.col("weight") * F.col("value"))
    return leaves.groupBy(*keys).agg((total / F.sum("weight") if mean else total).alias("prediction"))
