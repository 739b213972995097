"""Training job: one model per label, evaluated on held-out legs."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date

from pyspark.ml import Model
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stopweave.ml import evaluation, features, models
from stopweave.operators.columns import union_tables
from stopweave.session import stored
from stopweave.sources.readers import read_legs
from stopweave.sources.writers import save_model, write_report, write_table

# The family of model trained for each label.
TRAINERS = {
    "duration": models.train_lasso,
    "crowdedness": models.train_lasso,
    "pacing": models.train_gbt,
    "speed": models.train_lasso,
}


def featured_split(
    train: DataFrame,
    test: DataFrame,
    numbers: Sequence[str],
    categories: Sequence[str],
    one_hot: bool = False,
) -> tuple[Model, DataFrame, DataFrame]:
    """Pipeline fitted on the training rows, and both sides with features."""
    pipeline = features.feature_pipeline(numbers, categories, one_hot).fit(train)
    keep = [*train.columns, "features"]
    return (
        pipeline,
        stored(pipeline.transform(train).select(keep)),
        pipeline.transform(test).select(keep),
    )


def run_training_job(
    spark: SparkSession,
    source: str,
    output: str,
    labels: Sequence[str] = ("duration", "crowdedness"),
    start: date | None = None,
    end: date | None = None,
    split: Callable[[DataFrame], tuple[DataFrame, DataFrame]] = features.hash_split,
    one_hot: bool = False,
    fmt: str = "parquet",
) -> DataFrame:
    """Train, save and evaluate; returns one row of metrics per label."""
    legs = read_legs(spark, source, fmt, start=start, end=end)
    pipeline, train, test = featured_split(
        *split(legs), features.TRAINING_NUMBERS, features.TRAINING_CATEGORIES, one_hot
    )
    save_model(pipeline, f"{output}/pipeline")
    reports = []
    for label in labels:
        model = TRAINERS[label](train, label)
        save_model(model, f"{output}/{label}-model")
        metrics = stored(evaluation.evaluate(model, test, label))
        write_report(metrics, f"{output}/train-info/{label}")
        reports.append(metrics.select(F.lit(label).alias("label"), "*"))
    table = union_tables(reports)
    write_table(table, f"{output}/metrics", partition_by=(), fmt=fmt)
    return table
