"""Errors and summaries as plain aggregates; no row leaves the JVM."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LABELS = ("duration", "crowdedness", "pacing", "speed")


def score(model: object, features: DataFrame, keep: Sequence[str] = LABELS) -> DataFrame:
    """Predictions next to the labels."""
    return model.transform(features).select(*keep, "prediction")


def regression_metrics(predictions: DataFrame, label: str, *by: str) -> DataFrame:
    """RMSE, MAE and r2 of ``prediction`` against ``label``, in one pass.

    Rows without a label or a prediction do not count. r2 is null if the label
    does not vary.
    """
    actual, error = F.col(label), F.col("prediction") - F.col(label)
    known = predictions.where(actual.isNotNull() & F.col("prediction").isNotNull())
    total = F.var_pop(actual.cast("double")) * F.count(F.lit(1))
    return known.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
        (F.lit(1.0) - F.try_divide(F.sum(error * error), total)).alias("r2"),
    )


def evaluate(model: object, features: DataFrame, label: str) -> DataFrame:
    """Metrics of a fitted model on rows with features."""
    return regression_metrics(score(model, features, [label]), label)


def describe_predictions(df: DataFrame, columns: Sequence[str] = LABELS) -> DataFrame:
    """Count, mean, standard deviation, least and greatest value per column."""
    summaries = (
        F.struct(
            F.lit(c).alias("label"),
            F.count(c).alias("count"),
            F.avg(F.col(c).cast("double")).alias("mean"),
            F.stddev(F.col(c).cast("double")).alias("stddev"),
            F.min(F.col(c).cast("double")).alias("min"),
            F.max(F.col(c).cast("double")).alias("max"),
        )
        for c in columns
    )
    return df.agg(F.array(*summaries).alias("summaries")).select(F.inline("summaries"))
