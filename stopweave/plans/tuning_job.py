"""Tuning job: cross-validated models per label, tested on later days."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from stopweave.ml import evaluation, features, tuning
from stopweave.operators.columns import complete_cases, union_tables
from stopweave.plans.training_job import featured_split
from stopweave.session import stored
from stopweave.sources.readers import read_legs
from stopweave.sources.writers import save_model, write_params, write_report, write_table


def run_tuning_job(
    spark: SparkSession,
    source: str,
    output: str,
    train_start: date,
    train_end: date,
    test_end: date,
    labels: Sequence[str] = ("crowdedness", "pacing"),
    kinds: Sequence[str] = ("lasso", "rf", "gbt"),
    searches: dict[str, tuning.Search] | None = None,
    parallelism: int = 4,
    fmt: str = "parquet",
) -> DataFrame:
    """Tune every kind of model for every label; returns the best parameters."""
    legs = complete_cases(read_legs(spark, source, fmt, start=train_start, end=test_end))
    train, test = features.temporal_split(legs, train_start, train_end, test_end)
    pipeline, train, test = featured_split(
        train, test, features.TUNING_NUMBERS, features.TUNING_CATEGORIES
    )
    save_model(pipeline, f"{output}/pipeline")
    chosen = []
    for kind in kinds:
        for label in labels:
            search = (searches or tuning.SEARCHES)[kind]
            fitted = tuning.tune_model(kind, train, label, search, parallelism)
            name = f"{label}-{kind}"
            params = tuning.best_params(spark, kind, label, fitted)
            write_params(params, f"{output}/cv-params/{name}")
            chosen.append(params)
            save_model(fitted.bestModel, f"{output}/model/{name}")
            predictions = stored(evaluation.score(fitted.bestModel, test))
            write_table(predictions, f"{output}/predictions/{name}", partition_by=(), fmt=fmt)
            write_report(
                evaluation.regression_metrics(predictions, label), f"{output}/info/{name}"
            )
    return union_tables(chosen)
