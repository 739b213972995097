"""Estimators with the settings the models are trained with."""

from __future__ import annotations

from pyspark.ml import Estimator, Model
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stopweave.operators.columns import drop_missing

# Settings of the trained models.
LASSO_ITERATIONS, LASSO_PENALTY = 10, 0.01
TREE_DEPTH, TREE_BINS = 4, 300
SEED = 24


def lasso(label: str) -> LinearRegression:
    """Linear regression with an L1 penalty only."""
    return LinearRegression(
        labelCol=label,
        maxIter=LASSO_ITERATIONS,
        regParam=LASSO_PENALTY,
        elasticNetParam=1.0,
    )


def boosted_trees(label: str, bins: int = TREE_BINS) -> GBTRegressor:
    return GBTRegressor(labelCol=label, maxDepth=TREE_DEPTH, maxBins=bins, seed=SEED)


def random_forest(label: str) -> RandomForestRegressor:
    return RandomForestRegressor(labelCol=label, maxBins=TREE_BINS, seed=SEED)


def fit(estimator: Estimator, features: DataFrame) -> Model:
    """Fit on the rows that have the estimator's label."""
    return estimator.fit(drop_missing(features, [estimator.getLabelCol()]))


def train_lasso(features: DataFrame, label: str) -> Model:
    return fit(lasso(label), features)


def train_gbt(features: DataFrame, label: str) -> Model:
    return fit(boosted_trees(label, tree_bins(features)), features)


def route_arity(legs: DataFrame, column: str = "route") -> DataFrame:
    """Number of distinct values of a category."""
    return legs.agg(F.count_distinct(column).alias("arity"))


def tree_bins(legs: DataFrame, column: str = "route", least: int = TREE_BINS) -> int:
    """Bins with which trees can split a category: ``least``, or more if it has more values.

    One bin is kept for categories that first appear in test data.
    """
    if column not in legs.columns:
        return least
    return max(least, route_arity(legs, column).first()["arity"] + 1)
