"""Cross-validated choice of model parameters."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark.ml import Estimator
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stopweave.ml import models
from stopweave.ml.features import filled_folds
from stopweave.operators.columns import drop_missing, union_tables


@dataclass(frozen=True)
class Search:
    """An estimator, the values to try for its parameters, and the folds."""

    build: Callable[[str], Estimator]
    grid: dict[str, tuple]
    folds: int


# The grids and folds of a tuning run.
SEARCHES = {
    "lasso": Search(models.lasso, {"maxIter": (10, 20), "regParam": (0.1, 0.01)}, 5),
    "rf": Search(
        models.random_forest, {"maxDepth": (2, 4, 6), "maxBins": (300,), "numTrees": (5, 20)}, 2
    ),
    "gbt": Search(models.boosted_trees, {"maxDepth": (2, 4, 6), "maxBins": (300,)}, 5),
}


def with_bins(search: Search, bins: int) -> Search:
    """``search`` with every number of bins it tries raised to ``bins`` at least."""
    if "maxBins" not in search.grid:
        return search
    tried = tuple(dict.fromkeys(max(bins, value) for value in search.grid["maxBins"]))
    return replace(search, grid=search.grid | {"maxBins": tried})


def tune_model(
    kind: str,
    features: DataFrame,
    label: str,
    search: Search | None = None,
    parallelism: int = 4,
    seed: int = models.SEED,
    keys: Sequence[str] = ("visit_id",),
    keep_fits: bool = False,
) -> CrossValidatorModel:
    """Best model of a grid by cross-validated RMSE.

    A row's fold is a hash of ``keys``, so it changes neither with the partitioning nor after a
    lost executor. ``features`` should be a stored table, as it is read for
    every fit. Trees get as many bins as the routes in ``features`` need. ``keep_fits``
    keeps the model of every fold and grid point for ``fold_scores``.
    """
    search = search or SEARCHES[kind]
    if "maxBins" in search.grid:
        search = with_bins(search, models.tree_bins(features))
    estimator = search.build(label)
    grid = ParamGridBuilder()
    for name, values in search.grid.items():
        grid = grid.addGrid(estimator.getParam(name), list(values))
    validator = CrossValidator(
        estimator=estimator,
        estimatorParamMaps=grid.build(),
        evaluator=RegressionEvaluator(labelCol=label, metricName="rmse"),
        numFolds=search.folds,
        foldCol="fold",
        parallelism=parallelism,
        seed=seed,
        collectSubModels=keep_fits,
    )
    return validator.fit(filled_folds(drop_missing(features, [label]), search.folds, keys))


def fold_scores(features: DataFrame, label: str, model: CrossValidatorModel, keys: Sequence[str] = ("visit_id",)) -> DataFrame:
    """``(point, params, fold, n, rmse)``: the error of every fit of a search on its own fold.

    Needs a search with ``keep_fits``. Each fold is read once, whatever the number of grid points.
    """
    folds = len(model.subModels)
    held = filled_folds(drop_missing(features, [label]), folds, keys)
    names = [", ".join(f"{p.name}={v}" for p, v in params.items()) for params in model.getEstimatorParamMaps()]
    parts = []
    for fold, fits in enumerate(model.subModels):
        rows = held.where(F.col("fold") == fold).select(label, "features")
        for point, fit in enumerate(fits):
            rows = fit.copy({fit.predictionCol: f"p{point}"}).transform(rows)
        errors = [F.sqrt(F.avg((F.col(f"p{k}") - F.col(label)) ** 2)) for k in range(len(fits))]
        scored = rows.agg(F.count(F.lit(1)).alias("n"), F.array(*errors).alias("errors"))
        each = scored.select("n", F.posexplode("errors").alias("point", "rmse"))
        parts.append(each.select("point", F.array(*map(F.lit, names))[F.col("point")].alias("params"), F.lit(fold).alias("fold"), "n", "rmse"))
    return union_tables(parts)


def best_params(
    spark: SparkSession, kind: str, label: str, model: CrossValidatorModel
) -> DataFrame:
    """The chosen values of the parameters that were searched, one row each."""
    best = model.bestModel
    names = dict.fromkeys(param.name for params in model.getEstimatorParamMaps() for param in params)
    rows = [(kind, label, name, float(best.getOrDefault(name))) for name in names]
    return spark.createDataFrame(rows, "model string, label string, param string, value double")


def grid_scores(spark: SparkSession, kind: str, label: str, model: CrossValidatorModel) -> DataFrame:
    """Cross-validated RMSE of every grid point, one row per point."""
    rows = []
    for params, rmse in zip(model.getEstimatorParamMaps(), model.avgMetrics):
        text = ", ".join(f"{param.name}={value}" for param, value in params.items())
        rows.append((kind, label, text, float(rmse)))
    return spark.createDataFrame(rows, "model string, label string, params string, rmse double")
