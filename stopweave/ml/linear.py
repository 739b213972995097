"""Linear models checked from one aggregate over their training rows."""

from __future__ import annotations

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stopweave.operators.columns import drop_missing


def gram(features: DataFrame, label: str, size: int) -> DataFrame:
    """``(i, j, total)``: sums of products of features ``i`` and ``j`` over the rows with a label.

    Feature ``size`` is the label and feature ``size + 1`` is 1, so that sums and the number of
    rows are among them. One aggregate, merged in each task before anything is
    moved: its result has as many rows for any number of legs.
    """
    known = drop_missing(features, [label])
    values = known.select(F.array_append(F.array_append(vector_to_array("features"), F.col(label).cast("double")), F.lit(1.0)).alias("x"))
    places = [(i, j) for i in range(size + 2) for j in range(i, size + 2)]
    sums = values.agg(F.array(*(F.sum(F.col("x")[i] * F.col("x")[j]) for i, j in places)).alias("totals"))
    pairs = F.array(*(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i, j in places))
    each = sums.select(F.inline(F.arrays_zip(pairs.alias("pair"), F.col("totals"))))
    return each.select("pair.i", "pair.j", F.col("totals").alias("total"))


def optimality(sums: DataFrame, model: LinearRegressionModel, penalty: float) -> DataFrame:
    """``(feature, coefficient, slope, violation)``: how far each coefficient is from the optimum.

    ``slope`` is that of the squared error, over one standard deviation of the feature. With an
    L1 penalty the best coefficients have a slope of ``-penalty`` if positive, ``penalty``
    if negative, and one between the two if zero; ``violation`` is the distance from that,
    in standard deviations of the label.
    """
    size = len(model.coefficients) + 2
    totals = np.zeros((size, size))
    for i, j, total in sums.collect():
        totals[i, j] = totals[j, i] = total
    n = totals[-1, -1]
    mean = totals[-1] / n
    spread = totals / n - np.outer(mean, mean)
    weights = np.asarray(model.coefficients)
    slopes = spread[:-2, :-2] @ weights - spread[:-2, -2]
    deviations = np.sqrt(np.maximum(np.diag(spread), 0) * n / max(n - 1, 1))
    label = deviations[-2] or 1.0
    rows = []
    for k, (weight, slope, sigma) in enumerate(zip(weights, slopes, deviations[:-2], strict=True)):
        # A feature that does not vary has no part in the model.
        slope = slope / sigma if sigma > 1e-9 * (1 + abs(mean[k])) else 0.0
        away = abs(slope + penalty * np.sign(weight)) if weight and sigma else max(abs(slope) - penalty, 0.0)
        rows.append((k, float(weight), float(slope), float(away / label)))
    return sums.sparkSession.createDataFrame(rows, "feature int, coefficient double, slope double, violation double")
