"""Feature pipelines and the splits that keep test rows out of training."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.ml import Pipeline
from pyspark.ml.feature import MinMaxScaler, OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stopweave.operators.columns import between_dates

# The columns the models see, in the order of the vector.
COORDINATES = ("shapeLatOrig", "shapeLonOrig", "shapeLatDest", "shapeLonDest")
TRAINING_NUMBERS = (
    "hourOrig",
    "isRushOrig",
    "isHoliday",
    "isWeekend",
    "isRegularDay",
    "distance",
    "month",
    "weekOfYear",
    "dayOfMonth",
)
TRAINING_CATEGORIES = ("periodOrig", "weekDay")
TUNING_NUMBERS = (
    "busStopIdOrig",
    "busStopIdDest",
    "hourOrig",
    "isRushOrig",
    "weekOfYear",
    "dayOfMonth",
    "month",
    "isHoliday",
    "isWeekend",
    "isRegularDay",
)
TUNING_CATEGORIES = ("periodOrig", "weekDay", "route")
TRAIN_SHARE, TEST_SHARE, SPLIT_SEED = 0.7, 0.3, 24

#: Seed of the folds of cross-validation.
FOLD_SEED = 5


def coordinate_stages() -> list:
    """Coordinates as one vector, scaled to [0, 1]."""
    return [
        VectorAssembler(inputCols=list(COORDINATES), outputCol="coordinates", handleInvalid="skip"),
        MinMaxScaler(inputCol="coordinates", outputCol="scaledCoordinates"),
    ]


def feature_pipeline(
    numbers: Sequence[str] = TRAINING_NUMBERS,
    categories: Sequence[str] = TRAINING_CATEGORIES,
    one_hot: bool = False,
) -> Pipeline:
    """Numbers, scaled coordinates and indexed categories as ``features``.

    Fit it on training rows only. Rows with a missing number are skipped, and a
    category first seen in test data gets an index of its own.
    """
    indexed = [f"{c}_index" for c in categories]
    stages = [
        *coordinate_stages(),
        StringIndexer(inputCols=list(categories), outputCols=indexed, handleInvalid="keep"),
    ]
    if one_hot:
        vectors = [f"{c}_vector" for c in categories]
        stages.append(OneHotEncoder(inputCols=indexed, outputCols=vectors))
        indexed = vectors
    stages.append(
        VectorAssembler(
            inputCols=[*numbers, "scaledCoordinates", *indexed],
            outputCol="features",
            handleInvalid="skip",
        )
    )
    return Pipeline(stages=stages)


def split_share(keys: Sequence[str], seed: int = SPLIT_SEED) -> Column:
    """A number in [0, 1) that depends on the row's key and the seed alone."""
    text = F.concat_ws("|", F.lit(str(seed)), *(F.col(k).cast("string") for k in keys))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / F.lit(float(2**32))


def hash_split(
    df: DataFrame,
    keys: Sequence[str] = ("visit_id",),
    share: float = TRAIN_SHARE,
    seed: int = SPLIT_SEED,
) -> tuple[DataFrame, DataFrame]:
    """(train, test); a row's side does not change with the partitioning."""
    chosen = split_share(keys, seed) < share
    return df.where(chosen), df.where(~chosen)


def with_folds(df: DataFrame, folds: int, keys: Sequence[str] = ("visit_id",), seed: int = FOLD_SEED) -> DataFrame:
    """``df`` with ``fold``, from 0 to ``folds - 1``; a row's fold does not change with the partitioning.

    The seed is not that of the split, else the training side would fill some folds only.
    """
    return df.withColumn("fold", F.floor(split_share(keys, seed) * folds).cast("int"))


def filled_folds(df: DataFrame, folds: int, keys: Sequence[str] = ("visit_id",)) -> DataFrame:
    """``with_folds``, but rows so few that a fold stays empty are dealt out in turn, by the same hash."""
    dealt = with_folds(df, folds, keys)
    if dealt.select("fold").distinct().count() == folds:
        return dealt
    # A fold of a hash is empty only for a handful of rows: one window does.
    turn = F.row_number().over(Window.orderBy(split_share(keys, FOLD_SEED), *keys))
    return df.withColumn("fold", (turn % folds).cast("int"))


def random_split(
    df: DataFrame, share: float = TRAIN_SHARE, seed: int = SPLIT_SEED
) -> tuple[DataFrame, DataFrame]:
    """(train, test) by Spark's own sampling, which follows the partitioning."""
    train, test = df.randomSplit([share, 1 - share], seed)
    return train, test


def temporal_split(
    df: DataFrame, train_start: date, train_end: date, test_end: date
) -> tuple[DataFrame, DataFrame]:
    """Train on ``train_start``..``train_end``, test on the days after it up to
    ``test_end``, ends included."""
    if not train_start < train_end < test_end:
        raise ValueError("dates must be in order: train_start < train_end < test_end")
    later = df.where((F.col("date") > F.lit(train_end)) & (F.col("date") <= F.lit(test_end)))
    return between_dates(df, train_start, train_end), later
