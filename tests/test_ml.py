from __future__ import annotations

from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegressionModel
from pyspark.sql import functions as F

from stopweave.ml import evaluation, features, linear, models, trees, tuning
from stopweave.plans.training_job import featured_split
from stopweave.session import stored
from stopweave.sources.writers import load_model, save_model


@pytest.fixture(scope="module")
def planted(spark):
    """Legs whose duration is a linear function of two features, plus noise."""
    i = F.col("id")
    day = F.date_add(F.lit(date(2024, 1, 1)), (i % 20).cast("int"))
    hour = (i % 24).cast("int")
    distance = (i * 37 % 900).cast("double") + 100
    noise = (F.xxhash64(i) % 1000) / 1000.0
    df = spark.range(3000).select(
        i.alias("visit_id"),
        day.alias("date"),
        (i % 3).cast("string").alias("route"),
        (i % 40).cast("int").alias("busStopIdOrig"),
        (i % 40 + 1).cast("int").alias("busStopIdDest"),
        (F.lit(-25.0) - i % 50 / 1000).alias("shapeLatOrig"),
        (F.lit(-49.0) - i % 70 / 1000).alias("shapeLonOrig"),
        (F.lit(-25.0) - i % 51 / 1000).alias("shapeLatDest"),
        (F.lit(-49.0) - i % 71 / 1000).alias("shapeLonDest"),
        hour.alias("hourOrig"),
        hour.isin(6, 7, 17, 18).cast("int").alias("isRushOrig"),
        F.lit(1).alias("isHoliday"),
        F.lit(0).alias("isWeekend"),
        F.lit(1).alias("isRegularDay"),
        distance.alias("distance"),
        F.month(day).alias("month"),
        F.weekofyear(day).alias("weekOfYear"),
        F.dayofmonth(day).alias("dayOfMonth"),
        F.when(hour < 12, "morning").otherwise("night").alias("periodOrig"),
        F.date_format(day, "E").alias("weekDay"),
        (distance * 0.2 + hour * 5 + noise).alias("duration"),
        F.when(i % 5 != 0, hour * 2.0 + noise).alias("crowdedness"),
    )
    df = df.withColumn("speed", F.col("distance") / F.col("duration"))
    return stored(df.withColumn("pacing", F.col("duration") / F.col("distance")))


@pytest.fixture(scope="module")
def sides(planted):
    return featured_split(
        *features.hash_split(planted), features.TRAINING_NUMBERS, features.TRAINING_CATEGORIES
    )


def test_metrics_equal_numpy(spark):
    rng = np.random.default_rng(1)
    actual, guess = rng.normal(5, 2, 300), rng.normal(5, 2, 300)
    rows = [(float(a), float(g)) for a, g in zip(actual, guess)] + [(None, 1.0), (1.0, None)]
    df = spark.createDataFrame(rows, "y double, prediction double")
    got = evaluation.regression_metrics(df, "y").first()
    error = guess - actual
    assert got.n == 300
    assert got.rmse == pytest.approx(np.sqrt((error**2).mean()))
    assert got.mae == pytest.approx(abs(error).mean())
    assert got.r2 == pytest.approx(1 - (error**2).sum() / ((actual - actual.mean()) ** 2).sum())


def test_metrics_of_a_constant_label(spark):
    df = spark.createDataFrame([(2.0, 2.0), (2.0, 3.0)], "y double, prediction double")
    assert evaluation.regression_metrics(df, "y").first().r2 is None


def test_metrics_per_group(spark):
    df = spark.createDataFrame([("a", 1.0, 2.0), ("b", 1.0, 1.0)], "k string, y double, prediction double")
    got = {r.k: r.mae for r in evaluation.regression_metrics(df, "y", "k").collect()}
    assert got == {"a": 1.0, "b": 0.0}


def test_describe(spark):
    df = spark.createDataFrame([(1.0, None), (3.0, 5.0)], "a double, b double")
    got = {r.label: tuple(r)[1:] for r in evaluation.describe_predictions(df, ["a", "b"]).collect()}
    assert got == {"a": (2, 2.0, pytest.approx(2**0.5), 1.0, 3.0), "b": (1, 5.0, None, 5.0, 5.0)}


@pytest.mark.parametrize("partitions", [1, 7, 50])
def test_hash_split_ignores_the_partitioning(planted, partitions):
    train, test = features.hash_split(planted)
    again, _ = features.hash_split(planted.repartition(partitions))
    assert set(train.select("visit_id").collect()) == set(again.select("visit_id").collect())
    assert train.count() + test.count() == planted.count()
    assert 0.65 < train.count() / planted.count() < 0.75


def test_random_split_is_complete(planted):
    train, test = features.random_split(planted)
    assert train.count() + test.count() == planted.count()


def test_temporal_split_ends(planted):
    train, test = features.temporal_split(planted, date(2024, 1, 3), date(2024, 1, 10), date(2024, 1, 15))
    bounds = [df.agg(F.min("date"), F.max("date")).first() for df in (train, test)]
    assert tuple(bounds[0]) == (date(2024, 1, 3), date(2024, 1, 10))
    assert tuple(bounds[1]) == (date(2024, 1, 11), date(2024, 1, 15))


@pytest.mark.parametrize("end, test_end", [(1, 5), (5, 5), (6, 5)])
def test_dates_out_of_order_are_refused(planted, end, test_end):
    start = date(2024, 1, 1)
    with pytest.raises(ValueError):
        features.temporal_split(planted, start, start + timedelta(end - 1), start + timedelta(test_end - 1))


def test_vector_layouts(planted):
    training = features.feature_pipeline().fit(planted).transform(planted)
    assert len(training.first()["features"].toArray()) == 15
    tuned = features.feature_pipeline(features.TUNING_NUMBERS, features.TUNING_CATEGORIES)
    assert len(tuned.fit(planted).transform(planted).first()["features"].toArray()) == 17
    one_hot = features.feature_pipeline(one_hot=True).fit(planted).transform(planted)
    assert len(one_hot.first()["features"].toArray()) > 15


def test_coordinates_are_scaled_to_the_unit_interval(planted):
    scaled = features.feature_pipeline().fit(planted).transform(planted)
    values = scaled.select(F.explode(vector_to_array("scaledCoordinates")).alias("v"))
    low, high = values.agg(F.min("v"), F.max("v")).first()
    assert (low, high) == (pytest.approx(0), pytest.approx(1))


def test_category_first_seen_in_test_data_has_its_own_index(planted):
    model = features.feature_pipeline().fit(planted.where("weekDay <> 'Sun'"))
    seen = model.transform(planted).where("weekDay = 'Sun'").select("weekDay_index").distinct()
    assert [r[0] for r in seen.collect()] == [6.0]


@pytest.mark.parametrize("label", ["duration", "crowdedness"])
def test_lasso_beats_the_mean(sides, label):
    _, train, test = sides
    metrics = evaluation.evaluate(models.train_lasso(train, label), test, label).first()
    assert metrics.r2 > 0.95


def test_boosted_trees_beat_the_mean(sides):
    _, train, test = sides
    assert evaluation.evaluate(models.train_gbt(train, "pacing"), test, "pacing").first().r2 > 0.5


def test_label_null_only_matters_for_its_own_label(sides):
    _, train, test = sides
    assert train.where("crowdedness is null").count() > 0
    known = test.where("crowdedness is not null").count()
    crowd = evaluation.evaluate(models.train_lasso(train, "crowdedness"), test, "crowdedness").first()
    time = evaluation.evaluate(models.train_lasso(train, "duration"), test, "duration").first()
    assert (crowd.n, time.n) == (known, test.count())


def test_reloaded_models_predict_the_same(sides, planted, tmp_path):
    pipeline, train, _ = sides
    model = models.train_lasso(train, "duration")
    save_model(pipeline, str(tmp_path / "pipeline"))
    save_model(model, str(tmp_path / "model"))
    again = load_model(LinearRegressionModel, str(tmp_path / "model"))
    prepared = load_model(PipelineModel, str(tmp_path / "pipeline")).transform(planted)
    want = model.transform(pipeline.transform(planted)).select("visit_id", "prediction").collect()
    assert set(again.transform(prepared).select("visit_id", "prediction").collect()) == set(want)


def test_bins_grow_with_the_routes(planted):
    assert models.tree_bins(planted) == 300
    assert models.tree_bins(planted, least=3) == 4


@pytest.mark.parametrize("kind", ["rf", "gbt"])
def test_trees_over_400_routes(spark, planted, kind):
    many = planted.withColumn("route", F.concat(F.lit("r"), (F.col("visit_id") % 400).cast("string")))
    assert models.tree_bins(many) == 401
    pipeline = features.feature_pipeline(features.TUNING_NUMBERS, features.TUNING_CATEGORIES)
    train = pipeline.fit(many).transform(many)
    build = tuning.SEARCHES[kind].build
    search = tuning.Search(build, {"maxDepth": (2,), "maxBins": (300,)}, 2)
    fitted = tuning.tune_model(kind, train, "duration", search)
    best = {r.param: r.value for r in tuning.best_params(spark, kind, "duration", fitted).collect()}
    assert best == {"maxDepth": 2.0, "maxBins": 401.0}


def test_best_params_are_those_searched(spark, sides):
    _, train, _ = sides
    search = tuning.Search(models.lasso, {"maxIter": (5,), "elasticNetParam": (0.0, 1.0)}, 2)
    fitted = tuning.tune_model("lasso", train, "duration", search)
    best = tuning.best_params(spark, "lasso", "duration", fitted)
    assert {r.param for r in best.collect()} == {"maxIter", "elasticNetParam"}


def test_tuning_prefers_the_weaker_penalty(spark, sides):
    _, train, _ = sides
    search = tuning.Search(models.lasso, {"maxIter": (10,), "regParam": (50.0, 0.01)}, 2)
    fitted = tuning.tune_model("lasso", train, "duration", search)
    best = tuning.best_params(spark, "lasso", "duration", fitted)
    assert {r.param: r.value for r in best.collect()} == {"maxIter": 10.0, "regParam": 0.01}
    scores = tuning.grid_scores(spark, "lasso", "duration", fitted)
    assert scores.count() == 2 and scores.where("rmse > 0").count() == 2


def test_full_grids_have_the_documented_sizes():
    sizes = {}
    for kind, search in tuning.SEARCHES.items():
        points = 1
        for values in search.grid.values():
            points *= len(values)
        sizes[kind] = (points, search.folds)
    assert sizes == {"lasso": (4, 5), "rf": (6, 2), "gbt": (3, 5)}


def test_folds_and_errors_do_not_follow_the_partitioning(spark, sides):
    _, train, _ = sides
    search = tuning.Search(models.lasso, {"maxIter": (10,), "regParam": (50.0, 0.01)}, 3)
    found = []
    for parts in (1, 16):
        dealt = train.repartition(parts)
        sizes = {r["fold"]: r["count"] for r in features.with_folds(dealt, 3).groupBy("fold").count().collect()}
        fitted = tuning.tune_model("lasso", dealt, "duration", search)
        found.append((sizes, [round(x, 6) for x in fitted.avgMetrics]))
    assert found[0] == found[1] and set(found[0][0]) == {0, 1, 2}
    assert min(found[0][0].values()) > train.count() / 4


def test_fold_scores_are_what_the_search_averages(spark, sides):
    _, train, _ = sides
    search = tuning.Search(models.lasso, {"maxIter": (10,), "regParam": (50.0, 0.01)}, 3)
    fitted = tuning.tune_model("lasso", train, "crowdedness", search, keep_fits=True)
    scores = tuning.fold_scores(train, "crowdedness", fitted).collect()
    assert len(scores) == 6 and sum(r.n for r in scores if r.point == 0) == train.where("crowdedness is not null").count()
    for point, told in enumerate(fitted.avgMetrics):
        assert np.mean([r.rmse for r in scores if r.point == point]) == pytest.approx(told, abs=1e-9)
    worse, better = ({r.fold: r.rmse for r in scores if f"regParam={x}" in r.params} for x in ("50.0", "0.01"))
    assert all(better[k] < worse[k] for k in worse)


def test_sums_of_products_equal_those_of_a_matrix(spark, sides):
    _, train, _ = sides
    size = len(train.first()["features"])
    rows = train.where("crowdedness is not null").select(vector_to_array("features").alias("x"), "crowdedness").collect()
    matrix = np.array([[*r.x, r.crowdedness, 1.0] for r in rows])
    sums = linear.gram(train, "crowdedness", size).collect()
    assert len(sums) == (size + 2) * (size + 3) // 2
    expected = matrix.T @ matrix
    assert all(r.total == pytest.approx(expected[r.i, r.j], rel=1e-9) for r in sums)


def test_only_the_optimum_meets_its_conditions(spark, sides):
    _, train, _ = sides
    best = models.fit(models.lasso("duration").setMaxIter(1000).setTol(1e-12).setRegParam(0.5), train)
    sums = linear.gram(train, "duration", best.numFeatures)
    worst = lambda model, penalty: max(r.violation for r in linear.optimality(sums, model, penalty).collect())
    assert worst(best, 0.5) < 1e-5
    assert worst(best, 0.1) > 5e-3
    assert worst(models.fit(models.lasso("duration").setMaxIter(1).setRegParam(0.5), train), 0.5) > 1e-4
    assert any(r.coefficient == 0 for r in linear.optimality(sums, best, 0.5).collect())


@pytest.mark.parametrize("kind", ["gbt", "rf"])
def test_trees_as_a_table_predict_what_the_model_does(spark, sides, kind):
    _, train, test = sides
    label = "pacing"
    model = models.train_gbt(train, label) if kind == "gbt" else models.fit(models.random_forest(label), train)
    table = trees.tree_table(test, model)
    assert table.select("tree").distinct().count() == model.getNumTrees
    assert table.where("left_values is not null").count() > 0
    walked = trees.scored_by_table(test, table, ["visit_id"], 5, mean=kind == "rf")
    both = walked.withColumnRenamed("prediction", "walked").join(model.transform(test), "visit_id")
    assert both.count() == test.count() > 0
    assert both.where("abs(walked - prediction) > 1e-9").isEmpty()


def test_a_handful_of_rows_fills_every_fold(spark):
    few = spark.range(6).withColumnRenamed("id", "visit_id")
    for parts in (1, 5):
        folds = features.filled_folds(few.repartition(parts), 5).orderBy("visit_id").collect()
        assert {r.fold for r in folds} == set(range(5))
        first = folds if parts == 1 else first
        assert folds == first
