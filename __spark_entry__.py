"""

Every query reads the whole ``events`` table, laid out as stop records.
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Callable
from datetime import date
from pathlib import Path

from pyspark.ml.feature import StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressionModel, LinearRegressionModel
from pyspark.ml import Pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from checks import oracle
from stopweave.functions.clock import seconds_of_day
from stopweave.functions.geo import geo_distance_km
from stopweave.ml import evaluation, features, linear, models, trees, tuning
from stopweave.operators import alighting, boardings, columns, flows, legs
from stopweave.plans.training_job import TRAINERS, featured_split
from stopweave.schemas import TRIP_STOP
from stopweave.plans.legs_job import run_legs_job
from stopweave.plans.od_job import build_od
from stopweave.session import job_tables, shared_folder, stored
from stopweave.sources.events import visits_from_events
from stopweave.sources.readers import DAY_FORMAT, NULL_MARKER, read_stop_visits
from stopweave.sources.writers import load_model, save_model

try:
    import stopweave.llm.queries as corpus
except ModuleNotFoundError as missing:
    # The corpus operators and their pipeline are optional: the rest works without these files.
    if missing.name not in ("stopweave.llm", "stopweave.llm.queries", "corpus_pipeline"):
        raise
    corpus = None

Query = Callable[[SparkSession, str], DataFrame]

TRAIN_START, TRAIN_END, TEST_END = date(2024, 1, 1), date(2024, 1, 20), date(2024, 1, 30)
LEG_KEY = ("visit_id", "date", "route", "busStopIdOrig", "busStopIdDest")
OD_COLUMNS = (
    "cardNum", *TRIP_STOP, "timestamp_s", "id", "o_boarding_id", "o_stop_id", "o_timestamp_s",
    "next_o_boarding_id", "next_o_stop_id",
)


def r6(*names: str) -> list:
    """Columns rounded for comparison."""
    return [F.round(name, 6).alias(name) for name in names]


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return visits_from_events(events(spark, sf_dir))


def taps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return boardings.dedup_taps(boardings.boardings(visits(spark, sf_dir)))


def chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return boardings.trip_chain(taps(spark, sf_dir))


def stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alighting.trip_stops(visits(spark, sf_dir))


def od(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alighting.trips_od(visits(spark, sf_dir))


def stop_flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flows.stop_flows(od(spark, sf_dir))


def balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flows.stop_balance(stops(spark, sf_dir), stop_flows(spark, sf_dir))


def loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load per trip stop, with the trip stops stored once as the job does."""
    first_visits = stored(stops(spark, sf_dir))
    alighted = alighting.infer_alightings(chain(spark, sf_dir), first_visits)
    return flows.crowdedness(first_visits, flows.stop_flows(alighted))


def all_legs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return legs.featured_legs(visits(spark, sf_dir))


def kept_legs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return legs.split_outliers(all_legs(spark, sf_dir))[0]


def load_legs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training table of the job chain: legs between first visits, with loads."""
    return legs.split_outliers(legs.featured_legs(stored(loads(spark, sf_dir))))[0]


def entry(spark: SparkSession) -> DataFrame:
    """Where did each rider get off?"""
    return infer_alightings(spark, "/root/testdata/sf0.001")


def infer_alightings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return od(spark, sf_dir).select(*OD_COLUMNS, *r6("leg_duration", "dist"))


def infer_alightings_per_boarding(spark: SparkSession, sf_dir: str) -> DataFrame:
    per_boarding = alighting.trips_od(visits(spark, sf_dir), per="boarding")
    return per_boarding.select(*OD_COLUMNS, *r6("leg_duration", "dist"))


def scan_stop_visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = visits(spark, sf_dir)
    exact = [c for c in df.columns if c not in ("shapeLat", "shapeLon")]
    return df.select(*exact, *r6("shapeLat", "shapeLon"))


def csv_visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records written as day folders of two layouts, and read back by name."""
    clock = lambda c: F.date_format(F.timestamp_seconds(c), "HH:mm:ss")
    day = F.date_format("date", DAY_FORMAT)
    text = visits(spark, sf_dir).withColumns(
        {"timestamp": clock("timestamp_s"), "cardTimestamp": clock("cardTimestamp_s"), "date": day, "day": day}
    ).drop("timestamp_s", "cardTimestamp_s")
    folder = f"{shared_folder(spark)}/csv-{uuid.uuid4().hex}"
    odd = F.pmod(F.dayofmonth(F.to_date("day", DAY_FORMAT)), F.lit(2)) == 1
    options = {"header": "true", "nullValue": NULL_MARKER}
    text.where(~odd).repartition("day").write.partitionBy("day").options(**options).csv(f"{folder}/0")
    # The other days: columns the other way round, and two blank lines before the header.
    turned = [c for c in reversed(text.columns) if c != "day"]
    record = text.where(odd).select("day", F.lit(1).alias("place"), F.to_csv(F.struct(*turned), options).alias("value"))
    heads = record.select("day").distinct().select(
        "day", F.lit(0).alias("place"), F.explode(F.array(F.lit(""), F.lit("  "), F.lit(",".join(turned)))).alias("value")
    )
    lines = heads.withColumn("place", F.when(F.col("value").contains(","), 0).otherwise(-1)).union(record)
    ordered = lines.repartition("day").sortWithinPartitions("day", "place").select("day", "value")
    ordered.write.partitionBy("day").text(f"{folder}/1")
    records = read_stop_visits(spark, [f"{folder}/0/*", f"{folder}/1/*"])
    exact = [c for c in visits(spark, sf_dir).columns if c not in ("visit_id", "route", "cardNum", "shapeLat", "shapeLon")]
    numbers = [F.col(c).cast(t).alias(c) for c, t in (("visit_id", "bigint"), ("route", "int"), ("cardNum", "bigint"))]
    return records.select(*numbers, *exact, *r6("shapeLat", "shapeLon"))


def legs_job_train_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The training table as the origin-destination and leg jobs write it."""
    folder = f"{shared_folder(spark)}/jobs-{uuid.uuid4().hex}"
    with job_tables(spark):
        build_od(visits(spark, sf_dir), folder)
    run_legs_job(spark, f"{folder}/od/crowdedness", f"{folder}/legs")
    return spark.read.parquet(f"{folder}/legs/train_data").select(
        *LEG_KEY, "duration", "distance", *r6("crowdedness", "speed", "pacing"), "hourOrig", "weekDay"
    )


def date_range_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = columns.between_dates(visits(spark, sf_dir), date(2024, 1, 8), date(2024, 1, 21))
    return days.select("visit_id", "date", "route", "timestamp_s")


def union_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = visits(spark, sf_dir).select("visit_id", "date", "stopPointId")
    early = F.col("date") < F.lit(date(2024, 1, 16))
    return columns.union_tables([df.where(early), df.where(~early)])


def rename_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = [("stopPointId", "busStopId"), ("cardNum", "card"), ("absent", "skipped")]
    return columns.rename_columns(visits(spark, sf_dir), pairs).select("visit_id", "busStopId", "card")


def clean_visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = boardings.clean_visits(visits(spark, sf_dir))
    return cleaned.select("visit_id", *TRIP_STOP, "timestamp_s")


def tap_columns(df: DataFrame) -> DataFrame:
    return df.select("visit_id", "cardNum", "date", "cardTimestamp_s")


def circular_lead(spark: SparkSession, sf_dir: str) -> DataFrame:
    following = boardings.circular_lead(
        taps(spark, sf_dir), boardings.CARD_DAY, ["cardTimestamp_s"], {"visit_id": "next_visit_id"}
    )
    return following.select("visit_id", "cardNum", "date", "cardTimestamp_s", "next_visit_id")


def trip_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chain(spark, sf_dir).select(
        "cardNum", "o_date", "o_route", "o_bus_code", "o_tripNum", "o_timestamp_s", "o_shape_id",
        "o_shape_seq", *r6("o_shape_lat", "o_shape_lon"), "o_stop_id", "o_boarding_id",
        "next_o_route", "next_o_tripNum", "next_o_timestamp_s", "next_o_stop_id",
        "next_o_boarding_id",
    )


def leg_duration(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chain(spark, sf_dir).select("cardNum", "o_date", "o_timestamp_s", *r6("leg_duration"))


def alighting_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    near = alighting.alighting_candidates(chain(spark, sf_dir), stops(spark, sf_dir))
    return near.select("cardNum", "o_boarding_id", "id", "stopPointId", "timestamp_s", *r6("dist"))


def route_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    factors = flows.route_factors(stops(spark, sf_dir), stop_flows(spark, sf_dir))
    return factors.select(
        "date", "route", "trip_stop_cnt", "odmatrix_boarding", *r6("extrap_factor")
    )


def stop_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return balance(spark, sf_dir).select(*TRIP_STOP, "boarding_cnt", "alighting_cnt", "crowd_bal")


def running_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    running = flows.running_load(balance(spark, sf_dir))
    return running.select(*TRIP_STOP, "timestamp_s", "crowd_bal", "num_pass")


def crowdedness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return loads(spark, sf_dir).select(
        *TRIP_STOP, "timestamp_s", "boarding_cnt", "alighting_cnt", "crowd_bal", "num_pass",
        *r6("extrap_factor", "ext_num_pass"),
    )


def geo_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distance of every record from the head of the line, by both formulas."""
    here = (F.col("shapeLat"), F.col("shapeLon"))
    head = (F.lit(-25.4), F.lit(-49.25))
    return visits(spark, sf_dir).select(
        "visit_id",
        F.round(geo_distance_km(*here, *head), 6).alias("haversine_km"),
        F.round(geo_distance_km(*here, *head, method="cosines"), 4).alias("cosines_km"),
    )


def seconds_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.date_format("ts", "HH:mm:ss")
    timed = events(spark, sf_dir).select("event_id", text.alias("time_text"))
    return timed.withColumn("seconds", seconds_of_day(F.col("time_text")))


def stop_to_stop(spark: SparkSession, sf_dir: str) -> DataFrame:
    return legs.stop_to_stop(visits(spark, sf_dir)).select(
        *LEG_KEY, "timestampOrig_s", "timestampDest_s", "tripNumOrig", "tripNumDest",
        *r6("shapeLatOrig", "shapeLonOrig", "shapeLatDest", "shapeLonDest"),
        "distanceTraveledShapeOrig", "distanceTraveledShapeDest",
    )


def leg_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    featured = legs.leg_features(legs.stop_to_stop(visits(spark, sf_dir)))
    return featured.select(*LEG_KEY, "duration", "distance", *r6("speed", "pacing"))


def calendar_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    featured = legs.calendar_features(legs.stop_to_stop(visits(spark, sf_dir)))
    return featured.select(
        *LEG_KEY, "hourOrig", "hourDest", "isRushOrig", "isRushDest", "periodOrig", "periodDest",
        "weekDay", "weekOfYear", "dayOfMonth", "month", "isHoliday", "isWeekend", "isRegularDay",
    )


def clean_legs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return legs.clean_legs(all_legs(spark, sf_dir)).select(*LEG_KEY, "duration", *r6("velocityKmh"))


def crowdedness_legs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_legs(spark, sf_dir).select(
        *LEG_KEY, "duration", "distance", *r6("crowdedness", "speed", "pacing"), "hourOrig", "weekDay"
    )


def complete_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    complete = columns.complete_cases(load_legs(spark, sf_dir))
    return complete.select(*LEG_KEY, "duration", *r6("crowdedness"))


def split_by_date(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return features.temporal_split(kept_legs(spark, sf_dir), TRAIN_START, TRAIN_END, TEST_END)


def hash_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    share = features.split_share(["visit_id"])
    side = F.when(share < features.TRAIN_SHARE, "train").otherwise("test")
    return kept_legs(spark, sf_dir).select(*LEG_KEY, side.alias("side"))


def describe_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = evaluation.describe_predictions(load_legs(spark, sf_dir))
    return summary.select("label", "count", *r6("mean", "stddev", "min", "max"))


def regression_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors of the mean duration per route and hour as a prediction."""
    kept = stored(kept_legs(spark, sf_dir).select("route", "hourOrig", "duration"))
    means = kept.groupBy("route", "hourOrig").agg(F.avg("duration").alias("prediction"))
    predicted = kept.join(means, ["route", "hourOrig"])
    metrics = evaluation.regression_metrics(predicted, "duration")
    return metrics.select("n", *r6("rmse", "mae", "r2"))


def minmax_scaled(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = stored(kept_legs(spark, sf_dir).select("visit_id", *features.COORDINATES))
    scaled = Pipeline(stages=features.coordinate_stages()).fit(kept).transform(kept)
    parts = vector_to_array("scaledCoordinates")
    names = ("lat_orig", "lon_orig", "lat_dest", "lon_dest")
    return scaled.select(
        "visit_id", *(F.round(parts[i], 6).alias(name) for i, name in enumerate(names))
    )


def string_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    categories = list(features.TRAINING_CATEGORIES)
    kept = stored(kept_legs(spark, sf_dir).select(*categories))
    indexed = [f"{c}_index" for c in categories]
    model = StringIndexer(inputCols=categories, outputCols=indexed, handleInvalid="keep").fit(kept)
    long = model.transform(kept).select(
        F.inline(
            F.array(
                *(
                    F.struct(F.lit(c).alias("category"), F.col(c).alias("value"), F.col(i).alias("idx"))
                    for c, i in zip(categories, indexed)
                )
            )
        )
    )
    return long.groupBy("category", "value", "idx").agg(F.count(F.lit(1)).alias("cnt"))


def feature_vector(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = stored(kept_legs(spark, sf_dir))
    train, _ = features.hash_split(kept)
    parts = vector_to_array("features")
    names = [f"f{i:02d}" for i in range(15)]
    return (
        features.feature_pipeline()
        .fit(train)
        .transform(kept)
        .select("visit_id", *(F.round(parts[i], 6).alias(name) for i, name in enumerate(names)))
    )


def tuning_feature_vector(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The vector of the tuning models, fitted on the days before the test days."""
    kept = stored(kept_legs(spark, sf_dir))
    train, _ = features.temporal_split(kept, TRAIN_START, TRAIN_END, TEST_END)
    pipeline = features.feature_pipeline(features.TUNING_NUMBERS, features.TUNING_CATEGORIES)
    parts = vector_to_array("features")
    columns_17 = (F.round(parts[i], 6).alias(f"f{i:02d}") for i in range(17))
    return pipeline.fit(train).transform(kept).select("visit_id", *columns_17)


def fitted_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Means of label and training prediction for each label; a least-squares fit keeps the mean."""
    split = features.hash_split(stored(load_legs(spark, sf_dir)))
    _, train, test = featured_split(*split, features.TRAINING_NUMBERS, features.TRAINING_CATEGORIES)
    test = stored(test)
    reports = []
    for label, trainer in TRAINERS.items():
        model = trainer(train, label)
        known = evaluation.score(model, train.where(F.col(label).isNotNull()), [label])
        means = known.agg(
            F.count(F.lit(1)).alias("n_train"),
            F.round(F.avg(label), 6).alias("mean_label"),
            F.round(F.avg("prediction"), 6).alias("mean_prediction"),
        )
        tested = evaluation.score(model, test, [label]).agg(F.count("prediction").alias("n_test"))
        # One row on each side.
        reports.append(means.crossJoin(tested).select(F.lit(label).alias("label"), "*"))
    return columns.union_tables(reports)


def predict(label: str) -> Query:
    """Train on a share of the legs and predict the label of the others."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        split = features.hash_split(stored(load_legs(spark, sf_dir)))
        _, train, test = featured_split(
            *split, features.TRAINING_NUMBERS, features.TRAINING_CATEGORIES
        )
        return evaluation.score(TRAINERS[label](train, label), test, [*LEG_KEY, label])

    return run


def lasso_optimality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far the coefficients of the lasso of travel times, fitted to the end, are from the conditions of the optimum."""
    split = features.hash_split(stored(kept_legs(spark, sf_dir)))
    _, train, _ = featured_split(*split, features.TRAINING_NUMBERS, features.TRAINING_CATEGORIES)
    label = "duration"
    model = models.fit(models.lasso(label).setMaxIter(1000).setTol(1e-12), train)
    sums = stored(linear.gram(train, label, model.numFeatures))
    away = linear.optimality(sums, model, models.LASSO_PENALTY)
    worst = away.agg(F.round(F.max("violation"), 4).alias("violation")).first()["violation"]
    rows = sums.where((F.col("i") == F.col("j")) & (F.col("i") == model.numFeatures + 1))
    return rows.select(F.lit(label).alias("label"), F.col("total").cast("bigint").alias("n_train"), F.lit(worst).alias("violation"))


def stored_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Largest differences of predictions by models saved and loaded, and by their tables of trees."""
    split = features.hash_split(stored(kept_legs(spark, sf_dir)))
    _, train, test = featured_split(*split, features.TRAINING_NUMBERS, features.TRAINING_CATEGORIES)
    test = stored(test)
    reports = []
    for label, kind in (("duration", LinearRegressionModel), ("pacing", GBTRegressionModel)):
        model = TRAINERS[label](train, label)
        path = f"{shared_folder(spark)}/model-{uuid.uuid4().hex}"
        save_model(model, path)
        again = load_model(kind, path).setPredictionCol("again")
        both = again.transform(model.transform(test)).select("visit_id", "prediction", "again")
        if kind is GBTRegressionModel:
            table = stored(trees.tree_table(test, model))
            walked = trees.scored_by_table(test, table, ["visit_id"], models.TREE_DEPTH).withColumnRenamed("prediction", "walked")
            both = both.join(walked, "visit_id")
        else:
            both = both.withColumn("walked", F.lit(None).cast("double"))
        away = lambda c: F.round(F.max(F.abs(F.col(c) - F.col("prediction"))), 6)
        found = both.agg(F.count(F.lit(1)).alias("n_test"), away("again").alias("loaded_away"), away("walked").alias("table_away"))
        reports.append(found.select(F.lit(label).alias("label"), "*"))
    return columns.union_tables(reports)


def tuning_train(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = stored(columns.complete_cases(load_legs(spark, sf_dir)))
    train, test = features.temporal_split(table, TRAIN_START, TRAIN_END, TEST_END)
    return featured_split(train, test, features.TUNING_NUMBERS, features.TUNING_CATEGORIES)[1]


def tune(spark: SparkSession, sf_dir: str, kind: str, label: str) -> object:
    return tuning.tune_model(kind, tuning_train(spark, sf_dir), label)


def cv_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Legs in each fold of the tuning models' cross-validation."""
    split = features.temporal_split(kept_legs(spark, sf_dir), TRAIN_START, TRAIN_END, TEST_END)
    return features.with_folds(split[0], 5).groupBy("fold").agg(F.count(F.lit(1)).alias("n"))


def best_is_least(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each tuned label: folds, legs and grid points of the search, and whether the chosen point has the least mean error."""
    train = tuning_train(spark, sf_dir)
    reports = []
    for label in ("crowdedness", "pacing"):
        model = tuning.tune_model("lasso", train, label, keep_fits=True)
        scores = tuning.fold_scores(train, label, model)
        means = stored(scores.groupBy("params").agg(F.avg("rmse").alias("rmse"), F.count(F.lit(1)).alias("folds"), F.sum("n").alias("n")))
        told = tuning.grid_scores(spark, "lasso", label, model).select("params", F.col("rmse").alias("told"))
        best = {r["param"]: r["value"] for r in tuning.best_params(spark, "lasso", label, model).collect()}
        chosen = F.lit(True)
        for name, value in best.items():
            chosen = chosen & (F.regexp_extract("params", f"{name}=([0-9.eE+-]+)", 1).cast("double") == F.lit(value))
        found = means.join(told, "params").agg(
            F.count(F.lit(1)).alias("points"),
            F.min("folds").alias("folds"),
            F.max("n").alias("n"),
            F.every(F.abs(F.col("rmse") - F.col("told")) < 1e-6).alias("means_agree"),
            (F.min(F.when(chosen, F.col("rmse"))) <= F.min("rmse") + 1e-9).alias("best_is_least"),
        )
        reports.append(found.select(F.lit(label).alias("label"), "*"))
    return columns.union_tables(reports)


def cross_validate(kind: str, label: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return tuning.grid_scores(spark, kind, label, tune(spark, sf_dir, kind, label))

    return run


def best_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = tune(spark, sf_dir, "lasso", "crowdedness")
    return tuning.best_params(spark, "lasso", "crowdedness", model)


def queries() -> dict[str, Query]:
    return transit_queries() | (corpus.queries() if corpus else {})


def transit_queries() -> dict[str, Query]:
    return {
        "scan_stop_visits": scan_stop_visits,
        "csv_visits": csv_visits,
        "date_range_scan": date_range_scan,
        "union_days": union_days,
        "rename_columns": rename_columns,
        "clean_visits": clean_visits,
        "boardings": lambda s, d: tap_columns(boardings.boardings(visits(s, d))),
        "dedup_taps": lambda s, d: tap_columns(taps(s, d)),
        "taps_per_card": lambda s, d: boardings.taps_per_card(taps(s, d)),
        "repeat_boardings": lambda s, d: tap_columns(boardings.repeat_boardings(taps(s, d))),
        "circular_lead": circular_lead,
        "trip_chain": trip_chain,
        "leg_duration": leg_duration,
        "trip_stops": lambda s, d: stops(s, d).select(
            *TRIP_STOP, "timestamp_s", "visit_id", "shapeId"
        ),
        "alighting_candidates": alighting_candidates,
        "infer_alightings": infer_alightings,
        "infer_alightings_per_boarding": infer_alightings_per_boarding,
        "trip_origins": lambda s, d: flows.trip_origins(od(s, d)),
        "trip_destinations": lambda s, d: flows.trip_destinations(od(s, d)),
        "stop_flows": stop_flows,
        "route_factors": route_factors,
        "stop_balance": stop_balance,
        "running_load": running_load,
        "crowdedness": crowdedness,
        "geo_distance": geo_distance,
        "seconds_of_day": seconds_query,
        "route_stops": lambda s, d: legs.route_stops(visits(s, d)),
        "stop_to_stop": stop_to_stop,
        "leg_features": leg_features,
        "calendar_features": calendar_features,
        "legs_kept": lambda s, d: kept_legs(s, d).select(*LEG_KEY, "duration"),
        "legs_outliers": lambda s, d: legs.split_outliers(all_legs(s, d))[1].select(
            *LEG_KEY, "duration"
        ),
        "clean_legs": clean_legs,
        "crowdedness_legs": crowdedness_legs,
        "legs_job_train_data": legs_job_train_data,
        "complete_cases": complete_cases,
        "split_train": lambda s, d: split_by_date(s, d)[0].select(*LEG_KEY, "duration"),
        "split_test": lambda s, d: split_by_date(s, d)[1].select(*LEG_KEY, "duration"),
        "hash_split": hash_split,
        "route_arity": lambda s, d: models.route_arity(kept_legs(s, d)),
        "describe_labels": describe_labels,
        "regression_metrics": regression_metrics,
        "minmax_scaled": minmax_scaled,
        "string_index": string_index,
        "feature_vector": feature_vector,
        "tuning_feature_vector": tuning_feature_vector,
        "fitted_means": fitted_means,
        "predict_duration": predict("duration"),
        "predict_crowdedness": predict("crowdedness"),
        "predict_pacing": predict("pacing"),
        "predict_speed": predict("speed"),
        "cv_lasso": cross_validate("lasso", "crowdedness"),
        "cv_random_forest": cross_validate("rf", "crowdedness"),
        "cv_gbt": cross_validate("gbt", "crowdedness"),
        "best_params": best_params,
        "cv_folds": cv_folds,
        "best_is_least": best_is_least,
        "lasso_optimality": lasso_optimality,
        "stored_models": stored_models,
    }


def oracle_sql() -> dict[str, str]:
    statements = oracle.statements()
    # Written and read again, the tables are the same.
    statements["csv_visits"] = statements["scan_stop_visits"]
    statements["legs_job_train_data"] = statements["crowdedness_legs"]
    return statements | (corpus.oracle_sql() if corpus else {})
