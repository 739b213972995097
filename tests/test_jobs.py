"""The four jobs from delivered CSV files to models."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from stopweave.functions.clock import time_text
from stopweave.ml import features, models, tuning
from stopweave.operators import alighting as A
from stopweave.plans.legs_job import run_legs_job
from stopweave.plans.od_job import run_od_job
from stopweave.plans.training_job import run_training_job
from stopweave.plans.tuning_job import run_tuning_job
from stopweave.sources.readers import read_crowdedness, read_legs, read_table

START, END = date(2024, 1, 1), date(2024, 1, 8)


@pytest.fixture(scope="module")
def delivered(spark, event_visits, tmp_path_factory):
    """Stop records as CSV, one folder per day, in the delivered form."""
    base = tmp_path_factory.mktemp("delivered")
    visits = event_visits("0.01").where(F.col("date") <= F.lit(date(2024, 1, 10)))
    tapped = F.col("cardTimestamp_s").isNotNull()
    text = visits.withColumns(
        {
            "timestamp": time_text(F.col("timestamp_s")),
            "cardTimestamp": F.when(tapped, time_text(F.col("cardTimestamp_s"))),
        }
    ).drop("timestamp_s", "cardTimestamp_s", "visit_id")
    for day in range(1, 11):
        name = f"2024_01_{day:02d}"
        one = text.where(F.col("date") == F.lit(date(2024, 1, day))).withColumn("date", F.lit(name))
        one.coalesce(1).write.csv(str(base / name), header=True, nullValue="-")
    return str(base)


@pytest.fixture(scope="module")
def output(spark, delivered, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("out"))
    run_od_job(spark, delivered, out, START, END)
    run_legs_job(spark, f"{out}/od/crowdedness", f"{out}/legs")
    return out


def test_od_tables(spark, output, event_visits):
    visits = event_visits("0.01").where(F.col("date").between(F.lit(START), F.lit(END)))
    want = A.trips_od(visits)
    got = read_table(spark, f"{output}/od/trips_od")
    assert got.count() == want.count()
    columns = ["cardNum", "stopPointId", "o_stop_id", "o_timestamp_s", "tripNum", "timestamp_s"]
    as_text = [F.col(c).cast("string") for c in columns]
    assert set(got.select(as_text).collect()) == set(want.select(as_text).collect())
    boarded = read_table(spark, f"{output}/od/trips_origins").agg(F.sum("boarding_cnt")).first()[0]
    alighted = read_table(spark, f"{output}/od/trips_destinations").agg(F.sum("alighting_cnt")).first()[0]
    assert boarded == alighted == want.count()
    loads = read_crowdedness(spark, f"{output}/od/crowdedness")
    assert loads.count() == A.trip_stops(visits).count()
    assert {"busStopId", "num_pass", "ext_num_pass"} <= set(loads.columns)


def test_od_job_can_run_again(spark, delivered, output):
    before = read_table(spark, f"{output}/od/crowdedness").count()
    run_od_job(spark, delivered, output, START, date(2024, 1, 2))
    assert read_table(spark, f"{output}/od/crowdedness").count() == before
    assert len(read_table(spark, f"{output}/od/trips_od").select("date").distinct().collect()) == 8


def test_leg_tables(spark, output):
    kept = read_legs(spark, f"{output}/legs/train_data")
    outliers = read_legs(spark, f"{output}/legs/outliers")
    assert kept.count() > 100 and outliers.count() > 0
    assert kept.where("duration <= 0 or duration >= 1200").count() == 0
    assert outliers.where("duration < 1200").count() == 0
    stops = read_table(spark, f"{output}/legs/routes_stops").collect()
    assert len(stops) == 80 and [r.distanceTraveledShape for r in stops if r.route == "0"] == [250.0 * n for n in range(1, 41)]


def test_csv_tables_read_back_the_same(spark, delivered, tmp_path):
    out = str(tmp_path)
    run_od_job(spark, delivered, out, START, date(2024, 1, 3), fmt="csv")
    run_legs_job(spark, f"{out}/od/crowdedness", f"{out}/legs", fmt="csv")
    run_od_job(spark, delivered, f"{out}/p", START, date(2024, 1, 3))
    run_legs_job(spark, f"{out}/p/od/crowdedness", f"{out}/p/legs")
    csv = read_legs(spark, f"{out}/legs/train_data", "csv")
    parquet = read_legs(spark, f"{out}/p/legs/train_data")
    shared = sorted(set(csv.columns) & set(parquet.columns) - {"crowdedness", "speed", "pacing"})
    assert len(shared) > 25
    assert {f.name: f.dataType for f in csv.schema if f.name in shared} == {
        f.name: f.dataType for f in parquet.schema if f.name in shared
    }
    assert set(csv.select(shared).collect()) == set(parquet.select(shared).collect())


def test_training_job(spark, output, tmp_path):
    table = run_training_job(spark, f"{output}/legs/train_data", str(tmp_path), ("duration", "crowdedness", "speed"))
    rows = {r.label: r for r in table.collect()}
    assert set(rows) == {"duration", "crowdedness", "speed"} and all(r.rmse > 0 for r in rows.values())
    lines = [r.value for r in spark.read.text(f"{tmp_path}/train-info/duration").collect()]
    assert lines[0] == "Model:" and lines[2].startswith("RMSE: ")
    assert sorted(p.name for p in tmp_path.iterdir()) == [
        "crowdedness-model", "duration-model", "metrics", "pipeline", "speed-model", "train-info"
    ]


def test_training_with_other_choices(spark, output, tmp_path):
    table = run_training_job(
        spark, f"{output}/legs/train_data", str(tmp_path), ("pacing",),
        start=START, end=date(2024, 1, 6), split=features.random_split, one_hot=True,
    )
    assert [r.label for r in table.collect()] == ["pacing"]


def test_tuning_job(spark, output, tmp_path):
    searches = {
        "lasso": tuning.Search(models.lasso, {"maxIter": (10,), "regParam": (0.1, 0.01)}, 2),
        "rf": tuning.Search(models.random_forest, {"maxDepth": (2,), "maxBins": (300,), "numTrees": (3,)}, 2),
    }
    best = run_tuning_job(
        spark, f"{output}/legs/train_data", str(tmp_path), START, date(2024, 1, 6), END,
        labels=("pacing",), kinds=("lasso", "rf"), searches=searches,
    )
    assert {(r.model, r.param) for r in best.collect()} == {
        ("lasso", "maxIter"), ("lasso", "regParam"), ("rf", "maxDepth"), ("rf", "maxBins"), ("rf", "numTrees")
    }
    predictions = read_table(spark, f"{tmp_path}/predictions/pacing-rf")
    assert predictions.columns == ["duration", "crowdedness", "pacing", "speed", "prediction"]
    assert predictions.count() > 0
    assert spark.read.csv(f"{tmp_path}/cv-params/pacing-lasso", header=True).count() == 2
