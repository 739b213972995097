from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from stopweave.functions import calendar
from stopweave.functions.clock import hour_of_day, minutes_between, seconds_of_day, time_text
from stopweave.functions.geo import EARTH_RADIUS_KM, Grid, geo_distance_km


def haversine(a, b):
    (lat_a, lon_a), (lat_b, lon_b) = np.radians(a), np.radians(b)
    chord = (
        math.sin((lat_b - lat_a) / 2) ** 2
        + math.cos(lat_a) * math.cos(lat_b) * math.sin((lon_b - lon_a) / 2) ** 2
    )
    return 2 * EARTH_RADIUS_KM * math.asin(min(1.0, math.sqrt(chord)))


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize("method", ["haversine", "cosines"])
def test_distance_of_equal_points_is_zero(spark, method):
    points = spark.range(500).select(
        (F.lit(-25.0) - F.col("id") * 0.00137).alias("lat"), (F.lit(-49.0) + F.col("id") * 0.0021).alias("lon")
    )
    here = (F.col("lat"), F.col("lon"))
    worst = points.select(F.max(geo_distance_km(*here, *here, method=method))).first()[0]
    assert worst is not None and worst < 0.001


@pytest.mark.parametrize("method", ["haversine", "cosines"])
def test_distance_matches_reference_formula(spark, method):
    pairs = [((0, 0), (0, 90)), ((-25.4, -49.2), (-25.5, -49.3)), ((89, 0), (89, 180)), ((10, 179.9), (10, -179.9))]
    for a, b in pairs:
        got = one(spark, geo_distance_km(*map(F.lit, map(float, (*a, *b))), method=method))
        assert got == pytest.approx(haversine(a, b), abs=1e-4)


def test_unknown_method_is_refused():
    with pytest.raises(ValueError):
        geo_distance_km(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(0.0), method="flat")


@pytest.mark.parametrize("reach", [0.0, 0.3, 1.0, 250.0, 9000.0, 20016.0])
def test_grid_join_finds_every_pair_within_reach_once(spark, reach):
    rng = np.random.default_rng(7)
    near = rng.normal(0, 0.02, (60, 2)) + [-25.4, -49.25]
    date_line = np.column_stack([rng.normal(5, 0.01, 20), rng.normal(0, 0.01, 20) % 360 - 180])
    date_line[:, 1] = (date_line[:, 1] + 180) % 360 - 180
    poles = np.column_stack([90 - abs(rng.normal(0, 0.01, 12)), rng.uniform(-180, 180, 12)])
    world = np.column_stack([rng.uniform(-90, 90, 20), rng.uniform(-180, 180, 20)])
    points = np.vstack([near, date_line, poles, -poles, world, [[0, 0], [0, 180], [0, -180]]])
    rows = [(i, float(lat), float(lon)) for i, (lat, lon) in enumerate(points)]
    df = spark.createDataFrame(rows, "id int, lat double, lon double").coalesce(1)
    grid = Grid.within(reach)
    lines, columns = grid.covering(F.col("lat"), F.col("lon"))
    covered = df.withColumn("r", F.explode(lines)).withColumn("c", F.explode(columns))
    row, column = grid.home(F.col("lat"), F.col("lon"))
    homed = df.select(F.col("id").alias("other"), row.alias("r"), column.alias("c"))
    met = [(x.id, x.other) for x in covered.join(homed, ["r", "c"]).select("id", "other").collect()]
    assert len(met) == len(set(met))
    met = set(met)
    for i, a in enumerate(points):
        for j, b in enumerate(points):
            if haversine(a, b) <= reach:
                assert (i, j) in met, (a, b)


def test_grid_rejects_negative_reach():
    with pytest.raises(ValueError):
        Grid.within(-1)


@pytest.mark.parametrize(
    "text, seconds",
    [
        ("06:12:33", 22353),
        ("6:12:33", 22353),
        ("25:00:00", 90000),
        ("00:00:00", 0),
        ("06:60:00", None),
        ("06:12", None),
        ("noon", None),
        ("", None),
        (None, None),
    ],
)
def test_seconds_of_day(spark, text, seconds):
    assert one(spark, seconds_of_day(F.lit(text).cast("string"))) == seconds


@pytest.mark.parametrize("text", ["00:00:00", "06:12:33", "23:59:59", "25:10:09"])
def test_time_text_undoes_seconds(spark, text):
    assert one(spark, time_text(seconds_of_day(F.lit(text)))) == text


def test_minutes_between_is_minus_one_unless_forward(spark):
    assert one(spark, minutes_between(F.lit(60), F.lit(150))) == 1.5
    assert one(spark, minutes_between(F.lit(150), F.lit(60))) == -1.0
    assert one(spark, minutes_between(F.lit(60), F.lit(60))) == -1.0


@pytest.mark.parametrize(
    "hour, rush, period",
    [
        (5, 0, "morning"),
        (6, 1, "morning"),
        (7, 1, "morning"),
        (11, 1, "morning"),
        (12, 1, "afternoon"),
        (17, 1, "afternoon"),
        (18, 1, "night"),
        (25, 0, "night"),
        (None, 0, "night"),
    ],
)
def test_rush_and_period(spark, hour, rush, period):
    column = F.lit(hour).cast("int")
    assert one(spark, calendar.is_rush(column)) == rush
    assert one(spark, calendar.period_of_day(column)) == period


def test_hour_of_day(spark):
    assert one(spark, hour_of_day(F.lit(3599))) == 0
    assert one(spark, hour_of_day(F.lit(3600))) == 1
    assert one(spark, hour_of_day(F.lit(90000))) == 25


@pytest.mark.parametrize(
    "day, name, weekend, regular, holiday",
    [
        ("2024-01-06", "Sat", 1, 0, 1),
        ("2024-01-07", "Sun", 1, 0, 1),
        ("2024-02-06", "Tue", 0, 1, 0),
        ("2024-05-09", "Thu", 0, 1, 0),
        ("2024-12-09", "Mon", 0, 0, 1),
        ("2024-07-12", "Fri", 0, 0, 1),
    ],
)
def test_calendar_flags(spark, day, name, weekend, regular, holiday):
    column = F.lit(day).cast("date")
    assert one(spark, calendar.week_day(column)) == name
    assert one(spark, calendar.is_weekend(column)) == weekend
    assert one(spark, calendar.is_regular_day(column)) == regular
    assert one(spark, calendar.is_holiday(column)) == holiday
