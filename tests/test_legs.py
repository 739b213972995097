from __future__ import annotations

from datetime import date

import pytest
from conftest import DAY
from pyspark.sql import functions as F

from stopweave.operators import columns, legs


def leg(spark, **values):
    """One hop with the given ends, features included."""
    base = {
        "date": DAY,
        "timestampOrig_s": 1000,
        "timestampDest_s": 1060,
        "tripNumOrig": 1,
        "tripNumDest": 1,
        "busStopIdOrig": 1,
        "busStopIdDest": 2,
        "distanceTraveledShapeOrig": 0.0,
        "distanceTraveledShapeDest": 500.0,
        "problem": "NO_PROBLEM",
    }
    schema = (
        "date date, timestampOrig_s long, timestampDest_s long, tripNumOrig int, tripNumDest int, "
        "busStopIdOrig int, busStopIdDest int, distanceTraveledShapeOrig double, "
        "distanceTraveledShapeDest double, problem string"
    )
    row = tuple({**base, **values}.values())
    return legs.calendar_features(legs.leg_features(spark.createDataFrame([row], schema)))


def sides(df):
    kept, outliers = legs.split_outliers(df)
    return kept.count(), outliers.count()


@pytest.mark.parametrize(
    "seconds, expected", [(1, (1, 0)), (1199, (1, 0)), (1200, (0, 1)), (0, (0, 0)), (-80000, (0, 0))]
)
def test_outliers_by_duration(spark, seconds, expected):
    assert sides(leg(spark, timestampDest_s=1000 + seconds)) == expected


def test_duration_unknown_is_in_neither(spark):
    assert sides(leg(spark, timestampDest_s=None)) == (0, 0)


def test_no_time_and_no_distance_give_null_rates(spark):
    row = leg(spark, timestampDest_s=1000, distanceTraveledShapeDest=0.0).first()
    assert (row.duration, row.distance, row.speed, row.pacing) == (0.0, 0.0, None, None)


def test_features_of_a_leg(spark):
    row = leg(spark, timestampOrig_s=6 * 3600 - 30, timestampDest_s=6 * 3600 + 20).first()
    assert (row.duration, row.distance, row.speed, row.pacing) == (50.0, 500.0, 10.0, 0.1)
    assert (row.hourOrig, row.hourDest, row.isRushOrig, row.isRushDest) == (5, 6, 0, 1)
    assert (row.weekDay, row.weekOfYear, row.dayOfMonth, row.month) == ("Tue", 1, 2, 1)
    assert (row.isHoliday, row.isWeekend, row.isRegularDay) == (1, 0, 1)


def test_distance_has_no_sign(spark):
    assert leg(spark, distanceTraveledShapeOrig=700.0, distanceTraveledShapeDest=500.0).first().distance == 200.0


@pytest.mark.parametrize(
    "changed, kept",
    [
        ({}, 1),
        ({"distanceTraveledShapeOrig": 50.0, "distanceTraveledShapeDest": 0.0}, 0),
        ({"tripNumDest": 2}, 0),
        ({"busStopIdDest": 1}, 0),
        ({"distanceTraveledShapeDest": 1500.0}, 1),
        ({"distanceTraveledShapeDest": 1501.0}, 0),
        ({"problem": "BETWEEN"}, 1),
        ({"problem": "TRIP_PROBLEM"}, 0),
        ({"problem": None}, 0),
        ({"timestampDest_s": 2100}, 1),
        ({"timestampDest_s": 2101}, 0),
        ({"timestampDest_s": 1000}, 0),
    ],
)
def test_clean_legs(spark, changed, kept):
    assert legs.clean_legs(leg(spark, **changed)).count() == kept


def test_hops_follow_the_trip(make_visits):
    visits = make_visits(
        {"timestamp_s": 30},
        {"timestamp_s": 10},
        {"timestamp_s": 20, "stopPointId": None},
        {"timestamp_s": 15, "tripNum": 2},
        {"timestamp_s": 30, "visit_id": 9},
    )
    hops = legs.stop_to_stop(visits)
    got = sorted((r.busStopIdOrig, r.busStopIdDest, r.timestampDest_s) for r in hops.collect())
    assert got == [(0, 4, 30), (1, 0, 30)]


def test_loads_ride_along_as_crowdedness(make_visits):
    visits = make_visits({}, {}).withColumn("ext_num_pass", F.lit(2.5))
    assert legs.featured_legs(visits).first().crowdedness == 2.5


def test_route_stops_are_distinct_and_in_order(make_visits):
    rows = [{"stopPointId": s, "distanceTraveledShape": d} for s, d in ((3, 30.0), (1, 10.0), (3, 30.0), (2, 20.0))]
    got = legs.route_stops(make_visits(*rows, {"stopPointId": None})).collect()
    assert [r.busStopId for r in got] == [1, 2, 3]


def test_between_dates_includes_both_ends(make_visits):
    visits = make_visits(*({"date": date(2024, 1, d)} for d in range(1, 6)))
    got = columns.between_dates(visits, date(2024, 1, 2), date(2024, 1, 4))
    assert sorted(r.date.day for r in got.collect()) == [2, 3, 4]


def test_rename_skips_absent_columns(make_visits):
    renamed = columns.rename_columns(make_visits({}), [("route", "line"), ("nope", "x")])
    assert "line" in renamed.columns and "x" not in renamed.columns


def test_union_goes_by_name(spark):
    a = spark.createDataFrame([(1, "x")], "n int, t string")
    b = spark.createDataFrame([("y", 2)], "t string, n int")
    assert set(columns.union_tables([a, b]).collect()) == {(1, "x"), (2, "y")}
    with pytest.raises(ValueError):
        columns.union_tables([])
