"""Hand-made cases of boardings, alightings and flows."""

from __future__ import annotations

from datetime import date, timedelta

import pytest
from conftest import DAY, KM_PER_DEGREE
from pyspark.sql import functions as F

from stopweave.operators import alighting as A
from stopweave.operators import boardings as B
from stopweave.operators import flows as L


def tap(card, second, **other):
    return {"cardNum": card, "cardTimestamp_s": second, "timestamp_s": second, **other}


def chain_of(visits):
    return B.trip_chain(B.dedup_taps(B.boardings(visits)))


def test_visits_without_a_key_are_dropped(make_visits):
    visits = make_visits(
        {}, {"stopPointId": None}, {"route": None}, {"shapeLat": float("nan")}, {"timestamp_s": None}
    )
    assert [r.visit_id for r in B.clean_visits(visits).collect()] == [0]


def test_boardings_need_card_and_time(make_visits):
    visits = make_visits(tap("a", 10), {"cardNum": "b"}, {"cardTimestamp_s": 5}, {})
    assert [r.cardNum for r in B.boardings(visits).collect()] == ["a"]


def test_copy_of_a_tap_is_dropped_keeping_the_least_id(make_visits):
    visits = make_visits(
        tap("a", 10, visit_id=9), tap("a", 10, visit_id=4), tap("a", 10, visit_id=7), tap("a", 11, visit_id=8)
    )
    kept = B.dedup_taps(B.boardings(visits))
    assert sorted(r.visit_id for r in kept.collect()) == [4, 8]


def test_single_tap_of_a_day_is_left_out(make_visits):
    other = DAY + timedelta(days=1)
    visits = make_visits(tap("once", 10), tap("twice", 10), tap("twice", 20), tap("days", 10), tap("days", 10, date=other))
    taps = B.dedup_taps(B.boardings(visits))
    assert {r.cardNum for r in B.repeat_boardings(taps).collect()} == {"twice"}
    assert {r.cardNum for r in B.trip_chain(taps).collect()} == {"twice"}
    assert [tuple(r) for r in B.taps_per_card(taps).collect()] == [("twice", DAY, 2)]


def test_last_boarding_is_followed_by_the_first(make_visits):
    legs = chain_of(make_visits(tap("a", 600), tap("a", 1200), tap("a", 300)))
    got = {r.o_timestamp_s: (r.next_o_timestamp_s, r.leg_duration) for r in legs.collect()}
    assert got == {300: (600, 5.0), 600: (1200, 10.0), 1200: (300, -1.0)}


def test_circular_lead_of_a_single_row_is_itself(make_visits):
    taps = make_visits(tap("a", 600))
    row = B.circular_lead(taps, ["cardNum"], ["cardTimestamp_s"], {"visit_id": "next_id"}).first()
    assert row.next_id == row.visit_id


def ride(make_visits, stop_lat, next_lat, seconds=(1000, 1060)):
    """A rider boards trip 1; a later stop of it lies at ``stop_lat``, and the
    next boarding of the card, on trip 2, at ``next_lat``."""
    return make_visits(
        tap("a", seconds[0], stopPointId=1, shapeLat=0.0),
        {"stopPointId": 2, "timestamp_s": seconds[1], "shapeLat": stop_lat},
        tap("a", 9000, tripNum=2, stopPointId=3, shapeLat=next_lat),
    )


def test_alighting_at_the_very_next_boarding_stop(make_visits):
    od = A.trips_od(ride(make_visits, 0.05, 0.05)).collect()
    first = [r for r in od if r.o_timestamp_s == 1000]
    assert [(r.stopPointId, r.dist) for r in first] == [(2, 0.0)]


@pytest.mark.parametrize("km, found", [(0.9, 1), (0.999999, 1), (1.2, 0)])
def test_stop_further_than_the_walk_is_rejected(make_visits, km, found):
    od = A.trips_od(ride(make_visits, 0.05, 0.05 + km / KM_PER_DEGREE))
    assert od.where("o_timestamp_s = 1000").count() == found


def test_alighting_must_be_later_than_the_tap(make_visits):
    assert A.trips_od(ride(make_visits, 0.05, 0.05, (1000, 1000))).where("o_timestamp_s = 1000").count() == 0
    assert A.trips_od(ride(make_visits, 0.05, 0.05, (1000, 900))).where("o_timestamp_s = 1000").count() == 0


def test_first_pass_of_a_stop_counts(make_visits):
    visits = make_visits(
        {"stopPointId": 1, "timestamp_s": 50, "visit_id": 3},
        {"stopPointId": 1, "timestamp_s": 20, "visit_id": 2},
        {"stopPointId": 1, "timestamp_s": 20, "visit_id": 1},
        {"stopPointId": 1, "timestamp_s": 20, "visit_id": 0, "date": date(2024, 1, 9)},
    )
    got = {(r.date, r.visit_id) for r in A.trip_stops(visits).collect()}
    assert got == {(DAY, 1), (date(2024, 1, 9), 0)}


def two_taps_on_one_trip(make_visits):
    return make_visits(
        tap("a", 100, stopPointId=1, shapeLat=0.0),
        tap("a", 200, stopPointId=2, shapeLat=0.02),
        {"stopPointId": 3, "timestamp_s": 300, "shapeLat": 0.03},
        tap("a", 900, tripNum=2, stopPointId=4, shapeLat=0.03),
    )


def test_one_leg_per_trip_or_per_boarding(make_visits):
    visits = two_taps_on_one_trip(make_visits)
    assert A.trips_od(visits).where("tripNum = 1").count() == 1
    per_boarding = A.trips_od(visits, per="boarding").where("tripNum = 1")
    assert {r.o_timestamp_s: r.stopPointId for r in per_boarding.collect()} == {100: 2, 200: 3}
    with pytest.raises(ValueError):
        A.trips_od(visits, per="day")


def test_candidates_without_the_grid(spark, event_visits):
    """The grid join gives exactly the pairs a plain join on the trip gives."""
    visits = event_visits("0.001")
    legs, stops = chain_of(visits), A.trip_stops(visits)
    for reach in (0.2, 1.0, 3.0):
        plain = legs.join(
            stops,
            (stops.date == legs.o_date)
            & (stops.route == legs.o_route)
            & (stops.tripNum == legs.o_tripNum)
            & (stops.timestamp_s > legs.o_timestamp_s),
        ).withColumn("d", A.geo_distance_km(F.col("shapeLat"), F.col("shapeLon"), F.col("next_o_shape_lat"), F.col("next_o_shape_lon")))
        want = sorted(tuple(r) for r in plain.where(F.col("d") <= reach).select("o_boarding_id", "visit_id").collect())
        got = A.alighting_candidates(legs, stops, reach).select("o_boarding_id", "id")
        assert sorted(tuple(r) for r in got.collect()) == want


def flow_table(spark, *rows):
    return spark.createDataFrame(
        [(DAY, "020", "B1", 1, *r) for r in rows],
        "date date, route string, busCode string, tripNum int, stopPointId int, boarding_cnt long, alighting_cnt long",
    )


def test_balance_is_null_where_one_side_is_missing(spark, make_visits):
    stops = A.trip_stops(make_visits({}, {}, {}, {}))
    flows = flow_table(spark, (0, 5, None), (1, 4, 1), (2, None, 2))
    loads = L.running_load(L.stop_balance(stops, flows))
    got = {r.stopPointId: (r.crowd_bal, r.num_pass) for r in loads.collect()}
    assert got == {0: (None, None), 1: (3, 3), 2: (None, 3), 3: (None, 3)}
    zero = L.running_load(L.stop_balance(stops, flows, missing_as_zero=True))
    got = {r.stopPointId: (r.crowd_bal, r.num_pass) for r in zero.collect()}
    assert got == {0: (5, 5), 1: (3, 8), 2: (-2, 6), 3: (0, 6)}


def test_stops_in_the_same_second_share_the_load(spark, make_visits):
    stops = A.trip_stops(make_visits({"timestamp_s": 10}, {"timestamp_s": 10}, {"timestamp_s": 20}))
    flows = flow_table(spark, (0, 5, 1), (1, 4, 1), (2, 1, 2))
    loads = L.running_load(L.stop_balance(stops, flows))
    assert {r.stopPointId: r.num_pass for r in loads.collect()} == {0: 7, 1: 7, 2: 6}


def test_factor_is_zero_without_legs(spark, make_visits):
    stops = A.trip_stops(make_visits({}, {}, {"route": "030"}))
    flows = flow_table(spark, (0, 5, 4), (1, 4, None))
    got = {r.route: (r.trip_stop_cnt, r.odmatrix_boarding, r.extrap_factor) for r in L.route_factors(stops, flows).collect()}
    assert got == {"020": (2, 4, 0.5), "030": (1, None, 0.0)}
    taps = make_visits({}, {}, {}, {})
    by_taps = L.route_factors(stops, flows, taps)
    assert {r.route: r.extrap_factor for r in by_taps.collect()} == {"020": 1.0}


def test_flows_are_origins_joined_with_destinations(event_visits):
    od = A.trips_od(event_visits("0.001"))
    joined = L.trip_origins(od).join(L.trip_destinations(od), list(L.TRIP_STOP), "full_outer")
    assert set(L.stop_flows(od).select(joined.columns).collect()) == set(joined.collect())


def test_properties_of_inferred_legs(event_visits):
    od = A.trips_od(event_visits("0.001")).cache()
    assert od.where("timestamp_s <= o_timestamp_s or dist > 1.0 or dist is null").count() == 0
    keys = ["cardNum", "date", "route", "busCode", "tripNum"]
    assert od.groupBy(*keys).count().where("count > 1").count() == 0
    flows = L.stop_flows(od).agg(F.sum("boarding_cnt"), F.sum("alighting_cnt")).first()
    assert tuple(flows) == (od.count(), od.count())
    od.unpersist()


@pytest.mark.parametrize("partitions", [1, 7, 200])
def test_results_do_not_depend_on_the_partitioning(event_visits, partitions):
    visits = event_visits("0.001")
    spread = visits.repartition(partitions, F.rand(partitions))
    def load(v):
        stops = A.trip_stops(v)
        od = A.infer_alightings(chain_of(v), stops)
        return set(L.crowdedness(stops, L.stop_flows(od)).collect())
    assert load(visits) == load(spread)


def test_days_together_equal_days_one_by_one(event_visits):
    visits = event_visits("0.001").where("date <= '2024-01-03'")
    def load(v):
        stops = A.trip_stops(v)
        return set(L.crowdedness(stops, L.stop_flows(A.infer_alightings(chain_of(v), stops))).collect())
    single = [load(visits.where(F.col("date") == f"2024-01-0{d}")) for d in (1, 2, 3)]
    assert set().union(*single) == load(visits)
