"""What the plans must and must not contain, whatever the size of the data."""

from __future__ import annotations

import contextlib
import io
import re

import pytest

from stopweave.operators import alighting as A
from stopweave.operators import boardings as B
from stopweave.operators import flows as L
from stopweave.operators import legs as G
from stopweave.sources.readers import read_table
from stopweave.sources.writers import write_table


def plan(df) -> str:
    return re.sub(r"#\d+L?", "", df._jdf.queryExecution().executedPlan().toString())


@pytest.fixture(scope="module")
def visits(spark, event_visits, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("visits") / "stop_visits")
    write_table(event_visits("0.001"), path)
    return read_table(spark, path)


@pytest.fixture(scope="module")
def no_broadcast(spark):
    """Plans as they are when no side is small."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def formatted(df) -> str:
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


def all_plans(visits):
    stops = A.trip_stops(visits)
    chain = B.trip_chain(B.dedup_taps(B.boardings(visits)))
    od = A.infer_alightings(chain, stops)
    return {
        "chain": chain,
        "stops": stops,
        "od": od,
        "flows": L.stop_flows(od),
        "loads": L.crowdedness(stops, L.stop_flows(od)),
        "legs": G.featured_legs(visits),
        "route_stops": G.route_stops(visits),
    }


def test_no_join_without_keys_and_no_python(visits, no_broadcast):
    for name, df in all_plans(visits).items():
        text = plan(df)
        for word in ("CartesianProduct", "NestedLoop", "EvalPython", "InPandas", "SinglePartition"):
            assert word not in text, (name, word)


def test_filters_and_columns_reach_the_scan(visits, no_broadcast):
    taps = B.dedup_taps(B.boardings(visits))
    text = formatted(taps.select("cardNum", "cardTimestamp_s", "visit_id"))
    pushed = re.search(r"PushedFilters: \[(.*?)\]", text).group(1)
    assert "IsNotNull(cardNum)" in pushed and "IsNotNull(stopPointId)" in pushed
    schema = re.search(r"ReadSchema: struct<(.*?)>", text).group(1)
    assert "problem" not in schema and "distanceTraveledShape" not in schema
    days = visits.where("date = '2024-01-02'")
    assert re.search(r"PartitionFilters: \[.*2024-01-02", formatted(A.trip_stops(days)))


def test_taps_are_shuffled_twice_for_the_chain(visits, no_broadcast):
    """Once to drop copies, already reduced map-side, and once per card and day."""
    text = plan(all_plans(visits)["chain"])
    assert text.count("Exchange hashpartitioning") == 2
    assert "Join" not in text


def test_ranking_is_cut_before_its_shuffle(visits, no_broadcast):
    text = plan(all_plans(visits)["od"])
    ranking = text[text.index("row_number()") :]
    assert re.search(r"WindowGroupLimit.*Exchange hashpartitioning\(cardNum.*WindowGroupLimit", ranking, re.S)
    assert re.search(r"SortMergeJoin \[o_date, o_route, o_bus_code, o_tripNum, _o_row, _o_column\]", text)


def test_trip_stops_are_sorted_out_once_for_the_loads(visits):
    """One scan for taps, one for trip stops, one to count stops by key alone."""
    loads = all_plans(visits)["loads"]
    loads.collect()
    final = plan(loads).split("== Initial Plan ==")[0]
    assert final.count("FileScan") == 3 and "ReusedExchange" in final
    assert final.count("partial_min_by(struct(visit_id") == 1


def test_flows_need_no_join(visits, no_broadcast):
    od = read_like(visits)
    text = plan(L.stop_flows(od))
    assert "Join" not in text and text.count("Exchange") == 1 and "partial_sum" in text


def read_like(visits):
    """A stored leg table of the right columns."""
    names = {"o_date": "date", "o_route": "route", "o_bus_code": "busCode", "o_tripNum": "tripNum", "o_stop_id": "stopPointId"}
    return visits.selectExpr("*", *(f"{v} AS {k}" for k, v in names.items()))


def test_nothing_is_broadcast_unmeasured(visits, no_broadcast):
    assert not {name for name, df in all_plans(visits).items() if "BroadcastExchange" in plan(df)}


def test_no_large_group_leaves_one_shuffle_of_the_records(visits, spark):
    legs = G.stop_to_stop(visits)
    legs.collect()
    final = plan(legs).split("== Initial Plan ==")[0]
    assert "SortMergeJoin" not in final and "Union" not in final
    assert final.count("Window [lead(") == 1 and final.count("Exchange hashpartitioning") == 1
    assert plan(G.stop_to_stop(visits)).count("FileScan") == 1
