"""Row counts and sums the stop records laid over the given tables must give."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from stopweave.operators import alighting as A
from stopweave.operators import boardings as B
from stopweave.operators import flows as L
from stopweave.operators import legs as G
from stopweave.session import stored

EXPECTED = {
    "0.001": {
        "visits": 1000,
        "tapped": 799,
        "boardings": 679,
        "stops": 978,
        "pairs": 2727,
        "od": 272,
        "km": 82.538,
        "per_boarding": 303,
        "flows": (269, 238, 471),
        "loads": (165, -22),
        "raw_legs": (880, 82, 798, 47),
        "chain_legs": (858, 59, 799, 46),
    },
    "0.01": {
        "visits": 10000,
        "tapped": 7986,
        "boardings": 6653,
        "stops": 4579,
        "pairs": 125442,
        "od": 3311,
        "km": 565.880,
        "per_boarding": 3891,
        "flows": (2356, 2268, 3674),
        "loads": (3913, 1794),
        "raw_legs": (9880, 9343, 537, 3370),
        "chain_legs": (4459, 2751, 1708, 2017),
    },
}

WHOLE_EARTH_KM = 20016.0


def leg_counts(visits):
    featured = stored(G.featured_legs(visits))
    kept, outliers = G.split_outliers(featured)
    return featured.count(), kept.count(), outliers.count(), G.clean_legs(featured).count()


@pytest.mark.parametrize("sf", EXPECTED)
def test_counts(event_visits, sf):
    want, visits = EXPECTED[sf], event_visits(sf)
    taps = B.dedup_taps(B.boardings(visits))
    chain, stops = stored(B.trip_chain(taps)), stored(A.trip_stops(visits))
    od = stored(A.infer_alightings(chain, stops))
    loads = stored(L.crowdedness(stops, L.stop_flows(od)))
    known = loads.where("num_pass is not null")
    got = {
        "visits": visits.count(),
        "tapped": B.boardings(visits).count(),
        "boardings": chain.count(),
        "stops": stops.count(),
        "pairs": A.alighting_candidates(chain, stops, WHOLE_EARTH_KM).count(),
        "od": od.count(),
        "km": od.agg(F.round(F.sum("dist"), 3)).first()[0],
        "per_boarding": A.infer_alightings(chain, stops, per="boarding").count(),
        "flows": (L.trip_origins(od).count(), L.trip_destinations(od).count(), L.stop_flows(od).count()),
        "loads": (known.count(), known.agg(F.sum("num_pass")).first()[0]),
        "raw_legs": leg_counts(visits),
        "chain_legs": leg_counts(loads),
    }
    assert got == want
