from __future__ import annotations

import sys
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import SparkSession
from pyspark.sql import types as T

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from stopweave.sources.events import visits_from_events

TESTDATA = "/root/testdata"

VISIT_SCHEMA = T.StructType(
    [
        T.StructField("visit_id", T.LongType()),
        T.StructField("date", T.DateType()),
        T.StructField("route", T.StringType()),
        T.StructField("busCode", T.StringType()),
        T.StructField("tripNum", T.IntegerType()),
        T.StructField("stopPointId", T.IntegerType()),
        T.StructField("timestamp_s", T.LongType()),
        T.StructField("cardNum", T.StringType()),
        T.StructField("cardTimestamp_s", T.LongType()),
        T.StructField("shapeId", T.IntegerType()),
        T.StructField("shapeSequence", T.IntegerType()),
        T.StructField("shapeLat", T.DoubleType()),
        T.StructField("shapeLon", T.DoubleType()),
        T.StructField("distanceTraveledShape", T.DoubleType()),
        T.StructField("problem", T.StringType()),
    ]
)

DAY = date(2024, 1, 2)

# One degree of latitude in kilometres, on the sphere the distances use.
KM_PER_DEGREE = 6371.0 * 3.141592653589793 / 180


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "6g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def make_visits(spark):
    """Stop records from dicts; fields left out take plain defaults."""

    def make(*rows: dict):
        full = []
        for number, row in enumerate(rows):
            base = {
                "visit_id": number,
                "date": DAY,
                "route": "020",
                "busCode": "B1",
                "tripNum": 1,
                "stopPointId": number,
                "timestamp_s": 1000 + 60 * number,
                "cardNum": None,
                "cardTimestamp_s": None,
                "shapeId": 7,
                "shapeSequence": number,
                "shapeLat": -25.4,
                "shapeLon": -49.25,
                "distanceTraveledShape": 100.0 * number,
                "problem": "NO_PROBLEM",
            }
            unknown = set(row) - set(base)
            assert not unknown, unknown
            full.append(tuple({**base, **row}.values()))
        return spark.createDataFrame(full, VISIT_SCHEMA)

    return make


@pytest.fixture(scope="session")
def event_visits(spark):
    def load(sf: str):
        return visits_from_events(spark.read.parquet(f"{TESTDATA}/sf{sf}/events.parquet"))

    return load
