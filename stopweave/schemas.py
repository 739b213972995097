"""Column types and keys of the tables the jobs exchange."""

from __future__ import annotations

from pyspark.sql import types as T

TRIP = ("date", "route", "busCode", "tripNum")
TRIP_STOP = (*TRIP, "stopPointId")
SHAPE_TRIP = ("date", "route", "shapeId", "busCode", "tripNum")

#: A visit without one of these cannot be placed on a trip.
VISIT_REQUIRED = (*TRIP_STOP, "timestamp_s", "shapeLon", "shapeLat")


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


#: Stop records with inline taps, as delivered: one CSV folder per day.
STOP_VISITS_CSV = _struct(
    route=T.StringType(),
    busCode=T.StringType(),
    tripNum=T.IntegerType(),
    stopPointId=T.IntegerType(),
    timestamp=T.StringType(),
    date=T.StringType(),
    shapeId=T.IntegerType(),
    shapeSequence=T.IntegerType(),
    shapeLat=T.DoubleType(),
    shapeLon=T.DoubleType(),
    distanceTraveledShape=T.DoubleType(),
    cardNum=T.StringType(),
    cardTimestamp=T.StringType(),
    problem=T.StringType(),
    gpsPointId=T.StringType(),
    gpsLat=T.DoubleType(),
    gpsLon=T.DoubleType(),
    distanceToShapePoint=T.DoubleType(),
)

#: Trip stops with their estimated load.
CROWDEDNESS = _struct(
    visit_id=T.LongType(),
    date=T.DateType(),
    route=T.StringType(),
    busCode=T.StringType(),
    tripNum=T.IntegerType(),
    stopPointId=T.IntegerType(),
    timestamp_s=T.LongType(),
    shapeId=T.IntegerType(),
    shapeSequence=T.IntegerType(),
    shapeLat=T.DoubleType(),
    shapeLon=T.DoubleType(),
    distanceTraveledShape=T.DoubleType(),
    problem=T.StringType(),
    gpsPointId=T.StringType(),
    gpsLat=T.DoubleType(),
    gpsLon=T.DoubleType(),
    distanceToShapePoint=T.DoubleType(),
    boarding_cnt=T.LongType(),
    alighting_cnt=T.LongType(),
    crowd_bal=T.LongType(),
    num_pass=T.LongType(),
    extrap_factor=T.DoubleType(),
    ext_num_pass=T.DoubleType(),
)

#: Stop-to-stop legs with their features; the training table.
LEGS = _struct(
    visit_id=T.LongType(),
    date=T.DateType(),
    route=T.StringType(),
    shapeId=T.IntegerType(),
    shapeSequence=T.IntegerType(),
    busCode=T.StringType(),
    problem=T.StringType(),
    gpsPointId=T.StringType(),
    gpsLat=T.DoubleType(),
    gpsLon=T.DoubleType(),
    distanceToShapePoint=T.DoubleType(),
    boarding_cnt=T.LongType(),
    alighting_cnt=T.LongType(),
    crowd_bal=T.LongType(),
    num_pass=T.LongType(),
    extrap_factor=T.DoubleType(),
    busStopIdOrig=T.IntegerType(),
    timestampOrig_s=T.LongType(),
    tripNumOrig=T.IntegerType(),
    shapeLatOrig=T.DoubleType(),
    shapeLonOrig=T.DoubleType(),
    distanceTraveledShapeOrig=T.DoubleType(),
    busStopIdDest=T.IntegerType(),
    timestampDest_s=T.LongType(),
    tripNumDest=T.IntegerType(),
    shapeLatDest=T.DoubleType(),
    shapeLonDest=T.DoubleType(),
    distanceTraveledShapeDest=T.DoubleType(),
    duration=T.DoubleType(),
    crowdedness=T.DoubleType(),
    distance=T.DoubleType(),
    speed=T.DoubleType(),
    pacing=T.DoubleType(),
    hourOrig=T.IntegerType(),
    hourDest=T.IntegerType(),
    isRushOrig=T.IntegerType(),
    isRushDest=T.IntegerType(),
    periodOrig=T.StringType(),
    periodDest=T.StringType(),
    weekDay=T.StringType(),
    weekOfYear=T.IntegerType(),
    dayOfMonth=T.IntegerType(),
    month=T.IntegerType(),
    isHoliday=T.IntegerType(),
    isWeekend=T.IntegerType(),
    isRegularDay=T.IntegerType(),
)
