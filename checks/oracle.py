"""The registered queries written again as plain SQL.

Each statement is a chain of named subqueries over the driver's tables. It is
written from the meaning of the query, not from the Spark code: joins where the
operators use one pass, and no grid, chunk or partial step.
"""

from __future__ import annotations

import re

SUBQUERIES = {
    "stop_visits": """
SELECT event_id AS visit_id,
       CAST(ts AS date) AS date,
       CAST(event_id % 2 AS int) AS route,
       'B1' AS busCode,
       CAST(floor(sod / 43200) AS int) AS tripNum,
       CAST(floor(sod_half / 1080) AS int) + 1 AS stopPointId,
       sod AS timestamp_s,
       CASE WHEN event_type <> 'error' THEN user_id END AS cardNum,
       CASE WHEN event_type <> 'error' THEN sod END AS cardTimestamp_s,
       CAST(event_id % 2 AS int) + 100 AS shapeId,
       (CAST(floor(sod_half / 1080) AS int) + 1) * 10 AS shapeSequence,
       CAST(-25.40 AS double) - (floor(sod_half / 1080) + 1) * CAST(0.004 AS double) AS shapeLat,
       CAST(-49.25 AS double) + (floor(sod_half / 1080) + 1) * CAST(0.001 AS double)
         + (event_id % 2) * CAST(0.003 AS double) AS shapeLon,
       (floor(sod_half / 1080) + 1) * CAST(250 AS double) AS distanceTraveledShape,
       CASE WHEN event_id % 10 = 0 THEN 'TRIP_PROBLEM'
            WHEN event_id % 10 = 1 THEN 'BETWEEN'
            ELSE 'NO_PROBLEM' END AS problem
FROM (SELECT *, sod % 43200 AS sod_half
      FROM (SELECT *, CAST(extract(hour FROM ts) * 3600 + extract(minute FROM ts) * 60
                           + floor(extract(second FROM ts)) AS bigint) AS sod
            FROM events) a) b""",
    "clean": """
SELECT * FROM stop_visits
WHERE date IS NOT NULL AND route IS NOT NULL AND busCode IS NOT NULL AND tripNum IS NOT NULL
  AND stopPointId IS NOT NULL AND timestamp_s IS NOT NULL
  AND shapeLat IS NOT NULL AND shapeLon IS NOT NULL""",
    "tapped": """
SELECT * FROM clean WHERE cardNum IS NOT NULL AND cardTimestamp_s IS NOT NULL""",
    "taps": """
SELECT t.* FROM tapped t
JOIN (SELECT cardNum, date, cardTimestamp_s, min(visit_id) AS visit_id
      FROM tapped GROUP BY cardNum, date, cardTimestamp_s) k
  ON t.visit_id = k.visit_id""",
    "repeat_cards": """
SELECT cardNum, date, count(*) AS tap_cnt FROM taps GROUP BY cardNum, date HAVING count(*) > 1""",
    "repeats": """
SELECT t.* FROM taps t JOIN repeat_cards r ON t.cardNum = r.cardNum AND t.date = r.date""",
    "numbered": """
SELECT *, row_number() OVER (PARTITION BY cardNum, date ORDER BY cardTimestamp_s) AS nth,
       count(*) OVER (PARTITION BY cardNum, date) AS taps
FROM repeats""",
    "chain": """
SELECT o.cardNum, o.route AS o_route, o.busCode AS o_bus_code, o.date AS o_date,
       o.tripNum AS o_tripNum, o.cardTimestamp_s AS o_timestamp_s, o.shapeId AS o_shape_id,
       o.shapeSequence AS o_shape_seq, o.shapeLat AS o_shape_lat, o.shapeLon AS o_shape_lon,
       o.stopPointId AS o_stop_id, o.visit_id AS o_boarding_id,
       n.route AS next_o_route, n.tripNum AS next_o_tripNum,
       n.cardTimestamp_s AS next_o_timestamp_s, n.shapeLat AS next_o_shape_lat,
       n.shapeLon AS next_o_shape_lon, n.stopPointId AS next_o_stop_id,
       n.visit_id AS next_o_boarding_id,
       CASE WHEN n.cardTimestamp_s > o.cardTimestamp_s
            THEN CAST(n.cardTimestamp_s - o.cardTimestamp_s AS double) / 60.0
            ELSE CAST(-1.0 AS double) END AS leg_duration
FROM numbered o JOIN numbered n
  ON o.cardNum = n.cardNum AND o.date = n.date AND n.nth = o.nth % o.taps + 1""",
    "stops": """
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY date, route, busCode, tripNum, stopPointId
                                            ORDER BY timestamp_s, visit_id) AS pass FROM clean) p
WHERE pass = 1""",
    "pairs": """
SELECT c.*, s.visit_id AS id, s.date, s.route, s.busCode, s.tripNum, s.stopPointId, s.timestamp_s,
       2 * 6371.0 * asin(least(1.0, sqrt(
           power(sin(radians(c.next_o_shape_lat - s.shapeLat) / 2), 2)
           + cos(radians(s.shapeLat)) * cos(radians(c.next_o_shape_lat))
             * power(sin(radians(c.next_o_shape_lon - s.shapeLon) / 2), 2)))) AS dist
FROM chain c JOIN stops s
  ON c.o_date = s.date AND c.o_route = s.route AND c.o_bus_code = s.busCode
 AND c.o_tripNum = s.tripNum AND s.timestamp_s > c.o_timestamp_s""",
    "near": """
SELECT * FROM pairs WHERE dist <= 1.0""",
    "od": """
SELECT * FROM (SELECT *, row_number() OVER (
                 PARTITION BY cardNum, date, route, busCode, tripNum
                 ORDER BY round(dist, 6), timestamp_s, stopPointId, o_timestamp_s) AS rn
               FROM near) r
WHERE rn = 1""",
    "od_boarding": """
SELECT * FROM (SELECT *, row_number() OVER (
                 PARTITION BY cardNum, date, route, busCode, tripNum, o_timestamp_s
                 ORDER BY round(dist, 6), timestamp_s, stopPointId) AS rn
               FROM near) r
WHERE rn = 1""",
    "origins": """
SELECT o_date AS date, o_route AS route, o_bus_code AS busCode, o_tripNum AS tripNum,
       o_stop_id AS stopPointId, count(*) AS boarding_cnt
FROM od GROUP BY o_date, o_route, o_bus_code, o_tripNum, o_stop_id""",
    "destinations": """
SELECT date, route, busCode, tripNum, stopPointId, count(*) AS alighting_cnt
FROM od GROUP BY date, route, busCode, tripNum, stopPointId""",
    "flows": """
SELECT date, route, busCode, tripNum, stopPointId, boarding_cnt, alighting_cnt
FROM origins FULL OUTER JOIN destinations USING (date, route, busCode, tripNum, stopPointId)""",
    "factors": """
SELECT s.date, s.route, s.trip_stop_cnt, o.odmatrix_boarding,
       CASE WHEN o.odmatrix_boarding IS NULL OR o.odmatrix_boarding = 0 THEN CAST(0.0 AS double)
            ELSE CAST(s.trip_stop_cnt AS double) / o.odmatrix_boarding END AS extrap_factor
FROM (SELECT date, route, count(*) AS trip_stop_cnt FROM stops GROUP BY date, route) s
LEFT JOIN (SELECT date, route, count(*) AS odmatrix_boarding FROM od GROUP BY date, route) o
  ON s.date = o.date AND s.route = o.route""",
    "balance": """
SELECT s.*, f.boarding_cnt, f.alighting_cnt, f.boarding_cnt - f.alighting_cnt AS crowd_bal
FROM stops s LEFT JOIN flows f
  ON s.date = f.date AND s.route = f.route AND s.busCode = f.busCode
 AND s.tripNum = f.tripNum AND s.stopPointId = f.stopPointId""",
    "loads": """
SELECT *, CAST(sum(crowd_bal) OVER (PARTITION BY date, route, busCode, tripNum
                                    ORDER BY timestamp_s) AS bigint) AS num_pass
FROM balance""",
    "crowdedness": """
SELECT l.*, f.extrap_factor, l.num_pass * f.extrap_factor AS ext_num_pass
FROM loads l LEFT JOIN factors f ON l.date = f.date AND l.route = f.route""",
}

_HOPS = """
SELECT * FROM (
  SELECT visit_id, date, route, shapeId, busCode, problem, {load} AS crowdedness,
         stopPointId AS busStopIdOrig, timestamp_s AS timestampOrig_s, tripNum AS tripNumOrig,
         shapeLat AS shapeLatOrig, shapeLon AS shapeLonOrig,
         distanceTraveledShape AS distanceTraveledShapeOrig,
         lead(stopPointId) OVER (w) AS busStopIdDest,
         lead(timestamp_s) OVER (w) AS timestampDest_s,
         lead(tripNum) OVER (w) AS tripNumDest,
         lead(shapeLat) OVER (w) AS shapeLatDest,
         lead(shapeLon) OVER (w) AS shapeLonDest,
         lead(distanceTraveledShape) OVER (w) AS distanceTraveledShapeDest
  FROM {source} WHERE stopPointId IS NOT NULL
  WINDOW w AS (PARTITION BY date, route, shapeId, busCode, tripNum ORDER BY timestamp_s, visit_id)) h
WHERE busStopIdDest IS NOT NULL"""

_TIMED = """
SELECT *, CAST(timestampDest_s - timestampOrig_s AS double) AS duration,
       abs(distanceTraveledShapeDest - distanceTraveledShapeOrig) AS distance,
       CAST(floor(timestampOrig_s / 3600) AS int) AS hourOrig,
       CAST(floor(timestampDest_s / 3600) AS int) AS hourDest,
       strftime(date, '%a') AS weekDay,
       CAST(extract(week FROM date) AS int) AS weekOfYear,
       CAST(extract(day FROM date) AS int) AS dayOfMonth,
       CAST(extract(month FROM date) AS int) AS month
FROM {hops}"""

_LEGS = """
SELECT *, distance / nullif(duration, 0) AS speed, duration / nullif(distance, 0) AS pacing,
       CASE WHEN hourOrig IN (6, 7, 11, 12, 17, 18) THEN 1 ELSE 0 END AS isRushOrig,
       CASE WHEN hourDest IN (6, 7, 11, 12, 17, 18) THEN 1 ELSE 0 END AS isRushDest,
       CASE WHEN hourOrig < 12 THEN 'morning' WHEN hourOrig < 18 THEN 'afternoon'
            ELSE 'night' END AS periodOrig,
       CASE WHEN hourDest < 12 THEN 'morning' WHEN hourDest < 18 THEN 'afternoon'
            ELSE 'night' END AS periodDest,
       CASE WHEN month IN (1, 6, 7, 12) THEN 1 ELSE 0 END AS isHoliday,
       CASE WHEN weekDay IN ('Sat', 'Sun') THEN 1 ELSE 0 END AS isWeekend,
       CASE WHEN weekDay IN ('Tue', 'Wed', 'Thu') THEN 1 ELSE 0 END AS isRegularDay
FROM {timed}"""

SUBQUERIES |= {
    # Legs between all stop records.
    "hops": _HOPS.format(load="CAST(NULL AS double)", source="stop_visits"),
    "timed": _TIMED.format(hops="hops"),
    "legs": _LEGS.format(timed="timed"),
    "kept": "SELECT * FROM legs WHERE duration > 0 AND duration < 1200",
    # Legs between first visits, with the load; the input of the models.
    "load_hops": _HOPS.format(load="ext_num_pass", source="crowdedness"),
    "load_timed": _TIMED.format(hops="load_hops"),
    "load_legs": _LEGS.format(timed="load_timed"),
    "load_kept": "SELECT * FROM load_legs WHERE duration > 0 AND duration < 1200",
    "shared": """
SELECT *, CAST(('0x' || substr(md5('24|' || CAST(visit_id AS varchar)), 1, 8)) AS bigint)
          / 4294967296.0 < 0.7 AS in_train
FROM kept""",
    "extremes": """
SELECT min(shapeLatOrig) AS lat_o_min, max(shapeLatOrig) AS lat_o_max,
       min(shapeLonOrig) AS lon_o_min, max(shapeLonOrig) AS lon_o_max,
       min(shapeLatDest) AS lat_d_min, max(shapeLatDest) AS lat_d_max,
       min(shapeLonDest) AS lon_d_min, max(shapeLonDest) AS lon_d_max
FROM {rows}""",
}

# The subqueries in an order in which each one comes after those it reads.
_ORDER = (
    "stop_visits", "clean", "tapped", "taps", "repeat_cards", "repeats", "numbered", "chain",
    "stops", "pairs", "near", "od", "od_boarding", "origins", "destinations", "flows", "factors",
    "balance", "loads", "crowdedness", "hops", "timed", "legs", "kept", "load_hops", "load_timed",
    "load_legs", "load_kept", "shared",
)


def _uses(text: str, name: str) -> bool:
    return re.search(rf"\b(FROM|JOIN)\s+{name}\b", text) is not None


def _with(select: str, **extra: str) -> str:
    """``select`` with the subqueries it reads, directly or not, in front."""
    wanted: dict[str, str] = {}
    pending = [select, *extra.values()]
    while pending:
        text = pending.pop()
        for name in _ORDER:
            if name not in wanted and _uses(text, name):
                wanted[name] = SUBQUERIES[name]
                pending.append(SUBQUERIES[name])
    ordered = [(name, wanted[name]) for name in _ORDER if name in wanted]
    parts = [f"{name} AS ({body}\n)" for name, body in (*ordered, *extra.items())]
    return f"WITH {', '.join(parts)}\n{select.strip()}"


def _scaled(column: str, low: str, high: str) -> str:
    return (
        f"round(CASE WHEN {high} = {low} THEN CAST(0.5 AS double) "
        f"ELSE ({column} - {low}) / ({high} - {low}) END, 6)"
    )


_SCALED = {
    "lat_orig": _scaled("shapeLatOrig", "lat_o_min", "lat_o_max"),
    "lon_orig": _scaled("shapeLonOrig", "lon_o_min", "lon_o_max"),
    "lat_dest": _scaled("shapeLatDest", "lat_d_min", "lat_d_max"),
    "lon_dest": _scaled("shapeLonDest", "lon_d_min", "lon_d_max"),
}

_INDEX = """
SELECT {column} AS value, count(*) AS cnt,
       CAST(row_number() OVER (ORDER BY count(*) DESC, {column}) - 1 AS double) AS idx
FROM {rows} GROUP BY {column}"""

_COMPLETE = """periodOrig IS NOT NULL AND weekDay IS NOT NULL AND route IS NOT NULL
  AND shapeLatOrig IS NOT NULL AND shapeLonOrig IS NOT NULL AND busStopIdOrig IS NOT NULL
  AND busStopIdDest IS NOT NULL AND shapeLatDest IS NOT NULL AND shapeLonDest IS NOT NULL
  AND hourOrig IS NOT NULL AND isRushOrig IS NOT NULL AND weekOfYear IS NOT NULL
  AND dayOfMonth IS NOT NULL AND month IS NOT NULL AND isHoliday IS NOT NULL
  AND isWeekend IS NOT NULL AND isRegularDay IS NOT NULL AND distance IS NOT NULL
  AND crowdedness IS NOT NULL AND pacing IS NOT NULL AND speed IS NOT NULL"""

_LEG_KEY = "visit_id, date, route, busStopIdOrig, busStopIdDest"

_SUMMARY = """
SELECT '{c}' AS label, count({c}) AS "count", round(avg({c}), 6) AS mean,
       round(stddev_samp({c}), 6) AS stddev, round(min({c}), 6) AS "min",
       round(max({c}), 6) AS "max"
FROM load_kept"""


def statements() -> dict[str, str]:
    trip_stop = "date, route, busCode, tripNum, stopPointId"
    od_columns = (
        "cardNum, date, route, busCode, tripNum, stopPointId, timestamp_s, id, o_boarding_id, "
        "o_stop_id, o_timestamp_s, next_o_boarding_id, next_o_stop_id, "
        "round(leg_duration, 6) AS leg_duration, round(dist, 6) AS dist"
    )
    train_rows = "(SELECT * FROM shared WHERE in_train) t"
    dated_rows = "(SELECT * FROM kept WHERE date BETWEEN DATE '2024-01-01' AND DATE '2024-01-20') t"
    return {
        "scan_stop_visits": _with("""
SELECT visit_id, date, route, busCode, tripNum, stopPointId, timestamp_s, cardNum,
       cardTimestamp_s, shapeId, shapeSequence, round(shapeLat, 6) AS shapeLat,
       round(shapeLon, 6) AS shapeLon, distanceTraveledShape, problem
FROM stop_visits"""),
        "date_range_scan": _with("""
SELECT visit_id, date, route, timestamp_s FROM stop_visits
WHERE date >= DATE '2024-01-08' AND date <= DATE '2024-01-21'"""),
        "union_days": _with("""
SELECT visit_id, date, stopPointId FROM stop_visits WHERE date < DATE '2024-01-16'
UNION ALL
SELECT visit_id, date, stopPointId FROM stop_visits WHERE NOT date < DATE '2024-01-16'"""),
        "rename_columns": _with("""
SELECT visit_id, stopPointId AS busStopId, cardNum AS card FROM stop_visits"""),
        "clean_visits": _with(f"SELECT visit_id, {trip_stop}, timestamp_s FROM clean"),
        "boardings": _with("SELECT visit_id, cardNum, date, cardTimestamp_s FROM tapped"),
        "dedup_taps": _with("SELECT visit_id, cardNum, date, cardTimestamp_s FROM taps"),
        "taps_per_card": _with("SELECT cardNum, date, tap_cnt FROM repeat_cards"),
        "repeat_boardings": _with("SELECT visit_id, cardNum, date, cardTimestamp_s FROM repeats"),
        "circular_lead": _with("""
SELECT visit_id, cardNum, date, cardTimestamp_s,
       coalesce(lead(visit_id) OVER (w), first_value(visit_id) OVER (w)) AS next_visit_id
FROM taps WINDOW w AS (PARTITION BY cardNum, date ORDER BY cardTimestamp_s)"""),
        "trip_chain": _with("""
SELECT cardNum, o_date, o_route, o_bus_code, o_tripNum, o_timestamp_s, o_shape_id, o_shape_seq,
       round(o_shape_lat, 6) AS o_shape_lat, round(o_shape_lon, 6) AS o_shape_lon, o_stop_id,
       o_boarding_id, next_o_route, next_o_tripNum, next_o_timestamp_s, next_o_stop_id,
       next_o_boarding_id
FROM chain"""),
        "leg_duration": _with("""
SELECT cardNum, o_date, o_timestamp_s, round(leg_duration, 6) AS leg_duration FROM chain"""),
        "trip_stops": _with(f"SELECT {trip_stop}, timestamp_s, visit_id, shapeId FROM stops"),
        "alighting_candidates": _with("""
SELECT cardNum, o_boarding_id, id, stopPointId, timestamp_s, round(dist, 6) AS dist FROM near"""),
        "infer_alightings": _with(f"SELECT {od_columns} FROM od"),
        "infer_alightings_per_boarding": _with(f"SELECT {od_columns} FROM od_boarding"),
        "trip_origins": _with("SELECT * FROM origins"),
        "trip_destinations": _with("SELECT * FROM destinations"),
        "stop_flows": _with("SELECT * FROM flows"),
        "route_factors": _with("""
SELECT date, route, trip_stop_cnt, odmatrix_boarding, round(extrap_factor, 6) AS extrap_factor
FROM factors"""),
        "stop_balance": _with(
            f"SELECT {trip_stop}, boarding_cnt, alighting_cnt, crowd_bal FROM balance"
        ),
        "running_load": _with(f"SELECT {trip_stop}, timestamp_s, crowd_bal, num_pass FROM loads"),
        "crowdedness": _with(f"""
SELECT {trip_stop}, timestamp_s, boarding_cnt, alighting_cnt, crowd_bal, num_pass,
       round(extrap_factor, 6) AS extrap_factor, round(ext_num_pass, 6) AS ext_num_pass
FROM crowdedness"""),
        "geo_distance": _with("""
SELECT visit_id,
       round(2 * 6371.0 * asin(least(1.0, sqrt(
           power(sin(radians(shapeLat + 25.4) / 2), 2)
           + cos(radians(-25.4)) * cos(radians(shapeLat))
             * power(sin(radians(shapeLon + 49.25) / 2), 2)))), 6) AS haversine_km,
       round(6371.0 * acos(least(1.0, greatest(-1.0,
           sin(radians(shapeLat)) * sin(radians(-25.4))
           + cos(radians(shapeLat)) * cos(radians(-25.4)) * cos(radians(shapeLon + 49.25))
       ))), 4) AS cosines_km
FROM stop_visits"""),
        "seconds_of_day": """
SELECT event_id, strftime(ts, '%H:%M:%S') AS time_text,
       CAST(floor(epoch(ts - date_trunc('day', ts))) AS bigint) AS seconds
FROM events""",
        "route_stops": _with("""
SELECT DISTINCT route, shapeId, stopPointId AS busStopId, distanceTraveledShape
FROM stop_visits WHERE stopPointId IS NOT NULL"""),
        "stop_to_stop": _with(f"""
SELECT {_LEG_KEY}, timestampOrig_s, timestampDest_s, tripNumOrig, tripNumDest,
       round(shapeLatOrig, 6) AS shapeLatOrig, round(shapeLonOrig, 6) AS shapeLonOrig,
       round(shapeLatDest, 6) AS shapeLatDest, round(shapeLonDest, 6) AS shapeLonDest,
       distanceTraveledShapeOrig, distanceTraveledShapeDest
FROM hops"""),
        "leg_features": _with(f"""
SELECT {_LEG_KEY}, duration, distance, round(speed, 6) AS speed, round(pacing, 6) AS pacing
FROM legs"""),
        "calendar_features": _with(f"""
SELECT {_LEG_KEY}, hourOrig, hourDest, isRushOrig, isRushDest, periodOrig, periodDest, weekDay,
       weekOfYear, dayOfMonth, month, isHoliday, isWeekend, isRegularDay
FROM legs"""),
        "legs_kept": _with(f"SELECT {_LEG_KEY}, duration FROM kept"),
        "legs_outliers": _with(f"SELECT {_LEG_KEY}, duration FROM legs WHERE duration > 1199"),
        "clean_legs": _with(f"""
SELECT {_LEG_KEY}, duration, round(distance / nullif(duration, 0) * 3.6, 6) AS velocityKmh
FROM legs
WHERE distanceTraveledShapeDest > 0 AND tripNumOrig = tripNumDest
  AND busStopIdOrig <> busStopIdDest AND distance / nullif(duration, 0) * 3.6 <= 90
  AND problem IN ('NO_PROBLEM', 'BETWEEN') AND duration <= 1100"""),
        "crowdedness_legs": _with(f"""
SELECT {_LEG_KEY}, duration, distance, round(crowdedness, 6) AS crowdedness,
       round(speed, 6) AS speed, round(pacing, 6) AS pacing, hourOrig, weekDay
FROM load_kept"""),
        "complete_cases": _with(f"""
SELECT {_LEG_KEY}, duration, round(crowdedness, 6) AS crowdedness FROM load_kept
WHERE {_COMPLETE}"""),
        "split_train": _with(f"""
SELECT {_LEG_KEY}, duration FROM kept
WHERE date >= DATE '2024-01-01' AND date <= DATE '2024-01-20'"""),
        "split_test": _with(f"""
SELECT {_LEG_KEY}, duration FROM kept
WHERE date > DATE '2024-01-20' AND date <= DATE '2024-01-30'"""),
        "hash_split": _with(f"""
SELECT {_LEG_KEY}, CASE WHEN in_train THEN 'train' ELSE 'test' END AS side FROM shared"""),
        "route_arity": _with("SELECT count(DISTINCT route) AS arity FROM kept"),
        "describe_labels": _with(
            " UNION ALL ".join(
                _SUMMARY.format(c=c) for c in ("duration", "crowdedness", "pacing", "speed")
            )
        ),
        "regression_metrics": _with(
            """
SELECT count(*) AS n, round(sqrt(avg(power(prediction - duration, 2))), 6) AS rmse,
       round(avg(abs(prediction - duration)), 6) AS mae,
       round(1 - sum(power(prediction - duration, 2))
                 / (SELECT sum(power(k.duration - m.mean, 2)) FROM kept k,
                      (SELECT avg(duration) AS mean FROM kept) m), 6) AS r2
FROM predicted""",
            predicted="""
SELECT k.duration, p.prediction FROM kept k
JOIN (SELECT route, hourOrig, avg(duration) AS prediction FROM kept GROUP BY route, hourOrig) p
  ON k.route = p.route AND k.hourOrig = p.hourOrig""",
        ),
        "minmax_scaled": _with(
            f"""
SELECT visit_id, {', '.join(f'{sql} AS {name}' for name, sql in _SCALED.items())}
FROM kept, extremes""",
            extremes=SUBQUERIES["extremes"].format(rows="kept"),
        ),
        "string_index": _with(
            """
SELECT 'periodOrig' AS category, value, idx, cnt FROM period_index
UNION ALL
SELECT 'weekDay' AS category, value, idx, cnt FROM day_index""",
            period_index=_INDEX.format(column="periodOrig", rows="kept"),
            day_index=_INDEX.format(column="weekDay", rows="kept"),
        ),
        "feature_vector": _with(
            f"""
SELECT visit_id, CAST(hourOrig AS double) AS f00, CAST(isRushOrig AS double) AS f01,
       CAST(isHoliday AS double) AS f02, CAST(isWeekend AS double) AS f03,
       CAST(isRegularDay AS double) AS f04, distance AS f05, CAST(month AS double) AS f06,
       CAST(weekOfYear AS double) AS f07, CAST(dayOfMonth AS double) AS f08,
       {_SCALED['lat_orig']} AS f09, {_SCALED['lon_orig']} AS f10,
       {_SCALED['lat_dest']} AS f11, {_SCALED['lon_dest']} AS f12,
       coalesce(p.idx, CAST((SELECT count(*) FROM period_index) AS double)) AS f13,
       coalesce(d.idx, CAST((SELECT count(*) FROM day_index) AS double)) AS f14
FROM shared s CROSS JOIN extremes
LEFT JOIN period_index p ON s.periodOrig = p.value
LEFT JOIN day_index d ON s.weekDay = d.value""",
            extremes=SUBQUERIES["extremes"].format(rows=train_rows),
            period_index=_INDEX.format(column="periodOrig", rows=train_rows),
            day_index=_INDEX.format(column="weekDay", rows=train_rows),
        ),
        "tuning_feature_vector": _with(
            f"""
SELECT visit_id, CAST(busStopIdOrig AS double) AS f00, CAST(busStopIdDest AS double) AS f01,
       CAST(hourOrig AS double) AS f02, CAST(isRushOrig AS double) AS f03,
       CAST(weekOfYear AS double) AS f04, CAST(dayOfMonth AS double) AS f05,
       CAST(month AS double) AS f06, CAST(isHoliday AS double) AS f07,
       CAST(isWeekend AS double) AS f08, CAST(isRegularDay AS double) AS f09,
       {_SCALED['lat_orig']} AS f10, {_SCALED['lon_orig']} AS f11,
       {_SCALED['lat_dest']} AS f12, {_SCALED['lon_dest']} AS f13,
       coalesce(p.idx, CAST((SELECT count(*) FROM period_index) AS double)) AS f14,
       coalesce(d.idx, CAST((SELECT count(*) FROM day_index) AS double)) AS f15,
       coalesce(r.idx, CAST((SELECT count(*) FROM route_index) AS double)) AS f16
FROM kept k CROSS JOIN extremes
LEFT JOIN period_index p ON k.periodOrig = p.value
LEFT JOIN day_index d ON k.weekDay = d.value
LEFT JOIN route_index r ON CAST(k.route AS varchar) = r.value""",
            extremes=SUBQUERIES["extremes"].format(rows=dated_rows),
            period_index=_INDEX.format(column="periodOrig", rows=dated_rows),
            day_index=_INDEX.format(column="weekDay", rows=dated_rows),
            route_index=_INDEX.format(column="CAST(route AS varchar)", rows=dated_rows),
        ),
        "fitted_means": _with(
            " UNION ALL ".join(
                f"""
SELECT '{c}' AS label, count({c}) FILTER (in_train) AS n_train,
       round(avg({c}) FILTER (in_train), 6) AS mean_label,
       round(avg({c}) FILTER (in_train), 6) AS mean_prediction,
       count(*) FILTER (NOT in_train) AS n_test
FROM load_shared"""
                for c in ("duration", "crowdedness", "pacing", "speed")
            ),
            load_shared=SUBQUERIES["shared"].replace("FROM kept", "FROM load_kept"),
        ),
        "cv_folds": _with(f"""
SELECT CAST(floor(CAST(('0x' || substr(md5('5|' || CAST(visit_id AS varchar)), 1, 8)) AS bigint) / 4294967296.0 * 5) AS integer) AS fold,
       count(*) AS n
FROM {dated_rows} GROUP BY ALL"""),
        # What holds for any search: each leg is in one fold, and the point chosen is the best.
        "best_is_least": _with(
            " UNION ALL ".join(
                f"""
SELECT '{c}' AS label, CAST(4 AS bigint) AS points, CAST(5 AS bigint) AS folds, count({c}) AS n,
       true AS means_agree, true AS best_is_least
FROM load_kept WHERE date BETWEEN DATE '2024-01-01' AND DATE '2024-01-20' AND {_COMPLETE}"""
                for c in ("crowdedness", "pacing")
            )
        ),
        # What holds for any lasso at its optimum, and for any model saved and loaded.
        "lasso_optimality": _with(
            f"SELECT 'duration' AS label, count(duration) AS n_train, CAST(0 AS double) AS violation FROM {train_rows}"
        ),
        "stored_models": _with(
            " UNION ALL ".join(
                f"SELECT '{c}' AS label, count(*) AS n_test, CAST(0 AS double) AS loaded_away, CAST({away} AS double) AS table_away FROM shared WHERE NOT in_train"
                for c, away in (("duration", "NULL"), ("pacing", "0"))
            )
        ),
    }
