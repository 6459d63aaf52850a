"""Queries for the scalar functions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from .. import functions as V
from ..operators.features import (clean_and_derive, derive_features, with_column_defaults,
                                  with_road_defaults)
from .catalog import query, rounded

ROAD_OF_EVENT = "raw_events e JOIN roads r ON e.road_id = r.road_id"
TITLE_CASE = """array_to_string(list_transform(regexp_extract_all({0}, '[A-Za-z]+|[^A-Za-z]+'),
    lambda w: upper(w[1]) || lower(w[2:])), '')"""


def _tidy(name: str) -> str:
    return TITLE_CASE.format(f"trim(regexp_replace(coalesce({name}, ''), '\\s+', ' ', 'g'))")


@query("normalize_road_name", f"""
SELECT event_id, {_tidy("road_name")} AS road_name,
       {_tidy("concat('o''neil', chr(9), event_type, '  6th-st')")} AS other_name
FROM readings""")
def normalize_road_name(m):
    other = F.concat(F.lit("o'neil\t"), F.col("event_type"), F.lit("  6th-st"))
    return m.readings.select(
        "event_id", V.normalize_road_name(F.col("road_name")).alias("road_name"),
        V.normalize_road_name(other).alias("other_name"))


@query("traffic_density", f"""
SELECT event_id, vehicle_count / (length_km * num_lanes) AS traffic_density,
       CASE WHEN event_id % 5 = 0 THEN 0e0 ELSE vehicle_count / ((event_id % 5) * 2e0) END AS guarded_density
FROM {ROAD_OF_EVENT}""")
def traffic_density(m):
    length = (F.col("event_id") % 5).cast("double")
    return m.placed_events.select(
        "event_id",
        V.traffic_density(F.col("vehicle_count"), F.col("length_km"), F.col("num_lanes")).alias("traffic_density"),
        V.traffic_density(F.col("vehicle_count"), length, F.lit(2)).alias("guarded_density"))


@query("congestion_index", f"""
SELECT event_id, CASE WHEN average_speed_kmh >= speed_limit_kmh THEN 0e0
                      ELSE 1e0 - average_speed_kmh / speed_limit_kmh END AS congestion_index,
       CASE WHEN event_id % 3 = 0 THEN NULL WHEN event_id % 4 = 0 OR average_speed_kmh >= (event_id % 4) * 30 THEN 0e0
            ELSE 1e0 - average_speed_kmh / ((event_id % 4) * 30) END AS edge_index
FROM {ROAD_OF_EVENT}""")
def congestion_index(m):
    sometimes = F.when(F.col("event_id") % 3 != 0, F.col("average_speed_kmh"))
    return m.placed_events.select(
        "event_id", V.congestion_index(F.col("average_speed_kmh"), F.col("speed_limit_kmh")).alias("congestion_index"),
        V.congestion_index(sometimes, (F.col("event_id") % 4) * 30).alias("edge_index"))


@query("congestion_level", """
SELECT event_id, CASE WHEN x IS NULL THEN NULL WHEN x < 0.25e0 THEN 'LOW' WHEN x < 0.5e0 THEN 'MEDIUM'
                      WHEN x < 0.75e0 THEN 'HIGH' ELSE 'CRITICAL' END AS congestion_level
FROM (SELECT event_id, CASE WHEN event_id % 21 < 20 THEN (event_id % 21) * 0.0625e0 END AS x FROM raw_events)""")
def congestion_level(m):
    step = F.col("event_id") % 21
    return m.raw_events.select("event_id", V.congestion_level(F.when(step < 20, step * 0.0625)).alias("congestion_level"))


@query("is_rush_hour", """
SELECT event_id, hour("timestamp") IN (7, 8, 9, 17, 18, 19) AS is_rush_hour FROM raw_events""")
def is_rush_hour(m):
    return m.raw_events.select("event_id", V.is_rush_hour(F.hour("timestamp")).alias("is_rush_hour"))


@query("is_weekend", """SELECT event_id, isodow("timestamp") IN (5, 6) AS is_weekend FROM raw_events""")
def is_weekend(m):
    return m.raw_events.select("event_id", V.is_weekend(F.weekday("timestamp")).alias("is_weekend"))


_HAVERSINE = """12742e0 * asin(sqrt(pow(sin(radians(30.0444e0 - latitude) / 2), 2)
  + cos(radians(latitude)) * cos(radians(30.0444e0)) * pow(sin(radians(31.2357e0 - longitude) / 2), 2)))"""


@query("haversine_km", f"SELECT event_id, {rounded(_HAVERSINE)} AS distance_km FROM readings")
def haversine_km(m):
    distance = V.haversine_km(F.col("latitude"), F.col("longitude"), F.lit(30.0444), F.lit(31.2357))
    return m.readings.select("event_id", V.round_numeric(distance, 6).alias("distance_km"))


@query("format_ts", """
SELECT event_id, strftime("timestamp", '%Y-%m-%dT%H:%M:%S')
       || CASE WHEN strftime("timestamp", '%f') = '000000' THEN '' ELSE strftime("timestamp", '.%f') END
       || '+00:00' AS iso_text,
       strftime(date_trunc('second', "timestamp"), '%Y-%m-%dT%H:%M:%S+00:00') AS iso_seconds FROM raw_events""")
def format_ts(m):
    instant = F.col("timestamp").cast("timestamp")
    return m.raw_events.select("event_id", V.format_ts(instant).alias("iso_text"),
                               V.format_ts(F.date_trunc("second", instant)).alias("iso_seconds"))


@query("parse_ts", """
SELECT event_id, date_trunc('second', "timestamp") AS parsed, CAST(NULL AS TIMESTAMP) AS not_parsed FROM raw_events""")
def parse_ts(m):
    text = F.date_format(F.col("timestamp").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ssXXX")
    return m.raw_events.select("event_id", V.parse_ts(text).cast("timestamp_ntz").alias("parsed"),
                               V.parse_ts(F.concat(F.lit("on "), text)).cast("timestamp_ntz").alias("not_parsed"))


@query("time_features", """
SELECT event_id, CAST(hour("timestamp") AS INT) AS hour, CAST(isodow("timestamp") - 1 AS INT) AS day_of_week,
       CAST(month("timestamp") AS INT) AS month, isodow("timestamp") IN (5, 6) AS is_weekend,
       hour("timestamp") IN (7, 8, 9, 17, 18, 19) AS is_rush_hour FROM raw_events""")
def time_features(m):
    return m.raw_events.select("event_id", *[c.alias(n) for n, c in V.time_features(F.col("timestamp")).items()])


@query("with_road_defaults", """
SELECT event_id, CASE WHEN event_id % 2 = 0 THEN CAST(2 AS INT) ELSE CAST(3 AS INT) END AS num_lanes,
       5e0 AS length_km, CAST(60 AS INT) AS speed_limit_kmh FROM raw_events""")
def road_defaults(m):
    lanes = F.when(F.col("event_id") % 2 == 0, F.lit(2))
    return with_road_defaults(m.raw_events.select("event_id", lanes.alias("num_lanes"))).select(
        "event_id", "num_lanes", "length_km", "speed_limit_kmh")


@query("with_column_defaults", """
SELECT sensor_id, CASE WHEN is_active THEN installation_date ELSE DATE '2024-02-01' END AS installation_date,
       'Cairo' AS city, TRUE AS is_active, TIMESTAMP '2024-02-01 00:00:00' AS created_at FROM sensor_locations""")
def column_defaults(m):
    sometimes = F.when(F.col("is_active"), F.col("installation_date")).alias("installation_date")
    return with_column_defaults(m.sensors.select("sensor_id", sometimes), {
        "installation_date": dt.date(2024, 2, 1), "city": "Cairo", "is_active": True,
        "created_at": F.to_timestamp_ntz(F.lit("2024-02-01 00:00:00"))})


@query("expected_speed", f"""
SELECT event_id, speed_limit_kmh * greatest(0.1e0, least(1.1e0, 1e0 - vehicle_count / (num_lanes * 150 * 1.5e0)))
       AS expected_speed FROM {ROAD_OF_EVENT}""")
def expected_speed(m):
    return m.placed_events.select(
        "event_id", V.expected_speed(F.col("vehicle_count"), F.col("num_lanes"), F.col("speed_limit_kmh"))
        .alias("expected_speed"))


RULE_SQL = """floor(num_lanes * 150 * CASE WHEN hour >= 23 OR hour <= 5 THEN 0.1e0 WHEN is_rush_hour THEN 0.95e0
  WHEN is_weekend THEN 0.35e0 ELSE 0.5e0 END)"""


@query("rule_vehicle_count", f"""
SELECT event_id, {RULE_SQL} AS rule_count FROM traffic_events e JOIN roads r ON e.road_id = r.road_id""")
def rule_vehicle_count(m):
    flagged = m.placed_events.withColumns(V.time_features(F.col("timestamp")))
    return flagged.select("event_id", V.rule_vehicle_count(
        F.col("hour"), F.col("num_lanes"), F.col("is_rush_hour"), F.col("is_weekend")).alias("rule_count"))


@query("classify_weather", """
SELECT weather_id, weather_condition,
       CASE WHEN rain_mm > 3 THEN 'Rainy' WHEN rain_mm > 0 THEN 'Drizzle'
            WHEN humidity_percent > 60 AND temperature_celsius < 25 THEN 'Foggy'
            WHEN wind_speed_kmh > 15 AND temperature_celsius > 30 THEN 'Sandstorm' ELSE 'Sunny' END AS other_label
FROM weather_data""")
def classify_weather(m):
    other = V.classify_weather(
        F.col("rain_mm"), F.col("humidity_percent"), F.col("temperature_celsius"), F.col("wind_speed_kmh"),
        heavy_rain_mm=3, fog_humidity=60, fog_below_celsius=25, storm_wind_kmh=15, storm_above_celsius=30)
    return m.weather.select("weather_id", "weather_condition", other.alias("other_label"))


@query("ride_fare", """
SELECT request_id, fare_amount, 15e0 + distance_km * 7.5e0 + duration_minutes * 1.5e0 AS expected_fare,
       fare_amount - (15e0 + distance_km * 7.5e0 + duration_minutes * 1.5e0) AS deviation FROM ride_requests""")
def ride_fare(m):
    expected = V.ride_fare(F.col("distance_km"), F.col("duration_minutes"))
    return m.rides.select("request_id", "fare_amount", expected.alias("expected_fare"),
                          (F.col("fare_amount") - expected).alias("deviation"))


@query("road_type", f"""
SELECT event_id, road_type, CASE WHEN average_speed_kmh <= 60 THEN 'Urban' ELSE 'Highway' END AS type_by_speed
FROM {ROAD_OF_EVENT}""")
def road_type(m):
    return m.placed_events.select(
        "event_id", V.road_type(F.col("speed_limit_kmh")).alias("road_type"),
        V.road_type(F.col("average_speed_kmh")).alias("type_by_speed"))


@query("marker_color", """
SELECT event_id, CASE congestion_level WHEN 'LOW' THEN 'green' WHEN 'MEDIUM' THEN 'orange' WHEN 'HIGH' THEN 'red'
       WHEN 'CRITICAL' THEN 'darkred' ELSE 'blue' END AS marker_color, 'blue' AS other_color FROM traffic_events""")
def marker_color(m):
    return m.events.select("event_id", V.marker_color(F.col("congestion_level")).alias("marker_color"),
                           V.marker_color(F.col("event_type")).alias("other_color"))


@query("sensor_id_for_road", """
SELECT event_id, concat('SENSOR_', upper(replace(road_name, ' ', '_')), '_01') AS first_sensor_id FROM readings""")
def sensor_id_for_road(m):
    return m.readings.select("event_id", V.sensor_id_for_road(F.col("road_name")).alias("first_sensor_id"))


@query("weekday_number", """
SELECT event_id, CAST(isodow("timestamp") - 1 AS INT) AS day_number, CAST(NULL AS INT) AS unknown_day FROM raw_events""")
def weekday_number(m):
    name = F.date_format("timestamp", "EEEE")
    return m.raw_events.select("event_id", V.weekday_number(name).alias("day_number"),
                               V.weekday_number(F.col("event_type")).alias("unknown_day"))


@query("hour_label", """SELECT event_id, strftime("timestamp", '%H:00') AS hour_label FROM raw_events""")
def hour_label(m):
    return m.raw_events.select("event_id", V.hour_label(F.hour("timestamp")).alias("hour_label"))


DERIVED_SQL = f"""
SELECT event_id, sensor_id, {_tidy("road_name")} AS road_name, "timestamp", vehicle_count, average_speed_kmh,
       CAST(hour("timestamp") AS INT) AS hour, CAST(isodow("timestamp") - 1 AS INT) AS day_of_week,
       CAST(month("timestamp") AS INT) AS month, isodow("timestamp") IN (5, 6) AS is_weekend,
       hour("timestamp") IN (7, 8, 9, 17, 18, 19) AS is_rush_hour,
       vehicle_count / 15e0 AS traffic_density,
       least(1e0, CASE WHEN average_speed_kmh >= 60 THEN 0e0 ELSE 1e0 - average_speed_kmh / 60 END) AS congestion_index,
       CASE WHEN average_speed_kmh > 45 THEN 'LOW' WHEN average_speed_kmh > 30 THEN 'MEDIUM'
            WHEN average_speed_kmh > 15 THEN 'HIGH' ELSE 'CRITICAL' END AS congestion_level
FROM {{0}}"""
DERIVED_COLUMNS = ("event_id", "sensor_id", "road_name", "timestamp", "vehicle_count", "average_speed_kmh", "hour",
                   "day_of_week", "month", "is_weekend", "is_rush_hour", "traffic_density", "congestion_index",
                   "congestion_level")
CLEAN_SQL = """(SELECT DISTINCT * FROM readings WHERE sensor_id IS NOT NULL AND vehicle_count >= 0
  AND average_speed_kmh BETWEEN 0 AND 200 AND latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180)"""


@query("derive_features", DERIVED_SQL.format("readings"))
def derive(m):
    return derive_features(m.readings).select(*DERIVED_COLUMNS)


@query("clean_and_derive", DERIVED_SQL.format(CLEAN_SQL))
def clean_then_derive(m):
    return clean_and_derive(m.readings).select(*DERIVED_COLUMNS)


@query("sql_functions", f"""
SELECT event_id, r.road_type, {RULE_SQL} AS rule_count, e.congestion_index, e.congestion_level, e.traffic_density,
       e.is_rush_hour, e.is_weekend, strftime("timestamp", '%H:00') AS hour_label, {_tidy("r.road_name || ' o''neil 6th'")} AS road_name,
       concat('SENSOR_', upper(replace(r.road_name, ' ', '_')), '_01') AS first_sensor_id
FROM traffic_events e JOIN roads r ON e.road_id = r.road_id""")
def sql_functions(m):
    V.register_sql_functions(m.spark)
    return m.spark.sql("""
        SELECT event_id, road_type(speed_limit_kmh) AS road_type,
               rule_vehicle_count(h, num_lanes, is_rush_hour(h), is_weekend(d)) AS rule_count,
               congestion_index(average_speed_kmh, speed_limit_kmh) AS congestion_index,
               congestion_level(congestion_index(average_speed_kmh, speed_limit_kmh)) AS congestion_level,
               traffic_density(vehicle_count, length_km, num_lanes) AS traffic_density,
               is_rush_hour(h) AS is_rush_hour, is_weekend(d) AS is_weekend, hour_label(h) AS hour_label,
               normalize_road_name(road_name || " o'neil 6th") AS road_name,
               sensor_id_for_road(road_name) AS first_sensor_id
        FROM (SELECT *, hour(timestamp) AS h, weekday(timestamp) AS d FROM {placed})""", placed=m.placed_events)
