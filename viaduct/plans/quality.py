"""Queries for filters, validation and integrity checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import functions as V
from ..operators import integrity, quality
from ..operators.features import conform_events
from ..operators.reports import select_report_columns
from ..operators.upsert import insert_ignore
from .catalog import query
from .scalars import CLEAN_SQL

READING = 'event_id, sensor_id, latitude, longitude, vehicle_count, average_speed_kmh, "timestamp"'
READING_COLUMNS = ("event_id", "sensor_id", "latitude", "longitude", "vehicle_count", "average_speed_kmh", "timestamp")


@query("valid_coordinates", """
SELECT event_id, latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180 AS is_valid,
       CASE WHEN sensor_id IS NULL THEN FALSE ELSE latitude BETWEEN -90 AND 90 END AS valid_if_known FROM readings""")
def valid_coordinates(m):
    known = F.when(F.col("sensor_id").isNotNull(), F.col("longitude"))
    return m.readings.select("event_id", V.valid_coordinates(F.col("latitude"), F.col("longitude")).alias("is_valid"),
                             V.valid_coordinates(F.col("latitude"), known).alias("valid_if_known"))


@query("drop_exact_duplicates", f"SELECT DISTINCT {READING} FROM readings")
def drop_exact_duplicates(m):
    return quality.drop_exact_duplicates(m.readings).select(*READING_COLUMNS)


@query("drop_missing_core", f"SELECT {READING} FROM readings WHERE sensor_id IS NOT NULL")
def drop_missing_core(m):
    return quality.drop_missing_core(m.readings).select(*READING_COLUMNS)


@query("filter_ranges", f"""
SELECT {READING} FROM readings WHERE vehicle_count >= 0 AND average_speed_kmh BETWEEN 0 AND 200""")
def filter_ranges(m):
    return quality.filter_ranges(m.readings).select(*READING_COLUMNS)


@query("filter_ranges_uncapped", f"SELECT {READING} FROM readings WHERE vehicle_count >= 0 AND average_speed_kmh >= 0")
def filter_ranges_uncapped(m):
    return quality.filter_ranges(m.readings, max_speed=None).select(*READING_COLUMNS)


@query("clean_readings", f"SELECT {READING} FROM {CLEAN_SQL}")
def clean_readings(m):
    return quality.clean_readings(m.readings).select(*READING_COLUMNS)


@query("select_report_columns", """
SELECT 'DAILY' AS report_type, CAST("timestamp" AS DATE) AS report_date, road_id, average_speed_kmh AS avg_speed,
       vehicle_count AS total_vehicles, hour AS peak_hour, month AS congestion_hours,
       traffic_density AS congestion_score FROM traffic_events""")
def report_columns(m):
    wide = m.events.withColumns({"report_type": F.lit("DAILY"), "report_date": F.to_date("timestamp")})
    return select_report_columns(wide.withColumnsRenamed({
        "average_speed_kmh": "avg_speed", "vehicle_count": "total_vehicles", "hour": "peak_hour",
        "month": "congestion_hours", "traffic_density": "congestion_score"}))


@query("conform_events", """
SELECT e.event_id, e.sensor_id, e.road_id, e."timestamp", e.vehicle_count, e.average_speed_kmh, e.traffic_density,
       e.congestion_index, e.congestion_level, w.weather_id, e.hour, e.day_of_week, e.month, e.is_weekend, e.is_rush_hour
FROM traffic_events e ASOF LEFT JOIN weather_data w ON e."timestamp" >= w."timestamp"
""")
def conform(m):
    sent = m.raw_events.drop("road_id", "weather_id")
    return conform_events(sent, m.sensors, m.roads, m.weather)


@query("check_references", """
SELECT 'weather_id' AS column_name, CAST(weather_id AS VARCHAR) AS missing_key, count(*) AS "rows"
FROM traffic_events WHERE weather_id NOT IN (SELECT weather_id FROM weather_data) GROUP BY weather_id
UNION ALL
SELECT 'road_id', CAST(road_id AS VARCHAR), count(*)
FROM traffic_events WHERE road_id NOT IN (SELECT road_id FROM roads) GROUP BY road_id
UNION ALL
SELECT 'sensor_id', sensor_id, count(*)
FROM readings WHERE sensor_id NOT IN (SELECT sensor_id FROM sensor_locations WHERE is_active) GROUP BY sensor_id""")
def check_references(m):
    events = integrity.check_references(m.raw_events, {
        "weather_id": (m.weather, "weather_id"), "road_id": (m.roads, "road_id")})
    return events.unionAll(integrity.check_references(
        m.readings, {"sensor_id": (m.sensors.where("is_active"), "sensor_id")}))


@query("violating_rows", """
SELECT event_id, weather_id FROM raw_events
WHERE weather_id IS NOT NULL AND weather_id NOT IN (SELECT weather_id FROM weather_data)""")
def violating_rows(m):
    return integrity.violating_rows(m.raw_events, "weather_id", m.weather, "weather_id").select("event_id", "weather_id")


@query("check_not_null_unique", """
SELECT * FROM (
  SELECT 'NOT NULL' AS rule, 'sensor_id' AS column_name, count(*) AS violations FROM readings WHERE sensor_id IS NULL
  UNION ALL SELECT 'NOT NULL', 'latitude', count(*) FROM readings WHERE latitude IS NULL
  UNION ALL SELECT 'UNIQUE', 'event_id', count(event_id) - count(DISTINCT event_id) FROM readings
  UNION ALL SELECT 'UNIQUE', 'sensor_id', count(sensor_id) - count(DISTINCT sensor_id) FROM readings)
WHERE violations > 0""")
def check_not_null_unique(m):
    return integrity.check_not_null_unique(m.readings, ["sensor_id", "latitude"], ["event_id", "sensor_id"])


@query("insert_ignore", """
SELECT sensor_id, min(road_id) AS road_id FROM raw_events
WHERE sensor_id NOT IN (SELECT sensor_id FROM sensor_locations WHERE is_active) GROUP BY sensor_id""")
def insert_new(m):
    return insert_ignore(m.raw_events.select("sensor_id", "road_id"),
                         m.sensors.where("is_active").select("sensor_id", "road_id"), ["sensor_id"])


@query("quarantine", """
SELECT event_id, CASE WHEN sensor_id IS NULL THEN 'missing core field'
       WHEN latitude NOT BETWEEN -90 AND 90 THEN 'coordinates out of range'
       ELSE 'count or speed out of range' END AS error
FROM readings
WHERE sensor_id IS NULL OR latitude NOT BETWEEN -90 AND 90 OR vehicle_count < 0
   OR average_speed_kmh < 0 OR average_speed_kmh > 200""")
def quarantined(m):
    _, bad = quality.quarantine(m.readings, max_speed=200.0)
    return bad.select(F.get_json_object("original_payload", "$.event_id").cast("long").alias("event_id"), "error")
