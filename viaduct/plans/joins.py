"""Queries for the joins."""

from __future__ import annotations

from ..operators import joins
from ..operators.asof import asof_weather
from ..operators.reports import peak_hour, road_daily_stats
from ..functions import round_numeric
from pyspark.sql import functions as F
from .catalog import query, rounded


@query("join_roads", """
SELECT e.event_id, r.road_id, r.road_name, r.speed_limit_kmh, e.vehicle_count
FROM raw_events e JOIN roads r ON e.road_id = r.road_id""")
def join_roads(m):
    return joins.join_roads(m.raw_events, m.roads).select(
        "event_id", "road_id", "road_name", "speed_limit_kmh", "vehicle_count")


@query("join_sensors", """
SELECT e.event_id, s.sensor_id, e.road_id, s.latitude, s.longitude, s.is_active
FROM raw_events e JOIN sensor_locations s ON e.sensor_id = s.sensor_id""")
def join_sensors(m):
    return joins.join_sensors(m.raw_events, m.sensors).select(
        "event_id", "sensor_id", "road_id", "latitude", "longitude", "is_active")


@query("join_weather_left", """
SELECT e.event_id, e.weather_id, w.weather_condition, w.temperature_celsius, w."timestamp" AS timestamp_weather
FROM raw_events e LEFT JOIN weather_data w ON e.weather_id = w.weather_id""")
def join_weather_left(m):
    return joins.join_weather_left(m.raw_events, m.weather).select(
        "event_id", "weather_id", "weather_condition", "temperature_celsius", "timestamp_weather")


@query("join_weather_inner", """
SELECT e.event_id, e."timestamp", w.weather_id, w.weather_condition, w."timestamp" AS timestamp_weather
FROM raw_events e JOIN weather_data w ON e.weather_id = w.weather_id""")
def join_weather_inner(m):
    return joins.join_weather_inner(m.raw_events, m.weather).select(
        "event_id", "timestamp", "weather_id", "weather_condition", "timestamp_weather")


@query("join_stats_peak", f"""
SELECT s.road_id, s.avg_speed, s.total_vehicles, p.peak_hour FROM
 (SELECT road_id, {rounded("avg(average_speed_kmh)")} AS avg_speed, CAST(sum(vehicle_count) AS BIGINT) AS total_vehicles
  FROM traffic_events GROUP BY road_id) s JOIN
 (SELECT road_id, hour AS peak_hour FROM
   (SELECT road_id, hour, sum(vehicle_count) AS v FROM traffic_events GROUP BY road_id, hour)
  QUALIFY row_number() OVER (PARTITION BY road_id ORDER BY v DESC, hour) = 1) p ON s.road_id = p.road_id""")
def join_stats_peak(m):
    return joins.join_stats_peak(road_daily_stats(m.events), peak_hour(m.events)).select(
        "road_id", round_numeric(F.col("avg_speed"), 6).alias("avg_speed"), "total_vehicles", "peak_hour")


@query("asof_weather", """
SELECT e.event_id, e."timestamp", w.weather_id, w."timestamp" AS timestamp_weather, w.weather_condition
FROM raw_events e ASOF LEFT JOIN weather_data w ON e."timestamp" >= w."timestamp"
""")
def asof(m):
    return asof_weather(m.raw_events, m.weather).select(
        "event_id", "timestamp", "weather_id", "timestamp_weather", "weather_condition")
