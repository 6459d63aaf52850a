"""Queries for the latest state, feeds, filters and search."""

from __future__ import annotations

from ..operators import serving
from ..operators.reports import network_kpis
from ..sources import read_query
from .catalog import query

_STATUS = """
SELECT e.sensor_id, r.road_name, s.latitude, s.longitude, e."timestamp", e.vehicle_count, e.average_speed_kmh,
       e.congestion_index, e.congestion_level, w.weather_condition, w.temperature_celsius
FROM (SELECT * FROM traffic_events QUALIFY row_number() OVER (PARTITION BY sensor_id ORDER BY "timestamp" DESC, event_id DESC) = 1) e
JOIN roads r ON e.road_id = r.road_id JOIN sensor_locations s ON e.sensor_id = s.sensor_id
LEFT JOIN weather_data w ON e.weather_id = w.weather_id"""


def _status(m):
    return serving.current_status(m.events, m.sensors, m.roads, m.weather)


@query("current_status", _STATUS)
def current_status(m):
    return _status(m)


@query("critical_nodes", f"SELECT * FROM ({_STATUS}) WHERE congestion_level IN ('HIGH', 'CRITICAL')")
def critical_nodes(m):
    return serving.critical_nodes(_status(m))


_LATEST = """
SELECT e.*, r.road_name, r.speed_limit_kmh, r.num_lanes, w.weather_condition
FROM traffic_events e JOIN roads r ON e.road_id = r.road_id LEFT JOIN weather_data w ON e.weather_id = w.weather_id
ORDER BY e."timestamp" DESC, e.event_id DESC LIMIT 100"""


def _latest(m):
    return serving.latest_events(m.events, m.roads, m.weather)


@query("latest_events", _LATEST)
def latest_events(m):
    return _latest(m)


@query("telemetry_feed", f"""
SELECT road_name, vehicle_count, average_speed_kmh, congestion_level, weather_condition, "timestamp" FROM ({_LATEST})""")
def telemetry_feed(m):
    return serving.telemetry_feed(_latest(m))


@query("latest_network_kpis", f"""
SELECT CAST(sum(vehicle_count) AS BIGINT) AS total_vehicles, round_even(avg(average_speed_kmh) * 10, 0) / 10 AS avg_speed,
       count(CASE WHEN congestion_level IN ('HIGH', 'CRITICAL') THEN 1 END) AS congested_count,
       count(DISTINCT road_name) AS road_count FROM ({_LATEST})""")
def latest_network_kpis(m):
    return network_kpis(_latest(m))


@query("volume_trend", """
SELECT * FROM (SELECT e.event_id, e."timestamp", e.vehicle_count, e.average_speed_kmh, e.congestion_index, e.hour,
                      e.day_of_week, r.road_name
               FROM traffic_events e JOIN roads r ON e.road_id = r.road_id ORDER BY e."timestamp", e.event_id LIMIT 5000)
WHERE road_name IN ('NATION_1', 'NATION_7', 'NATION_24')""")
def volume_trend(m):
    return serving.volume_trend(m.events, m.roads, ["NATION_1", "NATION_7", "NATION_24"])


@query("volume_trend_by_hour", """
SELECT road_name, date_trunc('hour', "timestamp") AS period, CAST(sum(vehicle_count) AS BIGINT) AS vehicle_count
FROM raw_events e JOIN roads r ON e.road_id = r.road_id GROUP BY ALL""")
def volume_trend_by_hour(m):
    return serving.volume_trend_by(m.raw_events, m.roads, "hour")


@query("filter_levels", """
SELECT event_id, congestion_level FROM traffic_events WHERE congestion_level IN ('LOW', 'CRITICAL')""")
def filter_levels(m):
    return serving.filter_levels(m.events, ["LOW", "CRITICAL"]).select("event_id", "congestion_level")


@query("filter_roads", """
SELECT e.event_id, r.road_name FROM traffic_events e JOIN roads r ON e.road_id = r.road_id
WHERE r.road_name IN ('NATION_3', 'NATION_14')""")
def filter_roads(m):
    return serving.filter_roads(m.named_events, ["NATION_3", "NATION_14"]).select("event_id", "road_name")


@query("search_rows", """
SELECT event_id, sensor_id, road_id, congestion_level, event_type, weather_id FROM traffic_events
WHERE regexp_matches(CAST(event_id AS VARCHAR), '(?i)sensor_1[0-4]$|crit|^signup$|777')
   OR regexp_matches(sensor_id, '(?i)sensor_1[0-4]$|crit|^signup$|777')
   OR regexp_matches(CAST(road_id AS VARCHAR), '(?i)sensor_1[0-4]$|crit|^signup$|777')
   OR regexp_matches(congestion_level, '(?i)sensor_1[0-4]$|crit|^signup$|777')
   OR regexp_matches(event_type, '(?i)sensor_1[0-4]$|crit|^signup$|777')
   OR regexp_matches(CAST(weather_id AS VARCHAR), '(?i)sensor_1[0-4]$|crit|^signup$|777')""")
def search_rows(m):
    shown = m.events.select("event_id", "sensor_id", "road_id", "congestion_level", "event_type", "weather_id")
    return serving.search_rows(shown, "sensor_1[0-4]$|crit|^signup$|777")


@query("preview_table", "SELECT event_id, sensor_id, vehicle_count FROM raw_events ORDER BY event_id LIMIT 1000")
def preview_table(m):
    return serving.preview_table({"traffic_events": m.raw_events}, "traffic_events", key="event_id").select(
        "event_id", "sensor_id", "vehicle_count")


@query("read_query", """
SELECT r.road_name, count(*) AS readings FROM raw_events e JOIN roads r ON e.road_id = r.road_id
WHERE e.average_speed_kmh > r.speed_limit_kmh - 10 GROUP BY r.road_name""")
def bound_query(m):
    return read_query(m.spark, """
        SELECT r.road_name, count(*) AS readings FROM {raw_events} e JOIN {roads} r ON e.road_id = r.road_id
        WHERE e.average_speed_kmh > r.speed_limit_kmh - :margin GROUP BY r.road_name""",
        {"margin": 10}, {"raw_events": m.raw_events, "roads": m.roads})
