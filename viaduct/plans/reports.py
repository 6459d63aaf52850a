"""Queries for aggregates and reports."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from ..functions import round_numeric
from ..operators import reports
from ..operators.rollups import read_rollup, report_from_rollup, update_rollup
from ..operators.serving import sensor_health, silent_sensors
from ..session import shared_path
from .catalog import query, rounded
from .model import at

AS_OF = "2024-01-30 12:00:00"
REPORT_DAY = dt.date(2024, 1, 31)
LAST_DAY = f"""WHERE "timestamp" > TIMESTAMP '{AS_OF}' - INTERVAL 24 HOUR"""


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: round_numeric(F.col(name), 6) for name in names})


@query("road_hour_volume", """
SELECT road_id, hour, CAST(sum(vehicle_count) AS BIGINT) AS total_hour_vehicles
FROM traffic_events GROUP BY road_id, hour""")
def road_hour_volume(m):
    return reports.road_hour_volume(m.raw_events.withColumn("hour", F.hour("timestamp")))


@query("road_daily_stats", f"""
SELECT road_id, {rounded("avg(average_speed_kmh)")} AS avg_speed, CAST(sum(vehicle_count) AS BIGINT) AS total_vehicles,
       {rounded("avg(congestion_index)")} AS congestion_score,
       count(CASE WHEN congestion_index > 0.5e0 THEN 1 END) AS congestion_hours
FROM traffic_events GROUP BY road_id""")
def road_daily_stats(m):
    return _rounded(reports.road_daily_stats(m.events), "avg_speed", "congestion_score")


def _report_sql(report_type: str, start: str) -> str:
    return f"""
SELECT '{report_type}' AS report_type, start AS report_date, road_id,
       {rounded("sum(speeds) / sum(n)")} AS avg_speed, CAST(sum(v) AS BIGINT) AS total_vehicles,
       CAST(arg_max(hour, v * 100 + 99 - hour) AS INT) AS peak_hour, CAST(sum(congested) AS BIGINT) AS congestion_hours,
       {rounded("sum(indexes) / sum(n)")} AS congestion_score
FROM (SELECT {start} AS start, road_id, hour, sum(vehicle_count) AS v, sum(average_speed_kmh) AS speeds,
             sum(congestion_index) AS indexes, count(*) AS n,
             count(CASE WHEN congestion_index > 0.5e0 THEN 1 END) AS congested
      FROM traffic_events GROUP BY 1, road_id, hour)
GROUP BY start, road_id"""


@query("daily_report", _report_sql("DAILY", "DATE '2024-01-31'"))
def daily_report(m):
    return _rounded(reports.daily_report(m.events, REPORT_DAY), "avg_speed", "congestion_score")


@query("period_report_daily", _report_sql("DAILY", """CAST("timestamp" AS DATE)"""))
def period_report_daily(m):
    return _rounded(reports.period_report(m.events, "DAILY"), "avg_speed", "congestion_score")


@query("period_report_weekly", _report_sql("WEEKLY", """CAST(date_trunc('week', "timestamp") AS DATE)"""))
def period_report_weekly(m):
    return _rounded(reports.period_report(m.events, "WEEKLY"), "avg_speed", "congestion_score")


@query("period_report_monthly", _report_sql("MONTHLY", """CAST(date_trunc('month', "timestamp") AS DATE)"""))
def period_report_monthly(m):
    return _rounded(reports.period_report(m.events, "MONTHLY"), "avg_speed", "congestion_score")


def _kept_in_sums(m) -> DataFrame:
    """Stored sums of what was there at first; then three days change, one of which loses its readings and gets them
    back."""
    path = shared_path(m.spark, "rollup")
    day = F.to_date("timestamp")
    changed = [dt.date(2024, 1, d) for d in (10, 11, 12)]
    update_rollup(m.events.where(~day.isin(changed[:2]) & (F.col("event_id") % 7 != 0) | day.between(dt.date(2024, 1, 13), dt.date(2024, 1, 31))), path)
    update_rollup(m.events.where(day != changed[2]), path, [changed[2]])
    everything = [dt.date(2024, 1, d) for d in range(1, 13)]
    update_rollup(m.events, path, everything)
    return read_rollup(m.spark, path)


@query("report_from_rollup_daily", _report_sql("DAILY", """CAST("timestamp" AS DATE)"""))
def report_from_rollup_daily(m):
    return _rounded(report_from_rollup(_kept_in_sums(m), "DAILY"), "avg_speed", "congestion_score")


@query("report_from_rollup_weekly", _report_sql("WEEKLY", """CAST(date_trunc('week', "timestamp") AS DATE)"""))
def report_from_rollup_weekly(m):
    return _rounded(report_from_rollup(_kept_in_sums(m), "WEEKLY"), "avg_speed", "congestion_score")


@query("report_from_rollup_monthly", _report_sql("MONTHLY", """CAST(date_trunc('month', "timestamp") AS DATE)"""))
def report_from_rollup_monthly(m):
    return _rounded(report_from_rollup(_kept_in_sums(m), "MONTHLY"), "avg_speed", "congestion_score")


@query("peak_hour", """
SELECT road_id, hour AS peak_hour FROM
 (SELECT road_id, hour, sum(vehicle_count) AS v FROM traffic_events GROUP BY road_id, hour)
QUALIFY row_number() OVER (PARTITION BY road_id ORDER BY v DESC, hour) = 1""")
def peak_hour(m):
    return reports.peak_hour(m.raw_events.withColumn("hour", F.hour("timestamp")))


@query("peak_hour_with_ties", """
SELECT road_id, hour AS peak_hour FROM
 (SELECT road_id, hour, sum(vehicle_count // 100) AS v FROM traffic_events GROUP BY road_id, hour)
QUALIFY rank() OVER (PARTITION BY road_id ORDER BY v DESC) = 1""")
def peak_hour_with_ties(m):
    coarse = F.floor(F.col("vehicle_count") / 100).alias("vehicle_count")
    return reports.peak_hour(m.raw_events.select("road_id", F.hour("timestamp").alias("hour"), coarse), keep_ties=True)


def _summary_sql(where: str) -> str:
    return f"""
SELECT road_name, speed_limit_kmh, {rounded("avg(average_speed_kmh)", 2)} AS avg_speed,
       {rounded("avg(vehicle_count)", 2)} AS avg_vehicle_count, {rounded("avg(congestion_index)", 2)} AS avg_congestion_index,
       count(CASE WHEN congestion_level = 'CRITICAL' THEN 1 END) AS critical_events_count
FROM traffic_events e JOIN roads r ON e.road_id = r.road_id {where} GROUP BY road_name, speed_limit_kmh"""


@query("road_congestion_summary", _summary_sql(""))
def road_congestion_summary(m):
    return reports.road_congestion_summary(m.events, m.roads)


@query("road_congestion_summary_last_day", _summary_sql(LAST_DAY))
def road_congestion_summary_last_day(m):
    return reports.road_congestion_summary(m.events, m.roads, as_of=at(AS_OF))


@query("lookback_filter", f"""SELECT event_id, "timestamp" FROM raw_events {LAST_DAY}""")
def lookback_filter(m):
    return reports.lookback_filter(m.raw_events, at(AS_OF)).select("event_id", "timestamp")


@query("hourly_profile", f"""
SELECT hour, road_name, {rounded("avg(vehicle_count)")} AS vehicle_count
FROM traffic_events e JOIN roads r ON e.road_id = r.road_id GROUP BY hour, road_name""")
def hourly_profile(m):
    hours = m.raw_events.withColumn("hour", F.hour("timestamp"))
    return _rounded(reports.hourly_profile(hours, m.roads), "vehicle_count")


_CELLS = ", ".join(rounded(f"avg(CASE WHEN hour = {h} THEN congestion_index END)") + f" AS h{h:02d}" for h in range(24))


@query("congestion_heatmap", f"""
SELECT road_name, {_CELLS} FROM traffic_events e JOIN roads r ON e.road_id = r.road_id GROUP BY road_name""")
def congestion_heatmap(m):
    return _rounded(reports.congestion_heatmap(m.events, m.roads), *[f"h{h:02d}" for h in range(24)])


_KPIS = """
SELECT CAST(sum(vehicle_count) AS BIGINT) AS total_vehicles, round_even(avg(average_speed_kmh) * 10, 0) / 10 AS avg_speed,
       count(CASE WHEN congestion_level IN ('HIGH', 'CRITICAL') THEN 1 END) AS congested_count,
       count(DISTINCT road_name) AS road_count
FROM traffic_events e JOIN roads r ON e.road_id = r.road_id"""


@query("network_kpis", _KPIS)
def network_kpis(m):
    return reports.network_kpis(m.named_events)


@query("level_distribution", """
SELECT congestion_level, count(*) AS row_count, count(*) / sum(count(*)) OVER () AS share
FROM traffic_events GROUP BY congestion_level""")
def level_distribution(m):
    return reports.level_distribution(m.events)


@query("volume_by_road_level", """
SELECT road_name, congestion_level, CAST(sum(vehicle_count) AS BIGINT) AS vehicle_count
FROM traffic_events e JOIN roads r ON e.road_id = r.road_id GROUP BY road_name, congestion_level""")
def volume_by_road_level(m):
    return reports.volume_by_road_level(m.events, m.roads)


@query("distinct_values", "SELECT DISTINCT congestion_level FROM traffic_events")
def distinct_values(m):
    return reports.distinct_values(m.events, "congestion_level")


@query("ride_demand", """
SELECT pickup_road_id, CAST(hour("timestamp") AS INT) AS hour, status, count(*) AS requests
FROM ride_requests GROUP BY ALL""")
def ride_demand(m):
    return reports.ride_demand(m.rides)


@query("sensor_health", f"""
SELECT count(*) AS sensors, count(CASE WHEN is_active THEN 1 END) AS active,
       {rounded("avg(CASE WHEN is_active THEN 1e0 ELSE 0e0 END)")} AS active_share,
       count(CASE WHEN sensor_id NOT IN (SELECT sensor_id FROM raw_events {LAST_DAY}) THEN 1 END) AS silent
FROM sensor_locations""")
def health(m):
    return _rounded(sensor_health(m.sensors, m.raw_events, at(AS_OF)), "active_share")


@query("silent_sensors", f"""
SELECT sensor_id, road_id FROM sensor_locations
WHERE sensor_id NOT IN (SELECT sensor_id FROM raw_events {LAST_DAY})""")
def silent(m):
    return silent_sensors(m.sensors, m.raw_events, at(AS_OF)).select("sensor_id", "road_id")
