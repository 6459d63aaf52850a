"""Queries behind a dashboard: latest state, feeds, filters and search."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.traffic import CONGESTED_LEVELS
from .dimensions import DEFAULT_LIMIT, BroadcastLimit, measure, sized, within
from .reports import lookback_filter

LATEST_ROWS, TREND_ROWS = 100, 5000


def latest_per_key(df: DataFrame, key: str, ts: str, tie_break: str, newest: DataFrame | None = None) -> DataFrame:
    """The latest row of each key; of rows at the same instant the one with the greatest `tie_break`.

    Each map task reduces its rows to one per key before the shuffle. That reduction sorts, since whole
    rows have no fixed width; `newest`, the latest instant of each key, lets all but the latest rows be
    dropped first. It must be small enough to broadcast.
    """
    if newest is not None:
        df = df.join(F.broadcast(newest), [key, ts], "left_semi")
    kept = [c for c in df.columns if c != key]
    last = df.groupBy(key).agg(F.max_by(F.struct(*kept), F.struct(ts, tie_break)).alias("last"))
    return last.select(key, "last.*")


def current_status(events: DataFrame, sensors: DataFrame, roads: DataFrame, weather: DataFrame,
                   ts: str = "timestamp", limit: BroadcastLimit = DEFAULT_LIMIT) -> DataFrame:
    """The latest reading of each sensor with its road, position and weather.

    The lookups run on one row per sensor. Of readings at the same instant the greatest event id is taken.
    """
    roads = sized(roads.select("road_id", "road_name"), limit)
    sensors = sensors.select("sensor_id", "latitude", "longitude")
    # Readings on unknown roads may not stand for their sensor.
    known = events.select("sensor_id", "event_id", "road_id", "weather_id", ts, "vehicle_count",
                          "average_speed_kmh", "congestion_index", "congestion_level").join(roads, "road_id", "left_semi")
    newest = None
    if within(measure(sensors), limit):
        # One instant per known sensor, so no larger than the sensors just measured.
        sensors = F.broadcast(sensors)
        newest = known.join(sensors, "sensor_id", "left_semi").groupBy("sensor_id").agg(F.max(ts).alias(ts))
    latest = latest_per_key(known, "sensor_id", ts, "event_id", newest)
    placed = latest.join(roads, "road_id").join(sensors, "sensor_id")
    observed = placed.join(weather.select("weather_id", "weather_condition", "temperature_celsius"), "weather_id", "left")
    return observed.select("sensor_id", "road_name", "latitude", "longitude", ts, "vehicle_count",
                           "average_speed_kmh", "congestion_index", "congestion_level",
                           "weather_condition", "temperature_celsius")


def latest_events(events: DataFrame, roads: DataFrame, weather: DataFrame, rows: int = LATEST_ROWS,
                  ts: str = "timestamp", limit: BroadcastLimit = DEFAULT_LIMIT) -> DataFrame:
    """The newest readings with road and weather. The lookups run on the chosen rows only."""
    roads = sized(roads.select("road_id", "road_name", "speed_limit_kmh", "num_lanes"), limit)
    newest = (events.join(roads, "road_id", "left_semi")
              .orderBy(F.desc(ts), F.desc("event_id")).limit(rows))
    return newest.join(roads, "road_id").join(weather.select("weather_id", "weather_condition"), "weather_id", "left")


def telemetry_feed(latest: DataFrame, ts: str = "timestamp") -> DataFrame:
    return latest.select("road_name", "vehicle_count", "average_speed_kmh", "congestion_level",
                         "weather_condition", ts)


def volume_trend(events: DataFrame, roads: DataFrame, chosen: list[str] | None = None, rows: int = TREND_ROWS,
                 ts: str = "timestamp", limit: BroadcastLimit = DEFAULT_LIMIT) -> DataFrame:
    """The oldest readings in time order, then only those of the chosen roads."""
    roads = sized(roads.select("road_id", "road_name"), limit)
    oldest = (events.join(roads, "road_id", "left_semi").orderBy(ts, "event_id").limit(rows)
              .join(roads, "road_id"))
    trend = oldest.select("event_id", ts, "vehicle_count", "average_speed_kmh", "congestion_index",
                          "hour", "day_of_week", "road_name")
    return trend if chosen is None else filter_roads(trend, chosen)


def volume_trend_by(events: DataFrame, roads: DataFrame, unit: str = "hour", chosen: list[str] | None = None,
                    ts: str = "timestamp") -> DataFrame:
    """The whole history down-sampled to one row per road and hour, day, ..."""
    at = F.date_trunc(unit, ts).cast(events.schema[ts].dataType)
    parts = events.groupBy("road_id", at.alias("period")).agg(F.sum("vehicle_count").alias("vehicles"))
    names = roads.select("road_id", "road_name")
    if chosen is not None:
        names = filter_roads(names, chosen)
    named = parts.join(names, "road_id")
    return named.groupBy("road_name", "period").agg(F.sum("vehicles").alias("vehicle_count"))


def filter_levels(df: DataFrame, levels: list[str]) -> DataFrame:
    return df.where(F.col("congestion_level").isin(*levels))


def critical_nodes(status: DataFrame) -> DataFrame:
    return filter_levels(status, list(CONGESTED_LEVELS))


def filter_roads(df: DataFrame, road_names: list[str]) -> DataFrame:
    return df.where(F.col("road_name").isin(*road_names))


def search_rows(df: DataFrame, term: str) -> DataFrame:
    """Rows where any column, as text, matches the regular expression, upper or lower case.

    A null matches nothing.
    """
    hits = [F.coalesce(F.col(f"`{c}`").cast("string").rlike(f"(?i){term}"), F.lit(False)) for c in df.columns]
    return df.where(reduce(Column.__or__, hits))


def preview_table(tables: dict[str, DataFrame], name: str, rows: int = 1000, key: str | None = None) -> DataFrame:
    """The first rows of a table of the model; by `key` if the page must be the same each time."""
    if name not in tables:
        raise ValueError(f"unknown table {name!r}; choose one of {sorted(tables)}")
    table = tables[name]
    return (table.orderBy(key) if key else table).limit(rows)


def silent_sensors(sensors: DataFrame, events: DataFrame, as_of: dt.datetime | Column, hours: int = 24,
                   ts: str = "timestamp") -> DataFrame:
    """Sensors without a reading in the lookback."""
    heard = lookback_filter(events, as_of, hours, ts).select("sensor_id").distinct()
    return sensors.join(heard, "sensor_id", "left_anti")


def sensor_health(sensors: DataFrame, events: DataFrame, as_of: dt.datetime | Column, hours: int = 24,
                  ts: str = "timestamp") -> DataFrame:
    """One row: sensors, active ones and their share, and sensors silent in the lookback."""
    heard = (lookback_filter(events, as_of, hours, ts).select("sensor_id").distinct()
             .withColumn("__heard", F.lit(True)))
    return sensors.join(heard, "sensor_id", "left").agg(
        F.count(F.lit(1)).alias("sensors"),
        F.count_if(F.col("is_active")).alias("active"),
        F.avg(F.col("is_active").cast("int")).alias("active_share"),
        F.count_if(F.col("__heard").isNull()).alias("silent"))
