"""The joins of the traffic model."""

from __future__ import annotations

from pyspark.sql import DataFrame

from .dimensions import DEFAULT_LIMIT, BroadcastLimit, join_dim


def join_roads(facts: DataFrame, roads: DataFrame, limit: BroadcastLimit = DEFAULT_LIMIT) -> DataFrame:
    return join_dim(facts, roads, "road_id", "inner", limit)


def join_sensors(facts: DataFrame, sensors: DataFrame, limit: BroadcastLimit = DEFAULT_LIMIT) -> DataFrame:
    """Attach a sensor's attributes; those the facts already carry (its road) stay the facts' own."""
    extra = [c for c in sensors.columns if c == "sensor_id" or c not in facts.columns]
    return join_dim(facts, sensors.select(*extra), "sensor_id", "inner", limit)


def join_weather_left(facts: DataFrame, weather: DataFrame, limit: BroadcastLimit = DEFAULT_LIMIT) -> DataFrame:
    """Attach weather by id and keep readings that have none; clashing names get `_weather`."""
    return join_dim(facts, _suffixed(facts, weather), "weather_id", "left", limit)


def join_weather_inner(facts: DataFrame, weather: DataFrame, limit: BroadcastLimit = DEFAULT_LIMIT) -> DataFrame:
    return join_dim(facts, _suffixed(facts, weather), "weather_id", "inner", limit)


def join_stats_peak(stats: DataFrame, peak: DataFrame) -> DataFrame:
    """Two aggregates per road, already one row per road each, so a plain equi-join."""
    return stats.join(peak, "road_id")


def _suffixed(facts: DataFrame, weather: DataFrame) -> DataFrame:
    clashes = [c for c in weather.columns if c in facts.columns and c != "weather_id"]
    return weather.withColumnsRenamed({c: f"{c}_weather" for c in clashes})
