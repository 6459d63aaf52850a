"""Fixed schemas of the traffic model.

Surrogate ids are 64-bit: a 32-bit serial would overflow on large event tables.
Event times are `timestamp` (an instant) in files and streams.
"""

from __future__ import annotations

from pyspark.sql import types as T

_STRING, _INT, _LONG = T.StringType(), T.IntegerType(), T.LongType()
_DOUBLE, _BOOL, _DATE, _TS = T.DoubleType(), T.BooleanType(), T.DateType(), T.TimestampType()


def _struct(*fields: tuple) -> T.StructType:
    """(name, type) is nullable; (name, type, False) is NOT NULL."""
    return T.StructType([T.StructField(f[0], f[1], f[2] if len(f) > 2 else True) for f in fields])


# One sensor message as it arrives in JSON; the event time is still text.
READING = _struct(
    ("sensor_id", _STRING), ("road_name", _STRING), ("latitude", _DOUBLE), ("longitude", _DOUBLE),
    ("vehicle_count", _INT), ("average_speed_kmh", _DOUBLE), ("traffic_density", _DOUBLE),
    ("congestion_index", _DOUBLE), ("congestion_level", _STRING), ("weather_condition", _STRING),
    ("temperature", _DOUBLE), ("humidity", _DOUBLE), ("rain_mm", _DOUBLE), ("wind_speed_kmh", _DOUBLE),
    ("timestamp", _STRING), ("hour", _INT), ("day_of_week", _INT), ("month", _INT),
    ("is_weekend", _BOOL), ("is_rush_hour", _BOOL),
)

WEATHER_MESSAGE = _struct(
    ("timestamp", _STRING), ("temperature_celsius", _DOUBLE), ("humidity_percent", _DOUBLE),
    ("rain_mm", _DOUBLE), ("wind_speed_kmh", _DOUBLE), ("weather_condition", _STRING), ("city", _STRING),
)

ROADS = _struct(
    ("road_id", _INT, False), ("road_name", _STRING, False), ("road_type", _STRING),
    ("length_km", _DOUBLE, False), ("num_lanes", _INT, False), ("speed_limit_kmh", _INT, False),
    ("city", _STRING), ("created_at", _TS),
)

SENSOR_LOCATIONS = _struct(
    ("sensor_id", _STRING, False), ("road_id", _INT), ("latitude", _DOUBLE, False),
    ("longitude", _DOUBLE, False), ("installation_date", _DATE), ("is_active", _BOOL), ("created_at", _TS),
)

WEATHER_DATA = _struct(
    ("weather_id", _LONG, False), ("timestamp", _TS, False), ("temperature_celsius", _DOUBLE, False),
    ("humidity_percent", _DOUBLE, False), ("rain_mm", _DOUBLE, False), ("wind_speed_kmh", _DOUBLE, False),
    ("weather_condition", _STRING, False), ("city", _STRING), ("created_at", _TS),
)

TRAFFIC_EVENTS = _struct(
    ("event_id", _LONG, False), ("sensor_id", _STRING), ("road_id", _INT), ("timestamp", _TS, False),
    ("vehicle_count", _INT, False), ("average_speed_kmh", _DOUBLE, False),
    ("traffic_density", _DOUBLE, False), ("congestion_index", _DOUBLE, False),
    ("congestion_level", _STRING, False), ("weather_id", _LONG), ("hour", _INT, False),
    ("day_of_week", _INT, False), ("month", _INT, False), ("is_weekend", _BOOL, False),
    ("is_rush_hour", _BOOL, False), ("created_at", _TS),
)

RIDE_REQUESTS = _struct(
    ("request_id", _LONG, False), ("timestamp", _TS, False), ("pickup_latitude", _DOUBLE, False),
    ("pickup_longitude", _DOUBLE, False), ("dropoff_latitude", _DOUBLE, False),
    ("dropoff_longitude", _DOUBLE, False), ("pickup_road_id", _INT), ("distance_km", _DOUBLE, False),
    ("duration_minutes", _DOUBLE, False), ("fare_amount", _DOUBLE, False), ("status", _STRING, False),
    ("created_at", _TS),
)

PREDICTIONS = _struct(
    ("prediction_id", _LONG, False), ("model_name", _STRING, False), ("prediction_type", _STRING, False),
    ("road_id", _INT), ("sensor_id", _STRING), ("predicted_at", _TS, False),
    ("prediction_horizon_minutes", _INT, False), ("predicted_vehicle_count", _INT),
    ("predicted_congestion_level", _STRING), ("predicted_avg_speed", _DOUBLE),
    ("confidence_score", _DOUBLE), ("actual_vehicle_count", _INT), ("actual_congestion_level", _STRING),
    ("rmse", _DOUBLE), ("created_at", _TS),
)

BATCH_REPORTS = _struct(
    ("report_id", _LONG, False), ("report_type", _STRING, False), ("report_date", _DATE, False),
    ("road_id", _INT), ("avg_speed", _DOUBLE, False), ("total_vehicles", _LONG, False),
    ("peak_hour", _INT, False), ("congestion_hours", _LONG, False), ("congestion_score", _DOUBLE, False),
    ("created_at", _TS),
)

TABLES = {
    "roads": ROADS,
    "sensor_locations": SENSOR_LOCATIONS,
    "weather_data": WEATHER_DATA,
    "traffic_events": TRAFFIC_EVENTS,
    "ride_requests": RIDE_REQUESTS,
    "predictions": PREDICTIONS,
    "batch_reports": BATCH_REPORTS,
}

# Key of each table and the columns that point at another table's key.
KEYS = {
    "roads": "road_id",
    "sensor_locations": "sensor_id",
    "weather_data": "weather_id",
    "traffic_events": "event_id",
    "ride_requests": "request_id",
    "predictions": "prediction_id",
    "batch_reports": "report_id",
}

REFERENCES = {
    "sensor_locations": {"road_id": "roads"},
    "traffic_events": {"sensor_id": "sensor_locations", "road_id": "roads", "weather_id": "weather_data"},
    "ride_requests": {"pickup_road_id": "roads"},
    "predictions": {"road_id": "roads", "sensor_id": "sensor_locations"},
    "batch_reports": {"road_id": "roads"},
}


def required_columns(schema: T.StructType) -> list[str]:
    return [field.name for field in schema.fields if not field.nullable]


def without(schema: T.StructType, *names: str) -> T.StructType:
    """The schema less some columns, such as ids and load times that a CSV does not carry."""
    return T.StructType([field for field in schema.fields if field.name not in names])


# What the history files hold: the tables less the columns the store itself fills in.
HISTORY_FILES = {
    "roads": ("historical_roads.csv", without(ROADS, "created_at")),
    "sensor_locations": ("historical_sensors.csv", without(SENSOR_LOCATIONS, "created_at")),
    "weather_data": ("historical_weather.csv", without(WEATHER_DATA, "created_at")),
    "traffic_events": ("historical_traffic.csv", without(TRAFFIC_EVENTS, "event_id", "created_at")),
    "ride_requests": ("historical_ride_requests.csv", without(RIDE_REQUESTS, "request_id", "created_at")),
}
