"""Derived columns of a reading and the fit to the event table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .. import functions as V
from .asof import asof_weather
from .dimensions import DEFAULT_LIMIT, BroadcastLimit, join_dim
from .quality import MAX_SPEED_KMH, clean_readings

# Fixed values of the traffic model: a road about which nothing is known.
ROAD_DEFAULTS = {"num_lanes": 3, "length_km": 5.0, "speed_limit_kmh": 60}

EVENT_COLUMNS = (
    "event_id", "sensor_id", "road_id", "timestamp", "vehicle_count", "average_speed_kmh",
    "traffic_density", "congestion_index", "congestion_level", "weather_id", "hour", "day_of_week",
    "month", "is_weekend", "is_rush_hour",
)


def with_road_defaults(df: DataFrame) -> DataFrame:
    """Lanes, length and limit where the column is absent or, after an outer join, null."""
    return df.withColumns({
        name: F.coalesce(F.col(name), F.lit(value)) if name in df.columns else F.lit(value)
        for name, value in ROAD_DEFAULTS.items()})


def with_column_defaults(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """Fill columns the rows do not supply; a value may be a Column, such as the load time."""
    filled = {}
    for name, value in defaults.items():
        default = value if isinstance(value, Column) else F.lit(value)
        filled[name] = F.coalesce(F.col(name), default) if name in df.columns else default
    return df.withColumns(filled)


def derive_features(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Normalise the road name, parse the time, and add calendar flags, density, index and level."""
    if "road_name" in df.columns:
        df = df.withColumn("road_name", V.normalize_road_name(F.col("road_name")))
    if dict(df.dtypes)[ts] == "string":
        df = df.withColumn(ts, V.parse_ts(F.col(ts)))
    df = with_road_defaults(df.withColumns(V.time_features(F.col(ts))))
    measured = df.withColumns({
        "traffic_density": V.traffic_density(F.col("vehicle_count"), F.col("length_km"), F.col("num_lanes")),
        "congestion_index": V.congestion_index(F.col("average_speed_kmh"), F.col("speed_limit_kmh")),
    })
    # A step of its own, so that the index is computed once and not again for each bound.
    return measured.withColumn("congestion_level", V.congestion_level(F.col("congestion_index")))


def clean_and_derive(df: DataFrame, max_speed: float | None = MAX_SPEED_KMH) -> DataFrame:
    """Raw readings to clean, enriched readings."""
    return df.transform(clean_readings, max_speed).transform(derive_features)


def conform_events(readings: DataFrame, sensors: DataFrame, roads: DataFrame, weather: DataFrame, *,
                   ts: str = "timestamp", weather_ts: str = "timestamp", bucket_seconds: int | None = None,
                   limit: BroadcastLimit = DEFAULT_LIMIT, prune: bool = False) -> DataFrame:
    """Fit raw readings to the event table; `ts` names their event time.

    Adds the road of the sensor, what the road's size and limit imply, and the weather id as of the
    reading, and leaves out every column the table does not have. Readings of unknown sensors or
    roads are left out, since the table could not hold them; `check_references` lists them. `prune` is that of
    `asof_join`.
    """
    own = [c for c in ("event_id", "sensor_id", "vehicle_count", "average_speed_kmh") if c in readings.columns]
    placed = join_dim(readings.select(*own, F.col(ts).alias("timestamp")),
                      sensors.select("sensor_id", "road_id"), "sensor_id", limit=limit)
    placed = join_dim(placed, roads.select("road_id", *ROAD_DEFAULTS), "road_id", limit=limit)
    timed = asof_weather(derive_features(placed), weather.select("weather_id", F.col(weather_ts).alias("timestamp")),
                         bucket_seconds=bucket_seconds, limit=limit, prune=prune)
    return timed.select(*[c for c in EVENT_COLUMNS if c in timed.columns])
