"""The traffic model over the provided tables.

Roads come from `nation`, sensors, weather and readings from `events`, rides from `orders`. Every
table is defined twice, as a DataFrame and as SQL, row for row the same. Speeds are whole numbers,
several sensors share a road, and weather exists for every third hour only.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .. import functions as V
from ..operators.dimensions import join_dim, sized
from ..operators.features import ROAD_DEFAULTS, derive_features
from ..session import shared_dir

# Schemas of the provided files, so that opening one needs no job to look into it.
PROVIDED = {
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
}
HOURS_PER_DAY = 24


def ntz(column: Column) -> Column:
    """Event times in the provided files have no zone; keep results that way."""
    return column.cast("timestamp_ntz")


def at(text: str) -> Column:
    """A literal event time, so that a filter on it reaches the Parquet scan."""
    return F.to_timestamp_ntz(F.lit(text))


class TrafficModel:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def read(self, table: str) -> DataFrame:
        return self.spark.read.schema(PROVIDED[table]).parquet(f"{self.sf_dir}/{table}.parquet")

    @cached_property
    def roads(self) -> DataFrame:
        key = F.col("n_nationkey")
        limit = 50 + 10 * (key % 6)
        return self.read("nation").select(
            (key + 1).cast("int").alias("road_id"), F.col("n_name").alias("road_name"),
            V.road_type(limit).alias("road_type"), (2 + key % 13).cast("double").alias("length_km"),
            (2 + key % 3).cast("int").alias("num_lanes"), limit.cast("int").alias("speed_limit_kmh"),
            F.lit("Cairo").alias("city"))

    def _computed_once(self, dimension: DataFrame) -> DataFrame:
        """A dimension made from all events, computed here and then read by every join and size check of a query."""
        shared_dir(self.spark)
        return dimension.checkpoint()

    @cached_property
    def sensors(self) -> DataFrame:
        user = F.col("user_id")
        return self._computed_once(self.read("events").select("user_id").distinct().select(
            _sensor_id().alias("sensor_id"), _road_id().alias("road_id"),
            _latitude().alias("latitude"), _longitude().alias("longitude"),
            F.date_add(F.lit("2023-01-01").cast("date"), (user % 365).cast("int")).alias("installation_date"),
            (user % 7 != 0).alias("is_active")))

    @cached_property
    def weather(self) -> DataFrame:
        hourly = (self.read("events").where(F.hour("ts") % 3 == 0)
                  .groupBy(ntz(F.date_trunc("hour", "ts")).alias("timestamp")).agg(F.min("event_id").alias("k")))
        k = F.col("k")
        observed = hourly.select(
            _hour_number("timestamp").alias("weather_id"), "timestamp",
            (10 + (k * 7) % 32).cast("double").alias("temperature_celsius"),
            (35 + k % 45).cast("double").alias("humidity_percent"),
            F.when(k % 10 == 0, 8.0).when(k % 10 == 1, 2.5).otherwise(0.0).alias("rain_mm"),
            (5 + (k * 11) % 30).cast("double").alias("wind_speed_kmh"))
        return self._computed_once(observed.withColumn("weather_condition", V.classify_weather(
            F.col("rain_mm"), F.col("humidity_percent"), F.col("temperature_celsius"), F.col("wind_speed_kmh"))))

    @cached_property
    def raw_events(self) -> DataFrame:
        """Readings with their sensor and road, before anything is derived.

        Of the weather ids, some are null and some name an hour without weather.
        """
        return self.read("events").select(
            "event_id", _sensor_id().alias("sensor_id"), _road_id().alias("road_id"),
            F.col("ts").alias("timestamp"), F.floor(F.col("value") * 5).cast("int").alias("vehicle_count"),
            (10 + (F.col("event_id") * 37) % 90).cast("double").alias("average_speed_kmh"),
            F.when(F.hour("ts") % 3 != 1, _hour_number("ts")).alias("weather_id"), "event_type")

    @cached_property
    def placed_events(self) -> DataFrame:
        """Readings with the road's name, size and limit, before anything is derived."""
        return join_dim(self.raw_events, self.roads, "road_id")

    @cached_property
    def events(self) -> DataFrame:
        """The event table: readings with all derived columns."""
        placed = join_dim(self.raw_events, self.roads.select("road_id", *ROAD_DEFAULTS), "road_id")
        return derive_features(placed).drop(*ROAD_DEFAULTS)

    @cached_property
    def named_events(self) -> DataFrame:
        return self.events.join(sized(self.roads.select("road_id", "road_name")), "road_id")

    @cached_property
    def readings(self) -> DataFrame:
        """Readings as a sensor sends them: untidy names, bad values, missing ids and copies."""
        n = F.col("event_id")
        repeats = F.when(n % 29 == 0, 2).otherwise(1)
        return self.read("events").select(
            "event_id", F.when(n % 23 != 0, _sensor_id()).alias("sensor_id"),
            F.concat(F.lit("  nation_"), (F.col("user_id") % 25).cast("string"), F.lit("   ring-road ")).alias("road_name"),
            F.when(n % 19 == 0, 100.0).otherwise(_latitude()).alias("latitude"), _longitude().alias("longitude"),
            F.when(n % 37 == 0, -1).otherwise(F.floor(F.col("value") * 5)).cast("int").alias("vehicle_count"),
            F.when(n % 17 == 0, 250).when(n % 31 == 0, -5).otherwise(10 + (n * 37) % 90)
            .cast("double").alias("average_speed_kmh"),
            F.col("ts").alias("timestamp"), "event_type", F.explode(F.sequence(F.lit(1), repeats)).alias("copy")).drop("copy")

    @cached_property
    def messages(self) -> DataFrame:
        """The readings as JSON text, some of them malformed or with a field of the wrong type."""
        n = F.col("event_id")
        fields = F.struct("sensor_id", "road_name", "latitude", "longitude", "vehicle_count",
                          "average_speed_kmh",
                          F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("timestamp"))
        body = F.to_json(fields)
        mistyped = F.regexp_replace(body, '"vehicle_count":-?[0-9]+', '"vehicle_count":"many"')
        text = F.when(n % 41 == 0, F.concat(F.lit("no json "), n.cast("string"))).when(n % 43 == 0, mistyped).otherwise(body)
        zoned = self.readings.withColumn("timestamp", F.col("timestamp").cast("timestamp"))
        return zoned.select(text.alias("value"))

    @cached_property
    def rides(self) -> DataFrame:
        order = F.col("o_orderkey")
        km, minutes = (1 + order % 30).cast("double"), (2 + order % 45).cast("double")
        status = F.when(F.col("o_orderstatus") == "F", "COMPLETED").when(F.col("o_orderstatus") == "O", "CANCELLED")
        charged = V.ride_fare(km, minutes) + F.when(order % 7 == 0, 5.0).otherwise(0.0)
        return self.read("orders").select(
            order.alias("request_id"), F.col("o_orderdate").alias("timestamp"),
            (F.col("o_custkey") % 25 + 1).cast("int").alias("pickup_road_id"), km.alias("distance_km"),
            minutes.alias("duration_minutes"), charged.alias("fare_amount"),
            status.otherwise("NO_SHOW").alias("status"))


def _sensor_id() -> Column:
    return F.concat(F.lit("SENSOR_"), F.col("user_id").cast("string"))


def _road_id() -> Column:
    return (F.col("user_id") % 25 + 1).cast("int")


def _latitude() -> Column:
    return F.lit(29.9) + (F.col("user_id") % 21) * F.lit(0.01)


def _longitude() -> Column:
    return F.lit(31.1) + (F.col("user_id") % 31) * F.lit(0.01)


def _hour_number(ts: str) -> Column:
    """Hours since 1970."""
    return F.unix_date(F.to_date(ts)).cast("long") * HOURS_PER_DAY + F.hour(ts)


TABLE_SQL = """
roads AS (
  SELECT CAST(n_nationkey + 1 AS INT) AS road_id, n_name AS road_name,
         CASE WHEN n_nationkey % 6 <= 1 THEN 'Urban' ELSE 'Highway' END AS road_type,
         CAST(2 + n_nationkey % 13 AS DOUBLE) AS length_km, CAST(2 + n_nationkey % 3 AS INT) AS num_lanes,
         CAST(50 + 10 * (n_nationkey % 6) AS INT) AS speed_limit_kmh, 'Cairo' AS city
  FROM nation),
sensor_locations AS (
  SELECT DISTINCT concat('SENSOR_', CAST(user_id AS VARCHAR)) AS sensor_id, CAST(user_id % 25 + 1 AS INT) AS road_id,
         29.9e0 + (user_id % 21) * 0.01e0 AS latitude, 31.1e0 + (user_id % 31) * 0.01e0 AS longitude,
         DATE '2023-01-01' + CAST(user_id % 365 AS INT) AS installation_date, user_id % 7 <> 0 AS is_active
  FROM events),
weather_hours AS (
  SELECT date_trunc('hour', ts) AS "timestamp", min(event_id) AS k
  FROM events WHERE hour(ts) % 3 = 0 GROUP BY date_trunc('hour', ts)),
weather_plain AS (
  SELECT CAST(date_diff('day', DATE '1970-01-01', CAST("timestamp" AS DATE)) * 24 + hour("timestamp") AS BIGINT) AS weather_id,
         "timestamp", CAST(10 + (k * 7) % 32 AS DOUBLE) AS temperature_celsius,
         CAST(35 + k % 45 AS DOUBLE) AS humidity_percent,
         CASE WHEN k % 10 = 0 THEN 8e0 WHEN k % 10 = 1 THEN 2.5e0 ELSE 0e0 END AS rain_mm,
         CAST(5 + (k * 11) % 30 AS DOUBLE) AS wind_speed_kmh
  FROM weather_hours),
weather_data AS (
  SELECT *, CASE WHEN rain_mm > 5 THEN 'Rainy' WHEN rain_mm > 0 THEN 'Drizzle'
                 WHEN humidity_percent > 75 AND temperature_celsius < 18 THEN 'Foggy'
                 WHEN wind_speed_kmh > 25 AND temperature_celsius > 35 THEN 'Sandstorm'
                 ELSE 'Sunny' END AS weather_condition
  FROM weather_plain),
raw_events AS (
  SELECT event_id, concat('SENSOR_', CAST(user_id AS VARCHAR)) AS sensor_id, CAST(user_id % 25 + 1 AS INT) AS road_id,
         ts AS "timestamp", CAST(floor(value * 5) AS INT) AS vehicle_count,
         CAST(10 + (event_id * 37) % 90 AS DOUBLE) AS average_speed_kmh,
         CASE WHEN hour(ts) % 3 <> 1
              THEN CAST(date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) * 24 + hour(ts) AS BIGINT) END AS weather_id,
         event_type
  FROM events),
measured_events AS (
  SELECT e.*, CAST(hour("timestamp") AS INT) AS hour, CAST(isodow("timestamp") - 1 AS INT) AS day_of_week,
         CAST(month("timestamp") AS INT) AS month,
         vehicle_count / (length_km * num_lanes) AS traffic_density,
         CASE WHEN average_speed_kmh >= speed_limit_kmh THEN 0e0
              ELSE 1e0 - average_speed_kmh / speed_limit_kmh END AS congestion_index
  FROM raw_events e JOIN roads r ON e.road_id = r.road_id),
traffic_events AS (
  SELECT event_id, sensor_id, road_id, "timestamp", vehicle_count, average_speed_kmh, weather_id, event_type,
         hour, day_of_week, month, day_of_week IN (4, 5) AS is_weekend,
         (hour BETWEEN 7 AND 9 OR hour BETWEEN 17 AND 19) AS is_rush_hour, traffic_density, congestion_index,
         CASE WHEN congestion_index < 0.25 THEN 'LOW' WHEN congestion_index < 0.5 THEN 'MEDIUM'
              WHEN congestion_index < 0.75 THEN 'HIGH' ELSE 'CRITICAL' END AS congestion_level
  FROM measured_events),
readings AS (
  SELECT event_id, CASE WHEN event_id % 23 <> 0 THEN concat('SENSOR_', CAST(user_id AS VARCHAR)) END AS sensor_id,
         concat('  nation_', CAST(user_id % 25 AS VARCHAR), '   ring-road ') AS road_name,
         CASE WHEN event_id % 19 = 0 THEN 100e0 ELSE 29.9e0 + (user_id % 21) * 0.01e0 END AS latitude,
         31.1e0 + (user_id % 31) * 0.01e0 AS longitude,
         CAST(CASE WHEN event_id % 37 = 0 THEN -1 ELSE floor(value * 5) END AS INT) AS vehicle_count,
         CAST(CASE WHEN event_id % 17 = 0 THEN 250 WHEN event_id % 31 = 0 THEN -5
                   ELSE 10 + (event_id * 37) % 90 END AS DOUBLE) AS average_speed_kmh,
         ts AS "timestamp", event_type
  FROM events, LATERAL (SELECT unnest(range(CASE WHEN event_id % 29 = 0 THEN 2 ELSE 1 END)))),
ride_requests AS (
  SELECT o_orderkey AS request_id, o_orderdate AS "timestamp", CAST(o_custkey % 25 + 1 AS INT) AS pickup_road_id,
         CAST(1 + o_orderkey % 30 AS DOUBLE) AS distance_km, CAST(2 + o_orderkey % 45 AS DOUBLE) AS duration_minutes,
         15e0 + (1 + o_orderkey % 30) * 7.5e0 + (2 + o_orderkey % 45) * 1.5e0
           + CASE WHEN o_orderkey % 7 = 0 THEN 5e0 ELSE 0e0 END AS fare_amount,
         CASE o_orderstatus WHEN 'F' THEN 'COMPLETED' WHEN 'O' THEN 'CANCELLED' ELSE 'NO_SHOW' END AS status
  FROM orders)
"""
