"""Queries that write a table to the shared folder and read it back."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from ..operators.reports import lookback_filter
from ..schemas import HISTORY_FILES
from ..session import shared_path
from ..sinks import export_csv, merge_date_partitioned, write_date_partitioned, write_parquet
from ..sources import load_reference_dimensions, read_csv, read_events_with_fallback, read_parquet
from .catalog import query
from .model import at
from .reports import AS_OF, LAST_DAY

EVENT_SQL = 'event_id, sensor_id, road_id, "timestamp", vehicle_count, average_speed_kmh, weather_id, event_type'


@query("write_parquet", f"SELECT {EVENT_SQL} FROM raw_events")
def parquet_round_trip(m):
    path = shared_path(m.spark, "parquet")
    write_parquet(m.raw_events, path)
    return read_parquet(m.spark, path, m.raw_events.schema)


@query("write_date_partitioned", f"""
SELECT {EVENT_SQL}, CAST(year("timestamp") AS INT) AS year, CAST(month("timestamp") AS INT) AS month,
       CAST(day("timestamp") AS INT) AS day FROM raw_events""")
def date_partitions(m):
    path = shared_path(m.spark, "by-date")
    write_date_partitioned(m.raw_events, path)
    return m.spark.read.parquet(path)


@query("merge_date_partitioned", f"""
SELECT {EVENT_SQL} FROM raw_events WHERE event_id % 5 <> 0
UNION ALL SELECT event_id, sensor_id, road_id, "timestamp", vehicle_count + 1, average_speed_kmh, weather_id, event_type
FROM raw_events WHERE event_id % 5 = 0""")
def merged_dates(m):
    """Readings that are late, and corrections of readings that are there; merged twice."""
    path = shared_path(m.spark, "merged")
    write_date_partitioned(m.raw_events.where("event_id % 10 <> 0"), path)
    late = m.raw_events.where("event_id % 5 = 0").withColumn("vehicle_count", F.col("vehicle_count") + 1)
    for _ in range(2):
        merge_date_partitioned(late, path, ("event_id", "timestamp"))
    return m.spark.read.parquet(path).drop("year", "month", "day")


@query("lookback_over_date_partitions", f"SELECT {EVENT_SQL} FROM raw_events {LAST_DAY}")
def pruned_lookback(m):
    path = shared_path(m.spark, "by-date")
    write_date_partitioned(m.raw_events, path)
    recent = lookback_filter(m.spark.read.parquet(path), at(AS_OF), date_partitioned=True)
    return recent.drop("year", "month", "day")


@query("export_csv", f"SELECT {EVENT_SQL} FROM raw_events")
def csv_round_trip(m):
    path = shared_path(m.spark, "csv")
    export_csv(m.raw_events, path)
    return read_csv(m.spark, path, m.raw_events.schema)


@query("read_events_with_fallback", f"SELECT {EVENT_SQL}, 'csv' AS came_from FROM raw_events "
       f"UNION ALL SELECT {EVENT_SQL}, 'lake' FROM raw_events WHERE average_speed_kmh > 50")
def fallback(m):
    """The CSV while there is no lake, and the lake once there is one."""
    path = shared_path(m.spark, "fallback")
    schema = m.raw_events.schema
    export_csv(m.raw_events, f"{path}/events.csv")
    first = read_events_with_fallback(m.spark, f"{path}/lake", f"{path}/events.csv", schema, schema)
    write_parquet(first.where("average_speed_kmh > 50"), f"{path}/lake")
    second = read_events_with_fallback(m.spark, f"{path}/lake", f"{path}/events.csv", schema, schema)
    return first.withColumn("came_from", F.lit("csv")).unionAll(second.withColumn("came_from", F.lit("lake")))


@query("load_reference_dimensions", """
SELECT 'roads' AS table_name, CAST(road_id AS VARCHAR) AS key, road_name AS detail FROM roads
UNION ALL SELECT 'sensor_locations', sensor_id, CAST(installation_date AS VARCHAR) FROM sensor_locations
UNION ALL SELECT 'weather_data', CAST(weather_id AS VARCHAR), weather_condition FROM weather_data
UNION ALL SELECT 'traffic_events', sensor_id || '/' || CAST(vehicle_count AS VARCHAR), congestion_level FROM traffic_events
UNION ALL SELECT 'ride_requests', CAST(pickup_road_id AS VARCHAR), status FROM ride_requests""")
def history_files(m):
    folder = shared_path(m.spark, "history")
    zoned = F.col("timestamp").cast("timestamp")
    written = {
        "roads": m.roads, "sensor_locations": m.sensors,
        "weather_data": m.weather.withColumns({"timestamp": zoned, "city": F.lit("Cairo")}),
        "traffic_events": m.events.withColumn("timestamp", zoned), "ride_requests": m.rides.withColumn("timestamp", zoned)}
    for name, (file_name, schema) in HISTORY_FILES.items():
        rows = written[name]
        export_csv(rows.select(*[(F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                                 for f in schema.fields]), f"{folder}/{file_name}")
    tables = load_reference_dimensions(m.spark, folder, required=tuple(HISTORY_FILES))
    details = {"roads": (F.col("road_id").cast("string"), "road_name"), "sensor_locations": (F.col("sensor_id"), "installation_date"),
               "weather_data": (F.col("weather_id").cast("string"), "weather_condition"),
               "traffic_events": (F.concat_ws("/", "sensor_id", "vehicle_count"), "congestion_level"),
               "ride_requests": (F.col("pickup_road_id").cast("string"), "status")}
    parts = [tables[name].select(F.lit(name).alias("table_name"), key.alias("key"), F.col(detail).cast("string").alias("detail"))
             for name, (key, detail) in details.items()]
    return reduce(DataFrame.unionAll, parts)
