"""Queries for message parsing and streams.

Those named `stream_*` start a real stream over the event files, let it run dry, and read back what
it wrote to the shared folder.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from ..functions import round_numeric
from ..operators.quality import CORRUPT, quarantine
from ..schemas import WEATHER_MESSAGE
from ..session import shared_path
from ..jobs import register_views
from ..sinks import latest_rows_batches, parquet_micro_batch, read_latest_rows, sink_micro_batch, sink_raw_parquet
from ..streaming import (clean_stream, conformed_batches, dedupe_closed, dedupe_stream, join_weather_streams,
                         parse_messages, parse_readings, run_stream,
                         windowed_metrics, with_event_time)
from ..streaming.readings import EVENT_TIME
from .catalog import ORACLES, query, rounded
from . import serving  # noqa: F401  its SQL is used again
from .model import PROVIDED, TrafficModel, ntz

MESSAGE_COLUMNS = ("sensor_id", "vehicle_count", "average_speed_kmh", "latitude", "event_ts")


def _times_without_zone(df: DataFrame) -> DataFrame:
    return df.withColumn("event_ts", ntz(F.col(EVENT_TIME)))


@query("parse_readings", """
SELECT CASE WHEN event_id % 41 <> 0 THEN sensor_id END AS sensor_id,
       CASE WHEN event_id % 41 <> 0 AND event_id % 43 <> 0 THEN vehicle_count END AS vehicle_count,
       CASE WHEN event_id % 41 <> 0 THEN average_speed_kmh END AS average_speed_kmh,
       CASE WHEN event_id % 41 <> 0 THEN latitude END AS latitude,
       CASE WHEN event_id % 41 <> 0 THEN "timestamp" END AS event_ts,
       event_id % 41 = 0 OR event_id % 43 = 0 AS is_corrupt
FROM readings""")
def parse(m):
    return _times_without_zone(parse_readings(m.messages)).select(
        *MESSAGE_COLUMNS, F.col(CORRUPT).isNotNull().alias("is_corrupt"))


_CLEAN_MESSAGES = """
SELECT sensor_id, vehicle_count, average_speed_kmh, latitude, "timestamp" AS event_ts FROM readings
WHERE event_id % 41 <> 0 AND event_id % 43 <> 0 AND sensor_id IS NOT NULL AND latitude BETWEEN -90 AND 90
  AND vehicle_count >= 0 AND average_speed_kmh >= 0"""


@query("parse_weather_messages", """
SELECT "timestamp" AS event_ts, temperature_celsius, humidity_percent, rain_mm, wind_speed_kmh, weather_condition
FROM weather_data""")
def parse_weather(m):
    measures = ("temperature_celsius", "humidity_percent", "rain_mm", "wind_speed_kmh", "weather_condition")
    sent_at = F.date_format(F.col("timestamp").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
    sent = m.weather.select(F.to_json(F.struct(sent_at.alias("timestamp"), *measures)).alias("value"))
    parsed = parse_messages(sent, WEATHER_MESSAGE).transform(with_event_time)
    return _times_without_zone(parsed).select("event_ts", *measures)


@query("clean_stream", """
SELECT sensor_id, vehicle_count, average_speed_kmh, latitude, "timestamp" AS event_ts FROM readings
WHERE event_id % 41 <> 0 AND event_id % 43 <> 0 AND latitude BETWEEN -90 AND 90
  AND vehicle_count >= 0 AND average_speed_kmh >= 0""")
def clean(m):
    return _times_without_zone(clean_stream(parse_readings(m.messages))).select(*MESSAGE_COLUMNS)


@query("quarantine_messages", """
SELECT CASE WHEN event_id % 41 = 0 OR event_id % 43 = 0 THEN 'malformed JSON' WHEN sensor_id IS NULL THEN 'missing core field'
            WHEN latitude > 90 THEN 'coordinates out of range' ELSE 'count or speed out of range' END AS error,
       count(*) AS messages
FROM readings
WHERE event_id % 41 = 0 OR event_id % 43 = 0 OR sensor_id IS NULL OR latitude > 90 OR vehicle_count < 0
   OR average_speed_kmh < 0
GROUP BY 1""")
def quarantine_messages(m):
    _, bad = quarantine(parse_readings(m.messages))
    return bad.groupBy("error").agg(F.count("original_payload").alias("messages"))


@query("dedupe_stream", """
SELECT DISTINCT sensor_id, "timestamp" AS event_ts FROM readings WHERE sensor_id IS NOT NULL""")
def dedupe(m):
    return dedupe_stream(m.readings.where("sensor_id IS NOT NULL"), ("sensor_id", "timestamp")).select(
        "sensor_id", F.col("timestamp").alias("event_ts"))


_WINDOWS = f"""
SELECT window_start, window_start + INTERVAL 5 MINUTE AS window_end, road_id,
       {rounded("avg(vehicle_count)")} AS avg_vehicle_count, {rounded("avg(average_speed_kmh)")} AS avg_speed_kmh,
       {rounded("avg(congestion_index)")} AS avg_congestion_index
FROM (SELECT *, date_trunc('minute', "timestamp") - to_minutes(unnest(range(5))) AS window_start FROM traffic_events)
GROUP BY window_start, road_id"""


def _tidy_windows(df: DataFrame) -> DataFrame:
    means = ("avg_vehicle_count", "avg_speed_kmh", "avg_congestion_index")
    return df.select(ntz(F.col("window_start")).alias("window_start"), ntz(F.col("window_end")).alias("window_end"),
                     "road_id", *[round_numeric(F.col(c), 6).alias(c) for c in means])


@query("windowed_metrics", _WINDOWS)
def windows(m):
    return _tidy_windows(windowed_metrics(m.events, "timestamp", by="road_id"))


def _streamed_events(m: TrafficModel) -> DataFrame:
    """The same readings as a stream; a watermark needs an instant, not a time without zone."""
    streamed = TrafficModel(m.spark, m.sf_dir)
    streamed.read = lambda table: (
        m.spark.readStream.schema(PROVIDED[table]).parquet(f"{m.sf_dir}/{table}.parquet*")
        if table == "events" else m.read(table))
    return streamed.events.withColumn("timestamp", F.col("timestamp").cast("timestamp"))


def _run_dry(m: TrafficModel, stream: DataFrame, name: str, **options) -> DataFrame:
    path = shared_path(m.spark, name)
    running = sink_raw_parquet(stream, f"{path}/data", f"{path}/checkpoint", availableNow=True, **options)
    running.awaitTermination()
    return m.spark.read.parquet(f"{path}/data")


@query("stream_windowed_metrics", f"""
SELECT * FROM ({_WINDOWS}) WHERE window_end <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE""")
def stream_windows(m):
    metrics = windowed_metrics(_streamed_events(m), "timestamp", by="road_id")
    return _tidy_windows(_run_dry(m, metrics, "windows", partition_by=()))


@query("sink_raw_parquet", """
SELECT event_id, sensor_id, vehicle_count, average_speed_kmh, "timestamp" AS event_ts, month, hour FROM traffic_events""")
def raw_sink(m):
    landed = _run_dry(m, _streamed_events(m), "raw")
    return landed.select("event_id", "sensor_id", "vehicle_count", "average_speed_kmh",
                         ntz(F.col("timestamp")).alias("event_ts"), "month", "hour")


@query("stream_dedupe", """SELECT DISTINCT sensor_id, "timestamp" AS event_ts FROM traffic_events""")
def stream_dedupe(m):
    twice = _streamed_events(m).withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("copy")
    landed = _run_dry(m, dedupe_stream(twice, ("sensor_id", "timestamp"), "timestamp"), "deduped")
    return landed.select("sensor_id", ntz(F.col("timestamp")).alias("event_ts"))


@query("stream_dedupe_closed", """
SELECT sensor_id, "timestamp" AS event_ts, min(event_id) AS event_id FROM traffic_events
WHERE "timestamp" <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE GROUP BY sensor_id, "timestamp" """)
def stream_dedupe_closed(m):
    """A third of the rows are copies of readings of one sensor."""
    copies = F.when(F.col("sensor_id") == "SENSOR_1", 50).otherwise(2)
    flood = _streamed_events(m).withColumn("copy", F.explode(F.array_repeat(F.lit(1), copies)))
    landed = _run_dry(m, dedupe_closed(flood.select("event_id", "sensor_id", "timestamp"), ("sensor_id", "timestamp"),
                                       "timestamp"), "closed", partition_by=())
    return landed.select("sensor_id", ntz(F.col("timestamp")).alias("event_ts"), "event_id")


@query("sink_micro_batch", "SELECT event_id, sensor_id, vehicle_count FROM raw_events")
def micro_batch_sink(m):
    path = shared_path(m.spark, "batches")
    write = parquet_micro_batch(f"{path}/data", lambda batch: batch.select("event_id", "sensor_id", "vehicle_count"))

    def write_twice(batch, batch_id):
        write(batch, batch_id)
        write(batch, batch_id)
    sink_micro_batch(_streamed_events(m), write_twice, f"{path}/checkpoint", availableNow=True).awaitTermination()
    return m.spark.read.parquet(f"{path}/data").drop("batch_id")


@query("stream_conformed_events", """
SELECT e.event_id, e.sensor_id, e.road_id, e."timestamp", e.vehicle_count, e.average_speed_kmh, e.congestion_index,
       e.congestion_level, w.weather_id, e.hour
FROM traffic_events e ASOF LEFT JOIN weather_data w ON e."timestamp" >= w."timestamp"
""")
def conformed_stream(m):
    """Each batch is written twice, as after a failure; the table must hold its rows once."""
    path = shared_path(m.spark, "conformed")
    write = conformed_batches(lambda: (m.sensors, m.roads, m.weather), parquet_micro_batch(f"{path}/data"))

    def write_twice(batch, batch_id):
        sent = batch.select("event_id", "sensor_id", "vehicle_count", "average_speed_kmh",
                            ntz(F.col("timestamp")).alias("timestamp"))
        write(sent, batch_id)
        write(sent, batch_id)
    sink_micro_batch(_streamed_events(m), write_twice, f"{path}/checkpoint", availableNow=True).awaitTermination()
    return m.spark.read.parquet(f"{path}/data").select(
        "event_id", "sensor_id", "road_id", "timestamp", "vehicle_count", "average_speed_kmh", "congestion_index",
        "congestion_level", "weather_id", "hour")


@query("stream_weather_join", """
SELECT e.event_id, e.sensor_id, e."timestamp" AS event_ts,
       CASE WHEN w."timestamp" > e."timestamp" - INTERVAL 3 HOUR THEN w.weather_id END AS weather_id,
       CASE WHEN w."timestamp" > e."timestamp" - INTERVAL 3 HOUR THEN w.temperature_celsius END AS temperature_celsius
FROM raw_events e ASOF LEFT JOIN weather_data w ON e."timestamp" >= w."timestamp"
WHERE e."timestamp" <= least((SELECT max("timestamp") FROM weather_data), (SELECT max(ts) FROM events))
  - INTERVAL 10 MINUTE - INTERVAL 3 HOUR""")
def stream_weather(m):
    """Two streams of three and four files, a file of each per batch: the weather of a reading comes a batch later."""
    path, instant = shared_path(m.spark, "weather-topic"), F.col("timestamp").cast("timestamp").alias("timestamp")
    events = m.raw_events.select("event_id", "sensor_id", instant)
    weather = m.weather.select("weather_id", instant, "temperature_celsius")
    for frame, name, days in ((events, "readings", (10, 20, 31)), (weather, "weather", (1, 10, 20, 31))):
        since = 1
        for until in days:
            (frame.where(F.dayofmonth("timestamp").between(since, until)).coalesce(1)
             .write.mode("append").parquet(f"{path}/{name}"))
            since = until + 1
    topics = [m.spark.readStream.schema(frame.schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/{name}")
              for frame, name in ((events, "readings"), (weather, "weather"))]
    landed = _run_dry(m, join_weather_streams(*topics, key=("event_id",)), "weathered", partition_by=())
    return landed.select("event_id", "sensor_id", ntz(F.col("timestamp")).alias("event_ts"), "weather_id",
                         "temperature_celsius")


@query("stream_current_status")
def stream_status(m):
    """Readings in three batches, the newest first, each written twice; the view over the table that they maintain."""
    path = shared_path(m.spark, "status")
    for part in (2, 0, 1):
        m.read("events").where(F.col("event_id") % 3 == part).coalesce(1).write.mode("append").parquet(f"{path}/events")
    streamed = TrafficModel(m.spark, m.sf_dir)
    streamed.read = lambda table: (
        m.spark.readStream.schema(PROVIDED[table]).option("maxFilesPerTrigger", 1).parquet(f"{path}/events")
        if table == "events" else m.read(table))
    write = latest_rows_batches(f"{path}/latest", "sensor_id", "timestamp", "event_id")

    def write_twice(batch, batch_id):
        write(batch, batch_id)
        write(batch, batch_id)
    sink_micro_batch(streamed.events, write_twice, f"{path}/checkpoint", availableNow=True).awaitTermination()
    register_views(m.spark, {"traffic_events": read_latest_rows(m.spark, f"{path}/latest"), "roads": m.roads,
                             "sensor_locations": m.sensors, "weather_data": m.weather})
    return m.spark.table("v_current_traffic_status")


ORACLES["stream_current_status"] = ORACLES["current_status"]


_MESSAGE_ERROR = """CASE WHEN event_id % 41 = 0 OR event_id % 43 = 0 THEN 'malformed JSON' WHEN sensor_id IS NULL THEN 'missing core field'
            WHEN latitude > 90 THEN 'coordinates out of range'
            WHEN vehicle_count < 0 OR average_speed_kmh < 0 THEN 'count or speed out of range' ELSE 'none' END"""
# What can be read again of a message: nothing of one that is no JSON, all but the count of one with a bad count.
_READ_AGAIN = f"""
SELECT {_MESSAGE_ERROR} AS error, CASE WHEN event_id % 41 <> 0 THEN sensor_id END AS sensor_id,
       CASE WHEN event_id % 41 <> 0 AND event_id % 43 <> 0 THEN vehicle_count END AS vehicle_count,
       CASE WHEN event_id % 41 <> 0 THEN "timestamp" END AS event_ts,
       CASE WHEN event_id % 41 = 0 THEN 'no json ' || CAST(event_id AS VARCHAR) END AS no_json
FROM readings"""
FAILED_AT = dt.datetime(2024, 2, 2, 3, 4, 5)


@query("stream_dead_letters", f"SELECT * FROM ({_READ_AGAIN}) WHERE error <> 'none'")
def dead_letters(m):
    """The dead letters of all rules, read again from the payload that was kept."""
    path = shared_path(m.spark, "dead-letters")
    m.messages.write.text(f"{path}/messages")

    def landing(df, checkpoint):
        return sink_raw_parquet(df, f"{path}/dead_letters", checkpoint, (), availableNow=True)
    running = run_stream(m.spark.readStream.text(f"{path}/messages"), {}, landing, f"{path}/checkpoints")
    for stream in running.values():
        stream.awaitTermination()
    return _payloads_read(m.spark.read.parquet(f"{path}/dead_letters"))


def _payloads_read(bad: DataFrame) -> DataFrame:
    """Dead letters with the fields that their payloads still give. A payload that occurs twice fails for one reason."""
    reasons = bad.select(F.col("original_payload").alias("value"), "error").distinct()
    sent = parse_readings(bad.select(F.col("original_payload").alias("value"))).join(reasons, "value")
    return _times_without_zone(sent).select("error", "sensor_id", "vehicle_count", "event_ts",
                                            F.when(F.col("value").startswith("no json"), F.col("value")).alias("no_json"))


@query("quarantine_letters", f"""
SELECT *, TIMESTAMP '2024-02-02 03:04:05' AS failed_at FROM ({_READ_AGAIN}) WHERE error <> 'none'""")
def quarantine_letters(m):
    """The letters themselves, with the time of the failure, which is an argument."""
    _, bad = quarantine(parse_readings(m.messages), failed_at=F.lit(FAILED_AT))
    return _payloads_read(bad).withColumn("failed_at", ntz(F.lit(FAILED_AT)))


@query("run_stream", f"""
SELECT 'letter' AS landed, error, sensor_id, vehicle_count, event_ts, no_json, CAST(NULL AS VARCHAR) AS congestion_level
FROM ({_READ_AGAIN}) WHERE error <> 'none'
UNION ALL SELECT 'raw', * , NULL FROM ({_READ_AGAIN}) WHERE error = 'none'
UNION ALL SELECT 'conformed', 'none', r.sensor_id, r.vehicle_count, r."timestamp", NULL,
  CASE WHEN r.average_speed_kmh >= d.speed_limit_kmh THEN 'LOW' WHEN 1e0 - r.average_speed_kmh / d.speed_limit_kmh < 0.25 THEN 'LOW'
       WHEN 1e0 - r.average_speed_kmh / d.speed_limit_kmh < 0.5 THEN 'MEDIUM'
       WHEN 1e0 - r.average_speed_kmh / d.speed_limit_kmh < 0.75 THEN 'HIGH' ELSE 'CRITICAL' END
FROM readings r JOIN sensor_locations s ON r.sensor_id = s.sensor_id JOIN roads d ON s.road_id = d.road_id
WHERE event_id % 41 <> 0 AND event_id % 43 <> 0 AND r.latitude <= 90 AND r.vehicle_count >= 0 AND r.average_speed_kmh >= 0""")
def fan_out(m):
    """Messages from text files through all branches at once: the raw lake, the event table, and dead letters."""
    path = shared_path(m.spark, "fan-out")
    m.messages.write.text(f"{path}/messages")

    def landing(name):
        return lambda df, checkpoint: sink_raw_parquet(df, f"{path}/{name}", checkpoint, (), availableNow=True)
    conform = conformed_batches(lambda: (m.sensors, m.roads, m.weather), parquet_micro_batch(f"{path}/conformed"))

    def conformed(df, checkpoint):
        def write(batch, batch_id):
            conform(batch.withColumn("timestamp", ntz(F.col(EVENT_TIME))), batch_id)
        return sink_micro_batch(df, write, checkpoint, availableNow=True)
    running = run_stream(m.spark.readStream.text(f"{path}/messages"), {"raw": landing("raw"), "conformed": conformed},
                         landing("dead_letters"), f"{path}/checkpoints")
    for stream in running.values():
        stream.awaitTermination()
    read = m.spark.read.parquet
    none = F.lit(None).cast("string")
    letters = _payloads_read(read(f"{path}/dead_letters")).withColumns({"landed": F.lit("letter"), "congestion_level": none})
    raw = _times_without_zone(read(f"{path}/raw")).withColumns({
        "landed": F.lit("raw"), "error": F.lit("none"), "no_json": none, "congestion_level": none})
    events = read(f"{path}/conformed").withColumnRenamed("timestamp", "event_ts").withColumns({
        "landed": F.lit("conformed"), "error": F.lit("none"), "no_json": none})
    columns = ["landed", "error", "sensor_id", "vehicle_count", "event_ts", "no_json", "congestion_level"]
    return letters.select(columns).unionAll(raw.select(columns)).unionAll(events.select(columns))
