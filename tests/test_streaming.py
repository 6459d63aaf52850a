import json
import os

import pytest
from pyspark.sql import functions as F

from conftest import rows
from viaduct import sinks
from viaduct.streaming import (clean_stream, dedupe_stream, parse_messages, parse_readings, run_stream,
                               windowed_metrics, with_event_time)
from viaduct.schemas import WEATHER_MESSAGE


def message(i, at, **changes):
    fields = {"sensor_id": f"S{i}", "road_name": f"Road {i % 2}", "latitude": 30.0, "longitude": 31.0, "vehicle_count": 10 + i,
              "average_speed_kmh": 40.0 + i, "congestion_index": 0.25, "timestamp": f"2024-01-01T{at}Z", "hour": 8, "month": 1}
    return json.dumps({k: v for k, v in {**fields, **changes}.items() if v is not None})


MESSAGES = [
    message(1, "08:00:30"), message(2, "08:01:10"), message(3, "08:03:59"), message(4, "08:30:00"),
    "no json", message(5, "08:02:00", vehicle_count="many"), message(6, "08:02:00", latitude=100.0),
    message(7, "08:02:00", sensor_id=None), message(8, "soon"), message(9, "08:02:00", average_speed_kmh=-3.0),
    message(10, "08:02:00", average_speed_kmh=250.0),
]
REASONS = ["bad timestamp", "coordinates out of range", "count or speed out of range", "malformed JSON", "malformed JSON",
           "missing core field"]


def text_files(tmp_path, *batches):
    folder = tmp_path / "in"
    folder.mkdir(exist_ok=True)
    for number, batch in enumerate(batches):
        file = folder / f"{number:03d}.txt"
        file.write_text("\n".join(batch) + "\n")
        os.utime(file, (1_700_000_000 + number, 1_700_000_000 + number))  # files are taken by age
    return str(folder)


def stream_of(spark, folder):
    return spark.readStream.option("maxFilesPerTrigger", 1).text(folder)


def drain(query):
    query.awaitTermination(120)
    assert query.exception() is None


@pytest.fixture
def batch(spark):
    return spark.createDataFrame([(m,) for m in MESSAGES], "value string")


def test_parsing_marks_bad_records(batch):
    parsed = parse_readings(batch)
    corrupt = parsed.where("_corrupt_record is not null")
    assert sorted(r.value for r in corrupt.collect()) == sorted([MESSAGES[4], MESSAGES[5]])
    kept = corrupt.where("sensor_id is not null").first()
    assert kept.sensor_id == "S5" and kept.vehicle_count is None
    first = parsed.where("sensor_id = 'S1'").first()
    assert first.vehicle_count == 11 and str(first.timestamp_parsed) == "2024-01-01 08:00:30"


def test_null_message_and_other_schema(spark):
    nothing = parse_readings(spark.createDataFrame([(None,)], "value string"))
    assert nothing.count() == 1 and clean_stream(nothing).count() == 0
    weather = parse_messages(spark.createDataFrame([('{"rain_mm": 1.5, "city": "Cairo"}',)], "value string"), WEATHER_MESSAGE)
    assert rows(weather.select("rain_mm", "city")) == [(1.5, "Cairo")]


def test_clean_has_an_optional_cap(batch):
    assert clean_stream(parse_readings(batch), strict=True).count() == 5
    assert clean_stream(parse_readings(batch), max_speed=200, strict=True).count() == 4
    # Only the count, the speed and the coordinates are rules of the plain form.
    assert clean_stream(parse_readings(batch)).count() == 7


def test_json_is_parsed_once(batch):
    plan = clean_stream(parse_readings(batch))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_fan_out_to_lake_table_and_dead_letters(spark, tmp_path):
    out = {name: str(tmp_path / name) for name in ("raw", "table", "dead")}
    folder = text_files(tmp_path, MESSAGES[:5], MESSAGES[5:])
    def start():
        return run_stream(stream_of(spark, folder), {
            "raw": lambda df, cp: sinks.sink_raw_parquet(df, out["raw"], cp, availableNow=True),
            "table": lambda df, cp: sinks.sink_micro_batch(df, sinks.parquet_micro_batch(out["table"]), cp, availableNow=True),
        }, lambda df, cp: sinks.sink_raw_parquet(df, out["dead"], cp, partition_by=(), availableNow=True),
            str(tmp_path / "checkpoints"))
    for _ in range(2):  # the second start resumes from the checkpoints and has nothing to do
        for query in start().values():
            drain(query)
    raw, table, dead = (spark.read.parquet(out[name]) for name in ("raw", "table", "dead"))
    assert sorted(r.sensor_id for r in raw.collect()) == ["S1", "S10", "S2", "S3", "S4"]
    assert {(r.month, r.hour) for r in raw.select("month", "hour").collect()} == {(1, 8)}
    assert rows(raw.select("sensor_id", "vehicle_count")) == rows(table.select("sensor_id", "vehicle_count"))
    assert sorted(r.error for r in dead.collect()) == REASONS
    assert dead.columns == ["original_payload", "error", "failed_at"]


def test_an_error_in_the_batch_function_fails_the_query(spark, tmp_path):
    def broken(df, batch_id):
        raise ValueError("table is gone")
    query = sinks.sink_micro_batch(stream_of(spark, text_files(tmp_path, MESSAGES[:1])), broken,
                                   str(tmp_path / "cp"), availableNow=True)
    with pytest.raises(Exception, match="table is gone"):
        query.awaitTermination(120)


def test_batch_windows_equal_the_built_in_sliding_window(spark):
    frame = spark.range(500).select(
        F.concat(F.lit("r"), F.col("id") % 3).alias("road_name"),
        F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 37).alias("timestamp_parsed"),
        (F.col("id") % 11).cast("int").alias("vehicle_count"), (F.col("id") % 13).cast("double").alias("average_speed_kmh"),
        (F.col("id") % 4 / 4).alias("congestion_index"))
    direct = frame.groupBy(F.window("timestamp_parsed", "5 minutes", "1 minute").alias("w"), "road_name").agg(
        F.avg("vehicle_count").alias("a"), F.avg("average_speed_kmh").alias("b"), F.avg("congestion_index").alias("c"))
    expected = direct.select("w.start", "w.end", "road_name", "a", "b", F.round("c", 9))
    got = windowed_metrics(frame).select("window_start", "window_end", "road_name", "avg_vehicle_count", "avg_speed_kmh",
                                         F.round("avg_congestion_index", 9))
    assert rows(got) == rows(expected)
    with pytest.raises(ValueError):
        windowed_metrics(frame, minutes=5, every=2)


def test_stream_windows_close_with_the_watermark_and_drop_late_readings(spark, tmp_path):
    on_time = [message(2, "08:00:30"), message(4, "08:30:00")]
    between = [message(4, "08:30:10")]  # a batch later, the watermark counts for what comes in
    late = [message(6, "08:01:00"), message(8, "08:45:30")]  # 08:01 is behind 08:30 less ten minutes
    folder = text_files(tmp_path, on_time, between, late)
    metrics = windowed_metrics(clean_stream(parse_readings(stream_of(spark, folder))))
    path = str(tmp_path / "windows")
    drain(sinks.sink_raw_parquet(metrics, path, str(tmp_path / "cp"), partition_by=(), availableNow=True))
    got = spark.read.parquet(path)
    batch = windowed_metrics(clean_stream(parse_readings(spark.createDataFrame(
        [(m,) for m in on_time + between + late[1:]], "value string"))))
    closed = batch.where(F.col("window_end") <= F.lit("2024-01-01 08:35:30").cast("timestamp"))
    assert rows(got) == rows(closed)
    assert got.count() == 10


def test_dedupe_on_a_stream_and_on_a_batch(spark, tmp_path):
    twice = [message(1, "08:00:30"), message(1, "08:00:30", vehicle_count=99), message(2, "08:00:30")]
    folder = text_files(tmp_path, twice[:2], twice)
    path = str(tmp_path / "out")
    readings = dedupe_stream(clean_stream(parse_readings(stream_of(spark, folder))))
    drain(sinks.sink_raw_parquet(readings, path, str(tmp_path / "cp"), availableNow=True))
    assert sorted(r.sensor_id for r in spark.read.parquet(path).collect()) == ["S1", "S2"]
    frame = parse_readings(spark.createDataFrame([(m,) for m in twice], "value string"))
    assert dedupe_stream(frame).count() == 2
    assert with_event_time(frame).columns == frame.columns
