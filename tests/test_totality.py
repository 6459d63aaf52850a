"""Odd input must not be lost, pass unnoticed or raise: rules of the reference system, case by case."""

import datetime as dt
import json

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from viaduct import functions as V
from viaduct.forecast import compare_models
from viaduct.functions import register_sql_functions
from viaduct.operators import integrity
from viaduct.operators.asof import asof_weather
from viaduct.operators.quality import quarantine
from viaduct.operators.upsert import insert_ignore
from viaduct.sinks import write_date_partitioned
from viaduct.sources import SourceNotFound, load_reference_dimensions, read_csv, read_date_partitions
from viaduct.streaming import clean_stream, parse_readings

PAIR = StructType([StructField("k", IntegerType()), StructField("v", StringType())])


def test_null_keys_conflict_with_nothing(spark):
    incoming = spark.createDataFrame([(None, 1), (None, 2), (None, 2), (5, 1), (5, 0), (6, 1)], "k int, v int")
    existing = spark.createDataFrame([(6, 9), (None, 9)], "k int, v int")
    expected = sorted([(None, 1), (None, 2), (None, 2), (5, 0)], key=repr)
    assert rows(insert_ignore(incoming, existing, ["k"])) == expected
    keys = insert_ignore(incoming.select("k"), existing.select("k"), ["k"])
    assert rows(keys) == sorted([(None,)] * 3 + [(5,)], key=repr)


def test_csv_values_that_do_not_fit(spark, tmp_path):
    (tmp_path / "bad.csv").write_text("k,v\n1,a\nxx,b\n")
    with pytest.raises(Exception):
        read_csv(spark, str(tmp_path / "bad.csv"), PAIR).collect()
    kept = read_csv(spark, str(tmp_path / "bad.csv"), PAIR, bad_records="keep")
    assert rows(kept) == sorted([(1, "a", None), (None, "b", "xx,b")], key=repr)
    with pytest.raises(ValueError):
        read_csv(spark, str(tmp_path / "bad.csv"), PAIR, bad_records="drop")


def test_a_required_table_must_be_there(spark, tmp_path):
    assert load_reference_dimensions(spark, str(tmp_path)) == {}
    with pytest.raises(SourceNotFound):
        load_reference_dimensions(spark, str(tmp_path), required=("roads",))


def message(**fields):
    good = {"sensor_id": "S", "vehicle_count": 1, "average_speed_kmh": 50.0, "latitude": 30.0, "longitude": 31.0,
            "timestamp": "2024-01-01T00:00:00Z"}
    return json.dumps(good | fields)


def test_only_the_rules_drop_a_reading(spark):
    kept = [message(), message(humidity="n/a"), message(sensor_id=None), message(timestamp="soon")]
    lost = ["{no json", message(vehicle_count=-1), message(average_speed_kmh=-0.5), message(latitude=91.0),
            message(longitude=None), message(vehicle_count="many")]
    parsed = parse_readings(spark.createDataFrame([(m,) for m in kept + lost], "value string"))
    assert clean_stream(parsed).count() == len(kept)
    good, bad = quarantine(parsed)
    assert good.count() == 2  # a mistyped optional field is null, the reading is good
    assert {r["original_payload"]: r["error"] for r in bad.collect() if r["error"] == "malformed JSON"}.keys() == {
        "{no json", message(vehicle_count="many")}
    assert bad.count() == len(lost) + 2


def test_roads_without_lanes_have_the_least_speed(spark):
    register_sql_functions(spark)
    frame = spark.createDataFrame([(100.0, 0, 60), (100.0, -1, 60), (None, 0, 60), (0.0, 2, 60)], "n double, l int, s int")
    ours = frame.select(V.expected_speed(F.col("n"), F.col("l"), F.col("s")).alias("x"))
    twin = frame.selectExpr("expected_speed(n, l, s) AS x")
    assert [r["x"] for r in ours.collect()] == [r["x"] for r in twin.collect()] == pytest.approx([6.0, 6.0, None, 60.0])


def test_a_marker_in_a_name_is_left_out(spark):
    register_sql_functions(spark)
    frame = spark.createDataFrame([("a﷐ b",), ("﷐",), ("o﷐'neil",)], "a string")
    found = [r["x"] for r in frame.select(V.normalize_road_name(F.col("a")).alias("x")).collect()]
    assert found == ["A B", "", "O'Neil"]
    assert found == [r["x"] for r in frame.selectExpr("normalize_road_name(a) AS x").collect()]


def test_no_rules_no_violations(spark):
    frame = spark.createDataFrame([(1, "a")], PAIR)
    assert integrity.check_references(frame, {}).collect() == []
    assert integrity.check_not_null_unique(frame, [], []).collect() == []
    with pytest.raises(ValueError):
        compare_models({})


def test_checks_read_the_child_once(spark, tmp_path):
    path = str(tmp_path / "child")
    spark.range(50).selectExpr("id AS a", "id % 7 AS b", "cast(id AS int) AS c").write.parquet(path)
    child, parent = spark.read.parquet(path), spark.range(40)
    found = integrity.check_references(child, {c: (parent, "id") for c in "abc"})
    assert plan(found).count("Scan parquet") == 1
    assert sum(r["rows"] for r in found.collect()) == 20
    broken = integrity.check_not_null_unique(child, ["a", "b"], ["a", "b", "c"])
    assert plan(broken).count("Scan parquet") == 1 and rows(broken) == [("UNIQUE", "b", 43)]


def weather(spark, hours):
    return spark.createDataFrame([(h, dt.datetime(2024, 1, 1, h)) for h in hours], "weather_id int, timestamp timestamp")


def test_a_series_that_grows_after_the_call_loses_no_match(spark, tmp_path):
    path = str(tmp_path / "weather")
    weather(spark, range(3)).write.parquet(path)
    events = spark.createDataFrame([(h, dt.datetime(2024, 1, 1, h, 30)) for h in range(6)], "event_id int, timestamp timestamp")
    joined = asof_weather(events, spark.read.parquet(path))
    weather(spark, range(3, 6)).write.mode("append").parquet(path)
    assert [r["weather_id"] for r in joined.orderBy("event_id").collect()] == [0, 1, 2, 2, 2, 2]


def test_streams_are_refused(spark, tmp_path):
    schema = "event_id int, timestamp timestamp"
    spark.createDataFrame([], schema).write.parquet(str(tmp_path / "events"))
    stream = spark.readStream.schema(schema).parquet(str(tmp_path / "events"))
    with pytest.raises(ValueError):
        asof_weather(stream, weather(spark, range(2)))


@pytest.mark.parametrize("bucket", [None, 1, 30, 3600, 86_400])
def test_dense_series_and_late_events(spark, bucket):
    start = dt.datetime(2024, 1, 1)
    series = spark.createDataFrame([(i, start + dt.timedelta(seconds=30 * i)) for i in range(400)],
                                   "weather_id int, timestamp timestamp")
    times = [start + dt.timedelta(seconds=s) for s in (-1, 0, 29, 30, 5999, 11_970, 11_971, 500_000)] + [None]
    events = spark.createDataFrame(list(enumerate(times)), "event_id int, timestamp timestamp")
    for limit in (None, 0):
        extra = {} if limit is None else {"limit": __import__("viaduct.operators.dimensions", fromlist=["x"]).BroadcastLimit(0, 0)}
        found = asof_weather(events, series, bucket_seconds=bucket, **extra)
        assert [r["weather_id"] for r in found.orderBy("event_id").collect()] == [None, 0, 0, 1, 199, 399, 399, 399, None]


def test_only_the_days_asked_for_are_opened(spark, tmp_path):
    path = str(tmp_path / "lake")
    frame = spark.createDataFrame([(d, d, dt.datetime(2024, 1, d, 5)) for d in range(1, 21)],
                                  "event_id int, road_id int, timestamp timestamp")
    write_date_partitioned(frame, path)
    days = read_date_partitions(spark, path, dt.date(2024, 1, 3), dt.date(2024, 1, 5))
    assert sorted(r["event_id"] for r in days.collect()) == [3, 4, 5]
    assert {f.split("/day=")[1].split("/")[0] for f in days.inputFiles()} == {"3", "4", "5"}
    schema = StructType([StructField("event_id", LongType())])
    assert read_date_partitions(spark, path, dt.date(2030, 1, 1), dt.date(2030, 1, 2), schema).count() == 0
    with pytest.raises(SourceNotFound):
        read_date_partitions(spark, path, dt.date(2030, 1, 1), dt.date(2030, 1, 2))


@pytest.mark.parametrize("name, most", [("current_status", 2), ("conform_events", 1), ("check_references", 2)])
def test_events_are_read_at_most_twice_besides_the_dimensions(spark, name, most):
    from conftest import DATA

    from viaduct.plans import QUERIES
    frame = QUERIES[name](spark, DATA)
    assert 0 < plan(frame).count("events.parquet]") <= most


def test_csv_with_another_header_is_refused(spark, tmp_path):
    (tmp_path / "turned.csv").write_text("b,a\n1,2\n")
    (tmp_path / "short.csv").write_text("a\n1\n")
    for name in ("turned", "short"):
        for bad_records in ("fail", "keep"):
            with pytest.raises(Exception, match="FAILED_READ_FILE|header"):
                read_csv(spark, str(tmp_path / f"{name}.csv"), PAIR, bad_records=bad_records).collect()
