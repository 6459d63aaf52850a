from pyspark.sql import Observation, functions as F

from conftest import rows
from viaduct.operators import integrity, quality
from viaduct.operators.features import (clean_and_derive, conform_events, derive_features,
                                        with_column_defaults, with_road_defaults)
from viaduct.operators.dimensions import BroadcastLimit
from viaduct.operators.upsert import insert_ignore

SCHEMA = ("sensor_id string, road_name string, latitude double, longitude double, vehicle_count int, "
          "average_speed_kmh double, timestamp string")
WHEN = "2026-07-15T12:00:00Z"
GOOD = ("SENSOR_TEST_01", "  ring road cairo  ", 30.0444, 31.2357, 100, 40.0, WHEN)
BAD = [
    (None, "Tahrir", 30.0444, 31.2357, 100, None, WHEN),
    ("SENSOR_TEST_02", "Haram", 100.0, 31.2357, 50, 60.0, WHEN),
]


def with_(**changes):
    names = [part.split()[0] for part in SCHEMA.split(", ")]
    return tuple(changes.get(name, value) for name, value in zip(names, GOOD))


def test_clean_keeps_the_one_good_reading(spark):
    cleaned = quality.clean_readings(spark.createDataFrame([GOOD, *BAD], SCHEMA))
    assert [r.sensor_id for r in cleaned.collect()] == ["SENSOR_TEST_01"]


def test_derived_columns(spark):
    out = clean_and_derive(spark.createDataFrame([GOOD, *BAD], SCHEMA))
    row = out.first()
    assert row.road_name == "Ring Road Cairo"
    assert (row.hour, row.day_of_week, row.month, row.is_weekend, row.is_rush_hour) == (12, 2, 7, False, False)
    assert (row.num_lanes, row.length_km, row.speed_limit_kmh) == (3, 5.0, 60)
    assert row.traffic_density == 100 / 15 and row.congestion_level == "MEDIUM"


def test_speed_bounds_and_copies(spark):
    frame = spark.createDataFrame([with_(average_speed_kmh=200.0), with_(average_speed_kmh=200.5),
                                   with_(average_speed_kmh=-1.0), with_(vehicle_count=-1), GOOD, GOOD, GOOD], SCHEMA)
    assert sorted(r.average_speed_kmh for r in quality.clean_readings(frame).collect()) == [40.0, 200.0]
    uncapped = quality.clean_readings(frame, max_speed=None)
    assert sorted(r.average_speed_kmh for r in uncapped.collect()) == [40.0, 200.0, 200.5]


def test_counts_are_observed_without_a_job_of_their_own(spark):
    seen, kept = Observation("seen"), Observation("kept")
    quality.clean_readings(spark.createDataFrame([GOOD, GOOD, *BAD], SCHEMA), observe=(seen, kept)).collect()
    assert seen.get["rows"] == 4 and kept.get["rows"] == 1


def test_frame_without_coordinates_and_empty_frame(spark):
    frame = spark.createDataFrame([GOOD, *BAD], SCHEMA)
    assert quality.clean_readings(frame.drop("latitude")).count() == 2
    empty = spark.createDataFrame([], SCHEMA)
    assert clean_and_derive(empty).count() == 0
    assert "congestion_level" in derive_features(empty).columns


def test_quarantine_names_the_first_broken_rule(spark):
    frame = spark.createDataFrame([GOOD, *BAD, with_(vehicle_count=-1), with_(vehicle_count=None)], SCHEMA)
    good, bad = quality.quarantine(frame, failed_at=F.lit("2026-01-01").cast("timestamp"))
    assert good.columns == frame.columns and good.count() == 1
    assert bad.columns == ["original_payload", "error", "failed_at"]
    assert sorted(r.error for r in bad.collect()) == [
        "coordinates out of range", "count or speed out of range", "missing core field", "missing core field"]
    assert good.count() + bad.count() == frame.count()


def test_road_and_column_defaults(spark):
    frame = spark.createDataFrame([(1, None, None), (2, 4, False)], "id int, num_lanes int, is_active boolean")
    filled = with_column_defaults(with_road_defaults(frame), {"is_active": True, "city": "Cairo"})
    assert rows(filled.select("id", "num_lanes", "length_km", "is_active", "city")) == [
        (1, 3, 5.0, True, "Cairo"), (2, 4, 5.0, False, "Cairo")]


def test_missing_references(spark):
    roads = spark.createDataFrame([(1,), (2,)], "road_id int")
    events = spark.createDataFrame([(1, 1), (2, 9), (3, 9), (4, None)], "event_id int, road_id int")
    assert rows(integrity.check_references(events, {"road_id": (roads, "road_id")})) == [("road_id", "9", 2)]
    assert [r.event_id for r in integrity.violating_rows(events, "road_id", roads, "road_id").collect()] in ([2, 3], [3, 2])


def test_not_null_and_unique(spark):
    frame = spark.createDataFrame([(1, "a"), (1, None), (2, None), (None, "b")], "k int, v string")
    found = integrity.check_not_null_unique(frame, required=["k", "v"], unique=["k", "v"])
    assert rows(found) == [("NOT NULL", "k", 1), ("NOT NULL", "v", 2), ("UNIQUE", "k", 1)]


def test_insert_ignore_is_exact_whatever_the_size(spark):
    from viaduct.operators.dimensions import BroadcastLimit
    existing = spark.createDataFrame([(1, "old"), (3, "old")], "k int, v string")
    incoming = spark.createDataFrame([(1, "new"), (2, "b"), (2, "a"), (4, "c")], "k int, v string")
    expected = [(2, "a"), (4, "c")]
    assert rows(insert_ignore(incoming, existing, ["k"])) == expected
    assert rows(insert_ignore(incoming, existing, ["k"], BroadcastLimit(rows=0))) == expected
    assert rows(insert_ignore(incoming.select("k"), existing, ["k"])) == [(2,), (4,)]
    nothing = existing.limit(0)
    assert rows(insert_ignore(incoming, nothing, ["k"])) == [(1, "new"), (2, "a"), (4, "c")]


def test_conform_fits_the_event_table(spark):
    from viaduct.operators.features import EVENT_COLUMNS
    readings = spark.createDataFrame(
        [(1, "S1", 100, 30.0, "2024-01-01 08:30:00", "x"), (2, "S9", 5, 30.0, "2024-01-01 08:30:00", "x")],
        "event_id long, sensor_id string, vehicle_count int, average_speed_kmh double, timestamp string, extra string"
    ).withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    sensors = spark.createDataFrame([("S1", 7)], "sensor_id string, road_id int")
    roads = spark.createDataFrame([(7, 2.0, 2, 60)], "road_id int, length_km double, num_lanes int, speed_limit_kmh int")
    weather = spark.createDataFrame([(11, "2024-01-01 06:00:00"), (12, "2024-01-01 09:00:00")],
                                    "weather_id long, timestamp string").withColumn(
                                        "timestamp", F.col("timestamp").cast("timestamp"))
    for frame, ts in ((readings, "timestamp"), (readings.withColumnRenamed("timestamp", "timestamp_parsed"), "timestamp_parsed")):
        out = conform_events(frame, sensors, roads, weather, ts=ts)
        assert out.columns == list(EVENT_COLUMNS)
    assert "event_id" not in conform_events(readings.drop("event_id"), sensors, roads, weather).columns
    assert out.columns == list(EVENT_COLUMNS)
    row = out.first()
    assert out.count() == 1 and (row.road_id, row.weather_id, row.traffic_density, row.congestion_level) == (7, 11, 25.0, "HIGH")


def test_distinct_of_odd_rows_and_with_colliding_digests(spark, monkeypatch):
    schema = "a string, b string, c double, d array<int>, e struct<x:int,y:string>"
    nan = float("nan")
    odd = [(None, "x", 1.0, [1, None], (1, None)), ("x", None, 1.0, [1, None], (1, None)), (None, None, None, None, None),
           ("", None, 0.0, [], (None, "y")), ("", None, -0.0, [], (None, "y")), (None, "", nan, [None], (None, None)),
           (None, "", nan, [None], (None, None)), ("a", "bc", 2.0, None, None), ("ab", "c", 2.0, None, None)]
    frame = spark.createDataFrame(odd * 3 + odd[:2], schema).repartition(4)
    expected = rows(frame.dropDuplicates().select(F.to_json(F.struct("*"))))
    assert rows(quality.drop_exact_duplicates(frame).select(F.to_json(F.struct("*")))) == expected
    # Digests that all agree, and a limit that no set of digests meets.
    assert rows(quality.drop_exact_duplicates(frame, BroadcastLimit(rows=0)).select(F.to_json(F.struct("*")))) == expected
    monkeypatch.setattr(quality, "row_digest", lambda df: [F.lit(7).alias(f"__digest_{k}") for k in (0, 1)])
    assert rows(quality.drop_exact_duplicates(frame).select(F.to_json(F.struct("*")))) == expected
    assert quality.drop_exact_duplicates(frame.limit(0)).count() == 0


def test_single_rows_are_not_shuffled_whole(spark, tmp_path):
    """Of a table with few copies less than a tenth of the bytes travel that the plain distinct sends."""
    wide = spark.range(20_000).select("id", *[F.sha2(F.concat("id", F.lit(f"-{k}")), 512).alias(f"c{k}") for k in range(8)])
    wide.unionAll(wide.where("id % 1000 = 0")).repartition(4).write.parquet(str(tmp_path / "wide"))
    table = spark.read.parquet(str(tmp_path / "wide"))

    def shuffled(make):
        bytes_ = 0
        frame = make()
        frame.write.format("noop").mode("overwrite").save()
        frame.collect()
        todo = [frame._jdf.queryExecution().executedPlan()]
        while todo:
            node = todo.pop()
            metrics = node.metrics()
            if node.nodeName().startswith("Exchange") and metrics.contains("shuffleBytesWritten"):
                bytes_ += metrics.apply("shuffleBytesWritten").value()
            inner = {"AdaptiveSparkPlan": "executedPlan", "ShuffleQueryStage": "plan", "BroadcastQueryStage": "plan",
                     "ResultQueryStage": "plan"}
            if node.nodeName() in inner:
                todo.append(getattr(node, inner[node.nodeName()])())
            todo += [node.children().apply(k) for k in range(node.children().size())]
        return frame.count(), bytes_
    plain, digest = shuffled(table.dropDuplicates), shuffled(lambda: quality.drop_exact_duplicates(table))
    assert plain[0] == digest[0] == 20_000 and plain[1] > 10_000_000
    assert digest[1] + 20_020 * 16 < plain[1] / 10  # the digests, sixteen bytes a row, went before
