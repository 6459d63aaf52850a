import random

import pytest
from pyspark.sql import functions as F

from conftest import plan, rows
from viaduct.operators.asof import CELLS, _CellBuckets, asof_join, asof_weather
from viaduct.operators.dimensions import BroadcastLimit, join_dim, measure, within
from viaduct.operators.joins import join_sensors, join_weather_inner, join_weather_left

TINY = BroadcastLimit(rows=0, bytes=0)


def test_size_check_counts_rows_and_bytes(spark):
    dim = spark.createDataFrame([(1, "x" * 1000), (2, None)], "k int, v string")
    measured = measure(dim)
    assert measured["rows"] == 2 and 1000 <= measured["bytes"] <= 1100
    assert within(measured, BroadcastLimit(rows=2, bytes=2000))
    assert not within(measured, BroadcastLimit(rows=1, bytes=2000))
    assert not within(measured, BroadcastLimit(rows=2, bytes=999))


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_both_ways_of_joining_agree_on_a_hot_key(spark, how):
    # Key 0 holds a third of all rows.
    facts = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("k"))
    dim = spark.range(40).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    small, large = join_dim(facts, dim, "k", how), join_dim(facts, dim, "k", how, TINY)
    assert "BroadcastHashJoin" in plan(small)
    assert rows(small) == rows(large)


def test_past_the_limit_nothing_is_marked_for_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = join_dim(spark.range(100).withColumnRenamed("id", "k"),
                          spark.range(10).withColumnRenamed("id", "k"), "k", limit=TINY)
        assert "Broadcast" not in plan(joined)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_clashing_names(spark):
    facts = spark.createDataFrame([(1, 5, "f"), (2, 6, "f"), (3, None, "f")], "id int, weather_id int, city string")
    weather = spark.createDataFrame([(5, "w", 1.0)], "weather_id int, city string, rain_mm double")
    assert rows(join_weather_inner(facts, weather).select("id", "city", "city_weather")) == [(1, "f", "w")]
    assert rows(join_weather_left(facts, weather).select("id", "city_weather")) == [(1, "w"), (2, None), (3, None)]
    sensors = spark.createDataFrame([("s", 9, 30.0)], "sensor_id string, road_id int, latitude double")
    reading = spark.createDataFrame([("s", 1)], "sensor_id string, road_id int")
    assert rows(join_sensors(reading, sensors)) == [("s", 1, 30.0)]


def test_hot_key_past_the_limit_is_split_between_tasks(spark):
    """A key with a third of all rows must not end up in one task of the shuffled join."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB", "spark.sql.shuffle.partitions": "8"}
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        facts = spark.range(0, 300_000, 1, 8).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 5000).alias("k"))
        dim = spark.range(4000).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
        joined = join_dim(facts, dim, "k", "left", TINY)
        assert joined.agg(F.count("*"), F.count("v")).first()[0] == 300_000
        joined.collect()
        assert "skew=true" in plan(joined)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def _series(spark, observations):
    return spark.createDataFrame(observations, "city string, weather_id long, secs long").select(
        "city", "weather_id", F.timestamp_seconds("secs").alias("timestamp"))


def _events(spark, events):
    return spark.createDataFrame(events, "event_id long, city string, secs long").select(
        "event_id", "city", F.timestamp_seconds("secs").alias("timestamp"))


def _brute(events, observations, by_city):
    out = []
    for event_id, city, at in events:
        known = [(t, w) for c, w, t in observations if at is not None and t <= at and (not by_city or c == city)]
        out.append((event_id, max(known)[1] if known else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("bucket", [None, 3600, 600, 86400])
@pytest.mark.parametrize("by_city", [False, True])
@pytest.mark.parametrize("limit", [None, TINY])
def test_asof_against_brute_force(spark, bucket, by_city, limit):
    draw = random.Random(7)
    base = 1_700_000_000
    # Irregular, with long gaps, equal instants, and days without any observation.
    observations = [(draw.choice("AB"), i, base + draw.choice([draw.randrange(0, 400_000), 50_000])) for i in range(60)]
    events = [(i, draw.choice("ABC"), base + draw.randrange(-50_000, 900_000)) for i in range(300)]
    events += [(900 + i, "A", t) for i, (_, _, t) in enumerate(observations)] + [(2000, "A", None)]
    options = {} if limit is None else {"limit": limit}
    joined = asof_join(_events(spark, events), _series(spark, observations).withColumnRenamed("timestamp", "seen"),
                       event_ts="timestamp", series_ts="seen", tie_break="weather_id",
                       by=("city",) if by_city else (), bucket_seconds=bucket, **options) if by_city else asof_join(
        _events(spark, events).drop("city"), _series(spark, observations).drop("city").withColumnRenamed("timestamp", "seen"),
        event_ts="timestamp", series_ts="seen", tie_break="weather_id", bucket_seconds=bucket, **options)
    assert rows(joined.select("event_id", "weather_id")) == _brute(events, observations, by_city)


def test_asof_without_weather_and_with_old_id(spark):
    events = _events(spark, [(1, "A", 100)]).withColumn("weather_id", F.lit(99).cast("long"))
    none = asof_weather(events, _series(spark, []).drop("city"))
    assert none.columns == ["event_id", "city", "timestamp", "weather_id", "timestamp_weather"]
    assert none.first().weather_id is None
    one = asof_weather(events, _series(spark, [("x", 5, 50)]))
    assert one.first().weather_id == 5 and one.columns[-3:] == ["city_weather", "weather_id", "timestamp_weather"]


def test_asof_shuffles_no_events(spark, model):
    joined = asof_weather(model.raw_events, model.weather)
    text = plan(joined)
    events_side = text.split("BroadcastExchange")[0]
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in events_side
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_asof_in_micro_batches_stores_what_the_batch_can_meet(spark, tmp_path):
    base, sizes = 1_700_000_000, []
    events = [(i, "A" if i % 2 else "B", base + 400_000 + i) for i in range(50)] + [(99, "A", None)]
    for history in (100, 4000):
        observations = [("AB"[i % 2], i, base + 400_000 - 90 * (history - i)) for i in range(history + 1)]
        for by in ((), ("city",)):
            before = set(checkpoints(spark))
            found = asof_join(_events(spark, events), _series(spark, observations).withColumnRenamed("timestamp", "seen"),
                              event_ts="timestamp", series_ts="seen", tie_break="weather_id", by=by, prune=True) if by else (
                asof_join(_events(spark, events).drop("city"),
                          _series(spark, observations).drop("city").withColumnRenamed("timestamp", "seen"),
                          event_ts="timestamp", series_ts="seen", tie_break="weather_id", prune=True))
            assert rows(found.select("event_id", "weather_id")) == _brute(events, observations, bool(by))
            written = [c for c in checkpoints(spark) if c not in before]
            sizes.append(sum(checkpoints(spark)[c] for c in written))
    # The second pair has forty times the history.
    assert sizes[2] <= 1.5 * sizes[0] and sizes[3] <= 1.5 * sizes[1]


def checkpoints(spark):
    """Bytes by checkpoint folder."""
    from pathlib import Path
    root = Path(spark.sparkContext.getCheckpointDir().removeprefix("file:"))
    return {str(d): sum(f.stat().st_size for f in d.rglob("part-*")) for d in root.iterdir() if d.is_dir()}


def test_a_burst_after_a_gap_does_not_share_a_bucket(spark):
    """Ten years of silence, then 4,000 observations within a second."""
    micros = [0, *(315_360_000_000_000 + 250 * k for k in range(4000))]
    bounds = sorted({micros[len(micros) * k // CELLS] for k in range(CELLS)})
    buckets = _CellBuckets(bounds, micros[-1], len(micros))
    frame = spark.createDataFrame([(m,) for m in micros], "m long").select(F.timestamp_micros("m").alias("t"))
    placed = frame.select(buckets.of(F.col("t")).alias("b")).groupBy("b").count()
    worst, first, last = placed.agg(F.max("count"), F.min("b"), F.max("b")).first()
    assert worst <= 4 and first == buckets.first and last <= buckets.last
    apart = spark.createDataFrame([(-1,), (micros[-1] + 1,), (None,)], "m long").select(F.timestamp_micros("m").alias("t"))
    assert [r[0] for r in apart.select(buckets.of(F.col("t"))).collect()] == [-1, buckets.last + 1, None]
    observations = [("x", k, m // 1_000_000 + k) for k, m in enumerate(micros[:300])]
    events = [(k, "x", t) for k, (_, _, t) in enumerate(observations)] + [(900, "x", 5_000_000), (901, "x", -5)]
    joined = asof_join(_events(spark, events).drop("city"),
                       _series(spark, observations).drop("city").withColumnRenamed("timestamp", "seen"),
                       event_ts="timestamp", series_ts="seen", tie_break="weather_id")
    assert rows(joined.select("event_id", "weather_id")) == _brute(events, observations, False)


def test_asof_of_events_with_a_map(spark):
    events = _events(spark, [(1, "A", 100), (2, "A", 10_000_000)]).withColumn("tags", F.create_map(F.lit("k"), F.lit(1)))
    found = asof_join(events, _series(spark, [("x", 5, 50)]).drop("city").withColumnRenamed("timestamp", "seen"),
                      event_ts="timestamp", series_ts="seen", tie_break="weather_id")
    assert [r["weather_id"] for r in found.collect()] == [5, 5]
