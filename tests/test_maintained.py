"""Tables that are kept up to date: the lake with late rows, stored report sums, latest rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import plan, rows
from viaduct.operators.reports import period_report
from viaduct.operators.rollups import read_rollup, report_from_rollup, update_rollup
from viaduct.sinks import latest_rows_batches, merge_date_partitioned, read_latest_rows, write_date_partitioned
from viaduct.sinks import merge as merge_module

SCHEMA = "event_id long, road_id int, timestamp timestamp, vehicle_count int"


def frame(spark, *found):
    return spark.createDataFrame([(i, 1, dt.datetime(2024, 1, day, 5), n) for i, day, n in found], SCHEMA)


def lake(spark, path):
    return rows(spark.read.schema(f"{SCHEMA}, year int, month int, day int").parquet(path).select("event_id", "day", "vehicle_count"))


def test_late_rows_are_added_and_replay_adds_nothing(spark, tmp_path):
    path = str(tmp_path / "lake")
    write_date_partitioned(frame(spark, (1, 1, 10), (2, 1, 20), (3, 2, 30)), path)
    untouched = sorted((tmp_path / "lake/year=2024/month=1/day=2").glob("part-*"))
    late = frame(spark, (2, 1, 21), (4, 1, 40), (5, 7, 50), (5, 7, 49))
    for _ in range(2):
        merge_date_partitioned(late, path, ("event_id", "timestamp"))
        assert lake(spark, path) == [(1, 1, 10), (2, 1, 21), (3, 2, 30), (4, 1, 40), (5, 7, 50)]
    assert sorted((tmp_path / "lake/year=2024/month=1/day=2").glob("part-*")) == untouched
    assert not list((tmp_path / "lake").glob("_staging*"))
    merge_date_partitioned(frame(spark).limit(0), path, ("event_id", "timestamp"))
    assert len(lake(spark, path)) == 5
    with pytest.raises(ValueError, match="no day"):
        merge_date_partitioned(late.withColumn("timestamp", F.lit(None).cast("timestamp")), path, ("event_id",))


def test_a_merge_that_was_cut_off_is_finished_by_the_next(spark, tmp_path, monkeypatch):
    path, key = str(tmp_path / "lake"), ("event_id", "timestamp")
    write_date_partitioned(frame(spark, (1, 1, 10), (3, 2, 30)), path)
    finish, calls = merge_module._finish, []

    def cut_off(session, root):
        calls.append(root)
        if len(calls) == 2:
            raise RuntimeError("driver lost")
        finish(session, root)
    monkeypatch.setattr(merge_module, "_finish", cut_off)
    with pytest.raises(RuntimeError):
        merge_date_partitioned(frame(spark, (4, 1, 40)), path, key)
    (tmp_path / "lake/_staging-half/year=2024/month=1/day=2").mkdir(parents=True)  # one that was not written to its end
    assert lake(spark, path) == [(1, 1, 10), (3, 2, 30)]
    merge_date_partitioned(frame(spark, (5, 2, 50)), path, key)
    assert lake(spark, path) == [(1, 1, 10), (3, 2, 30), (4, 1, 40), (5, 2, 50)]


def test_stored_sums_read_changed_days_only(spark, model, tmp_path):
    path, source = str(tmp_path / "sums"), str(tmp_path / "events")
    model.events.withColumn("d", F.to_date("timestamp")).write.partitionBy("d").parquet(source)
    events = spark.read.parquet(source).drop("d")
    changed = [dt.date(2024, 1, 3), dt.date(2024, 1, 9)]
    update_rollup(events.where(~F.to_date("timestamp").isin(changed)), path)
    parts = {p: p.stat().st_mtime_ns for p in (tmp_path / "sums").rglob("part-*")}
    update_rollup(events, path, changed)
    assert all(p.exists() and p.stat().st_mtime_ns == t for p, t in parts.items())  # other days lie as they lay
    for period in ("DAILY", "WEEKLY", "MONTHLY"):
        def tidy(report):
            return rows(report.withColumns({c: F.round(c, 6) for c in ("avg_speed", "congestion_score")}))
        assert tidy(report_from_rollup(read_rollup(spark, path), period)) == tidy(period_report(events, period))
    update_rollup(events.where(F.to_date("timestamp") != changed[0]), path, changed)
    assert read_rollup(spark, path).where(F.col("date") == F.lit(changed[0])).count() == 0
    pushed = plan(events.where((F.col("timestamp") >= F.lit("2024-01-03").cast("timestamp_ntz"))))
    assert "PushedFilters: [IsNotNull(timestamp), GreaterThanOrEqual(timestamp" in pushed


def test_latest_rows_do_not_depend_on_order_or_repeats(spark, tmp_path):
    def batch(*found):
        return spark.createDataFrame([(s, dt.datetime(2024, 1, 1, h), i) for s, h, i in found],
                                     "sensor_id string, timestamp timestamp, event_id long")
    batches = [batch(("a", 5, 1), ("b", 3, 2)), batch(("a", 4, 3), ("c", 1, 4)), batch(("b", 3, 9), ("a", 5, 0)), batch(("a", 6, 7))]
    for name, order in (("x", [0, 1, 2, 3]), ("y", [3, 2, 1, 0])):
        path = str(tmp_path / name)
        write = latest_rows_batches(path, "sensor_id", "timestamp", "event_id")
        with pytest.raises(FileNotFoundError):
            read_latest_rows(spark, path)
        for batch_id, which in enumerate(order):
            write(batches[which], batch_id)
            if batch_id:
                write(batches[which], batch_id)
        assert rows(read_latest_rows(spark, path).select("sensor_id", "event_id")) == [("a", 7), ("b", 9), ("c", 4)]
        assert len(list((tmp_path / name).glob("version=*"))) == 2
