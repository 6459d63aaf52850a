import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import plan, rows
from viaduct.operators import reports, serving
from viaduct.operators.dimensions import DEFAULT_LIMIT, BroadcastLimit

EVENTS = "event_id long, sensor_id string, road_id int, timestamp timestamp_ntz, vehicle_count int, " \
         "average_speed_kmh double, congestion_index double, congestion_level string, weather_id long, hour int, " \
         "day_of_week int"


def event(i, road=1, sensor="S1", at="2024-01-01 08:00:00", vehicles=10, speed=30.0, index=0.5, level="HIGH", weather=None):
    when = dt.datetime.fromisoformat(at)
    return (i, sensor, road, when, vehicles, speed, index, level, weather, when.hour, when.weekday())


@pytest.fixture(scope="module")
def roads(spark):
    return spark.createDataFrame([(1, "North", 50, 2), (2, "South", 80, 3)],
                                 "road_id int, road_name string, speed_limit_kmh int, num_lanes int")


@pytest.fixture(scope="module")
def weather(spark):
    return spark.createDataFrame([(7, "Sunny", 20.0)], "weather_id long, weather_condition string, temperature_celsius double")


@pytest.fixture(scope="module")
def sensors(spark):
    return spark.createDataFrame([("S1", 30.0, 31.0, True), ("S2", 30.1, 31.1, False), ("S3", 30.2, 31.2, True)],
                                 "sensor_id string, latitude double, longitude double, is_active boolean")


@pytest.fixture(scope="module")
def events(spark):
    return spark.createDataFrame([
        event(1, vehicles=10, speed=20.0, index=0.6),
        event(2, at="2024-01-01 17:00:00", vehicles=10, speed=40.0, index=0.2, level="LOW"),
        event(3, road=2, sensor="S2", at="2024-01-02 00:00:00", vehicles=5, speed=79.0, index=0.5, weather=7),
        event(4, road=2, sensor="S2", at="2024-01-02 00:00:00", vehicles=7, speed=10.0, index=0.875, level="CRITICAL", weather=8),
        event(5, road=9, sensor="S2", at="2024-01-03 00:00:00", vehicles=99),
    ], EVENTS)


def test_daily_report_takes_the_earliest_of_equal_peaks(events):
    report = reports.daily_report(events.where("road_id < 9"), dt.date(2024, 1, 5))
    assert report.columns == ["report_type", "report_date", "road_id", "avg_speed", "total_vehicles", "peak_hour",
                              "congestion_hours", "congestion_score"]
    day = dt.date(2024, 1, 5)
    assert rows(report) == [("DAILY", day, 1, 30.0, 20, 8, 1, 0.4), ("DAILY", day, 2, 44.5, 12, 0, 1, 0.6875)]


def test_peak_hour_ties(events):
    assert rows(reports.peak_hour(events).where("road_id = 1")) == [(1, 8)]
    assert rows(reports.peak_hour(events, keep_ties=True).where("road_id = 1")) == [(1, 17), (1, 8)]


def test_report_equals_its_parts(events):
    from viaduct.operators.joins import join_stats_peak
    parts = join_stats_peak(reports.road_daily_stats(events), reports.peak_hour(events))
    whole = reports.daily_report(events, dt.date(2024, 1, 5))
    columns = ["road_id", "avg_speed", "total_vehicles", "peak_hour", "congestion_hours", "congestion_score"]
    assert rows(parts.select(columns)) == rows(whole.select(columns))


@pytest.mark.parametrize("period, starts", [
    ("DAILY", ["2024-01-01", "2024-01-02", "2024-01-03"]), ("WEEKLY", ["2024-01-01"]), ("MONTHLY", ["2024-01-01"])])
def test_periods(events, period, starts):
    report = reports.period_report(events, period)
    assert sorted({str(r.report_date) for r in report.collect()}) == starts
    assert {r.report_type for r in report.collect()} == {period}


def test_report_reads_once_and_shuffles_sums_only(model):
    text = plan(reports.daily_report(model.events, dt.date(2024, 1, 5)))
    assert text.count("events.parquet") == 1
    assert text.count("Exchange hashpartitioning") == 2
    assert text.index("partial_sum") > 0


def test_summary_with_and_without_lookback(events, roads):
    assert rows(reports.road_congestion_summary(events, roads)) == [
        ("North", 50, 30.0, 10.0, 0.4, 0), ("South", 80, 44.5, 6.0, 0.69, 1)]
    recent = reports.road_congestion_summary(events, roads, as_of=F.to_timestamp_ntz(F.lit("2024-01-02 12:00:00")))
    assert rows(recent) == [("North", 50, 40.0, 10.0, 0.2, 0), ("South", 80, 44.5, 6.0, 0.69, 1)]


def test_lookback_reaches_the_scan(model):
    from viaduct.plans.reports import AS_OF
    from viaduct.plans.model import at
    filtered = reports.lookback_filter(model.raw_events, at(AS_OF))
    assert "PushedFilters: [IsNotNull(ts), GreaterThan(ts,2024-01-29T12:00)]" in plan(filtered)


def test_profile_heatmap_and_volume(events, roads):
    assert rows(reports.hourly_profile(events, roads)) == [(0, "South", 6.0), (17, "North", 10.0), (8, "North", 10.0)]
    heat = reports.congestion_heatmap(events, roads)
    assert heat.columns == ["road_name"] + [f"h{h:02d}" for h in range(24)]
    assert {r.road_name: (r.h00, r.h08, r.h17) for r in heat.collect()} == {
        "North": (None, 0.6, 0.2), "South": (0.6875, None, None)}
    assert rows(reports.volume_by_road_level(events, roads)) == [
        ("North", "HIGH", 10), ("North", "LOW", 10), ("South", "CRITICAL", 7), ("South", "HIGH", 5)]


def test_kpis_and_shares(events, roads):
    named = events.join(roads, "road_id")
    assert rows(reports.network_kpis(named)) == [(32, 37.2, 3, 2)]
    assert rows(reports.level_distribution(named)) == [("CRITICAL", 1, 0.25), ("HIGH", 2, 0.5), ("LOW", 1, 0.25)]
    assert rows(reports.distinct_values(events, "congestion_level")) == [("CRITICAL",), ("HIGH",), ("LOW",)]
    assert rows(reports.network_kpis(named.limit(0))) == [(None, None, 0, 0)]


@pytest.mark.parametrize("limit", [DEFAULT_LIMIT, BroadcastLimit(rows=0)])
def test_current_status(events, sensors, roads, weather, limit):
    status = serving.current_status(events, sensors, roads, weather, limit=limit)
    found = {r.sensor_id: r for r in status.collect()}
    # Two readings of S2 share the latest instant on a known road; the one on road 9 does not count.
    assert set(found) == {"S1", "S2"}
    assert (found["S2"].vehicle_count, found["S2"].weather_condition, found["S2"].road_name) == (7, None, "South")
    assert found["S1"].timestamp == dt.datetime(2024, 1, 1, 17)
    assert [r.sensor_id for r in serving.critical_nodes(status).collect()] == ["S2"]


def test_latest_and_trend(events, roads, weather):
    latest = serving.latest_events(events, roads, weather, rows=2)
    assert [(r.event_id, r.weather_condition) for r in latest.orderBy(F.desc("event_id")).collect()] == [(4, None), (3, "Sunny")]
    assert serving.telemetry_feed(latest).columns == [
        "road_name", "vehicle_count", "average_speed_kmh", "congestion_level", "weather_condition", "timestamp"]
    assert rows(serving.volume_trend(events, roads, ["South"], rows=3).select("event_id")) == [(3,)]
    assert rows(serving.volume_trend(events, roads).select("event_id")) == [(1,), (2,), (3,), (4,)]
    daily = serving.volume_trend_by(events, roads, "day")
    assert rows(daily) == [("North", dt.datetime(2024, 1, 1), 20), ("South", dt.datetime(2024, 1, 2), 12)]


def test_search_matches_any_column_in_any_case(events):
    found = lambda term: sorted(r.event_id for r in serving.search_rows(events, term).collect())
    assert found("crit") == [4] and found("^s2$") == [3, 4, 5] and found("99|low") == [2, 5] and found("nan|null") == []


def test_preview_and_health(spark, events, sensors):
    tables = {"traffic_events": events}
    assert rows(serving.preview_table(tables, "traffic_events", 2, key="event_id").select("event_id")) == [(1,), (2,)]
    with pytest.raises(ValueError):
        serving.preview_table(tables, "users; drop table roads")
    as_of = F.to_timestamp_ntz(F.lit("2024-01-03 01:00:00"))
    health = serving.sensor_health(sensors, events, as_of).first()
    assert (health.sensors, health.active, health.active_share, health.silent) == (3, 2, pytest.approx(2 / 3), 2)
    assert sorted(r.sensor_id for r in serving.silent_sensors(sensors, events, as_of).collect()) == ["S1", "S3"]


def test_ride_demand(spark):
    rides = spark.createDataFrame([(1, dt.datetime(2024, 1, 1, 8, 5), "COMPLETED"), (1, dt.datetime(2024, 1, 2, 8, 50), "COMPLETED")],
                                  "pickup_road_id int, timestamp timestamp_ntz, status string")
    assert rows(reports.ride_demand(rides)) == [(1, 8, "COMPLETED", 2)]
