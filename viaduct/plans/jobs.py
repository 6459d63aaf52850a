"""Queries over the named views, and over what the jobs wrote."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from .. import forecast, jobs
from ..functions import round_numeric
from ..session import shared_path
from .catalog import ORACLES, query, rounded
from .forecasts import IN_TEST, TRAINING_SQL
from .model import at
from .reports import AS_OF, REPORT_DAY, _report_sql, _rounded
from .scalars import DERIVED_COLUMNS

CREATED = dt.datetime(2024, 2, 1)


def _registered(m):
    jobs.register_views(m.spark, {"traffic_events": m.events, "roads": m.roads, "sensor_locations": m.sensors,
                                  "weather_data": m.weather}, as_of=at(AS_OF))
    return m.spark


@query("view_current_status")
def view_current_status(m):
    return _registered(m).sql("SELECT * FROM v_current_traffic_status")


@query("view_road_congestion_summary")
def view_road_congestion_summary(m):
    return _registered(m).sql("SELECT * FROM v_road_congestion_summary")


ORACLES["view_current_status"] = ORACLES["current_status"]
ORACLES["view_road_congestion_summary"] = ORACLES["road_congestion_summary_last_day"]


@query("job_daily_report", f"""
SELECT row_number() OVER (ORDER BY road_id) AS report_id, *, TIMESTAMP '2024-02-01 00:00:00' AS created_at
FROM ({_report_sql("DAILY", "DATE '2024-01-31'")})""")
def job_daily_report(m):
    """Run twice: the second run finds the day in the table and adds nothing."""
    target = shared_path(m.spark, "batch-reports")
    for _ in range(2):
        jobs.run_daily_report(m.events, REPORT_DAY, target, CREATED)
    written = _rounded(m.spark.read.parquet(target), "avg_speed", "congestion_score")
    return written.withColumn("created_at", F.col("created_at").cast("timestamp_ntz"))


@query("job_etl")
def job_etl(m):
    return jobs.run_etl(m.readings, shared_path(m.spark, "etl")).select(*DERIVED_COLUMNS)


ORACLES["job_etl"] = ORACLES["clean_and_derive"]


@query("job_etl_late")
def job_etl_late(m):
    """Every fifth reading comes late, in a second run that is then repeated."""
    target, key = shared_path(m.spark, "etl"), ("event_id", "timestamp")
    late = F.col("event_id") % 5 == 0
    for batch in (m.readings.where(~late), m.readings.where(late), m.readings.where(late)):
        jobs.run_etl(batch, target, key=key)
    return m.spark.read.parquet(target).select(*DERIVED_COLUMNS)


ORACLES["job_etl_late"] = ORACLES["clean_and_derive"]


@query("job_training", f"""
SELECT event_id, {rounded("40.137e0 + 3 * hour + 2 * average_speed_kmh", 4)} AS prediction,
       'linear_regression' AS best_algorithm, 1e0 AS r2, 4 AS models
FROM {TRAINING_SQL} WHERE {IN_TEST}""")
def job_training(m):
    """All four regressors at full size on a label that is linear; the model read back scores the test rows."""
    path = shared_path(m.spark, "training")
    events = m.events.withColumn("vehicle_count", F.expr("40.137D + 3 * hour + 2 * average_speed_kmh"))
    trained = jobs.run_training(events, m.roads, m.weather, path, CREATED)
    model, record = forecast.load_model(m.spark, path)
    rows = forecast.prepare_features(forecast.build_training_set(events, m.roads, m.weather), keep=("event_id",))
    scored = model.transform(forecast.split(rows, "event_id")[1])
    return scored.select("event_id", round_numeric(F.col("prediction"), 4).alias("prediction"),
                         F.lit(record["best_algorithm"]).alias("best_algorithm"),
                         F.lit(round(record["metrics"]["R2"], 6)).alias("r2"), F.lit(len(trained.models)).alias("models"))
