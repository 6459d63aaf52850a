"""The jobs, composed of the library's operators, and the named views. Sources, targets and times are arguments."""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from . import forecast
from .operators.features import clean_and_derive
from .operators.reports import daily_report, road_congestion_summary
from .operators.serving import current_status
from .sinks import merge_date_partitioned, write_date_partitioned


def register_views(spark: SparkSession, tables: dict[str, DataFrame], as_of: dt.datetime | Column | None = None,
                   hours: int = 24) -> None:
    """The tables as temporary views under their names, and over them `v_current_traffic_status` (latest reading of
    each sensor) and `v_road_congestion_summary` (per road, the `hours` before `as_of`, which is now unless given).

    `tables` holds traffic_events, roads, sensor_locations and weather_data; others are registered as they are.
    """
    for name, frame in tables.items():
        frame.createOrReplaceTempView(name)
    events, roads = tables["traffic_events"], tables["roads"]
    status = current_status(events, tables["sensor_locations"], roads, tables["weather_data"])
    status.createOrReplaceTempView("v_current_traffic_status")
    since = F.current_timestamp() if as_of is None else as_of
    road_congestion_summary(events, roads, as_of=since, hours=hours).createOrReplaceTempView("v_road_congestion_summary")


def run_daily_report(events: DataFrame, report_date: dt.date, target: str, created_at: dt.datetime) -> DataFrame:
    """Append the report of a day to the Parquet table `target`, with ids that go on from its last, and return the
    rows that were added. A report that the table already holds for that day is not written again."""
    spark = events.sparkSession
    report = daily_report(events, report_date)
    try:
        held = spark.read.parquet(target)
        last = held.agg(F.coalesce(F.max("report_id"), F.lit(0)).alias("id")).first()["id"]
        report = report.join(held.select("report_type", "report_date", "road_id"),
                             ["report_type", "report_date", "road_id"], "left_anti").select(*report.columns)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        last = 0
    # One row per road: a window over all of them is as small as the table of roads.
    by_road = Window.orderBy("report_type", "report_date", "road_id")
    numbered = report.select((F.row_number().over(by_road) + last).cast("long").alias("report_id"), "*",
                             F.lit(created_at).alias("created_at"))
    numbered.write.mode("append").parquet(target)
    return spark.read.parquet(target).where(F.col("report_id") > last)


def run_etl(raw: DataFrame, target: str, ts: str = "timestamp", key: tuple[str, ...] | None = None) -> DataFrame:
    """Raw readings to the lake by day, cleaned and enriched; returns the days they touched, as they are then.

    With a key late readings are merged into their days. Without one the batch takes the place of the days it holds.
    """
    clean = clean_and_derive(raw)
    if key is None:
        write_date_partitioned(clean, target, ts)
    else:
        merge_date_partitioned(clean, target, key, ts)
    days = raw.select(F.to_date(ts).alias("__day")).distinct()  # bounded by the calendar
    lake = raw.sparkSession.read.parquet(target)
    return lake.join(F.broadcast(days), F.make_date("year", "month", "day") == F.col("__day"), "left_semi")


def run_training(events: DataFrame, roads: DataFrame, weather: DataFrame, path: str, trained_at: dt.datetime,
                 regressors: dict | None = None) -> forecast.TrainedModels:
    """Build and split the training rows, fit all regressors, and save the best with its measures."""
    rows = forecast.prepare_features(forecast.build_training_set(events, roads, weather), keep=("event_id",))
    trained = forecast.train_models(*forecast.split(rows, "event_id"), regressors)
    measures = next(r.asDict() for r in trained.metrics.collect() if r["model_name"] == trained.best_name)
    forecast.save_model(trained.best, path, name=trained.best_name, trained_at=trained_at,
                        metrics={k: v for k, v in measures.items() if k != "model_name"})
    return trained
