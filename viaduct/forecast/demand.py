"""Ride demand: how many rides start on each road, and how many will.

Forecasts start from a dense panel, a row per road and step of time also where no ride was asked for, so that lags and
rolling frames count steps and not rides. Each road has its own window, as long as the calendar. A rolling origin cuts
the panel into what is known at a time and the steps after it, so that no forecast sees what it is to forecast.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from .features import LABEL

LAGS = (1, 7, 14, 21, 28)
FRAMES = (7, 28)
DEMAND_FEATURES = tuple(f"lag_{k}" for k in LAGS) + tuple(f"mean_{k}" for k in FRAMES)


def demand_panel(rides: DataFrame, roads: DataFrame, since: dt.datetime, until: dt.datetime, ts: str = "timestamp",
                 step: str = "1 day") -> DataFrame:
    """(road_id, at, rides) for every road and step from `since` to `until`, both included.

    Rides are counted per road and step before they meet the panel; a ride on an unknown road is not in it.
    """
    zone_free = rides.schema[ts].dataType.simpleString() == "timestamp_ntz"
    first, last = (F.to_timestamp_ntz(F.lit(str(t))) if zone_free else F.to_timestamp(F.lit(str(t))) for t in (since, until))
    steps = roads.select("road_id", F.explode(F.sequence(first, last, F.expr(f"INTERVAL {step}"))).alias("at"))
    seconds = F.unix_seconds(F.col(ts).cast("timestamp")) - F.unix_seconds(first.cast("timestamp"))
    number = F.floor(seconds / _seconds(step)).cast("int")
    counted = (rides.where((F.col(ts) >= first) & (F.col(ts) < last + F.expr(f"INTERVAL {step}")))
               .select(F.col("pickup_road_id").alias("road_id"), (first + number * F.expr(f"INTERVAL {step}")).alias("at"))
               .groupBy("road_id", "at").agg(F.count(F.lit(1)).alias("rides")))
    return steps.join(counted, ["road_id", "at"], "left").select(
        "road_id", "at", F.coalesce("rides", F.lit(0)).cast("long").alias("rides"))


def _seconds(step: str) -> int:
    number, unit = step.split()
    return int(number) * {"hour": 3600, "day": 86_400}[unit.rstrip("s")]


def demand_features(panel: DataFrame) -> DataFrame:
    """The panel with `lag_k`, the rides k steps before, and `mean_k`, their mean over the k steps before; null where
    the panel does not reach back so far."""
    steps = Window.partitionBy("road_id").orderBy("at")

    def mean(k: int) -> Column:
        frame = steps.rowsBetween(-k, -1)
        return F.when(F.count(F.lit(1)).over(frame) == k, F.sum("rides").over(frame) / k)
    return panel.select("*", *[F.lag("rides", k).over(steps).alias(f"lag_{k}") for k in LAGS],
                        *[mean(k).alias(f"mean_{k}") for k in FRAMES])


def rolling_origins(features: DataFrame, origins: list[dt.datetime], steps: int, step: str = "1 day") -> DataFrame:
    """The rows once per origin, with `origin` and `is_test`: false before the origin, true in the `steps` steps from
    it on; rows after these are left out."""
    zone_free = features.schema["at"].dataType.simpleString() == "timestamp_ntz"
    if not origins:
        raise ValueError("no origin")
    parts = []
    for origin in origins:
        start = F.to_timestamp_ntz(F.lit(str(origin))) if zone_free else F.to_timestamp(F.lit(str(origin)))
        end = start + F.expr(f"INTERVAL {_seconds(step) * steps} SECONDS")
        parts.append(features.where(F.col("at") < end).select(
            "*", start.alias("origin"), (F.col("at") >= start).alias("is_test")))
    return reduce(DataFrame.unionAll, parts)


def weekly_rule(features: DataFrame) -> DataFrame:
    """Adds `predicted_count`: the mean of the same weekday in the four weeks before."""
    return features.withColumn("predicted_count", (F.col("lag_7") + F.col("lag_14") + F.col("lag_21") + F.col("lag_28")) / 4)


def as_training_rows(features: DataFrame) -> DataFrame:
    """Rows with all features, the rides as the label of the regressors."""
    return features.dropna(subset=list(DEMAND_FEATURES)).withColumn(LABEL, F.col("rides").cast("double"))


def with_demand_actuals(predictions: DataFrame, panel: DataFrame) -> DataFrame:
    """Recorded RIDE_DEMAND predictions with the rides of the step they were made for, and their error."""
    aim = F.col("predicted_at") + F.make_dt_interval(mins=F.col("prediction_horizon_minutes"))
    met = panel.select("road_id", F.col("at").alias("__at"), F.col("rides").cast("int").alias("actual_vehicle_count"))
    joined = predictions.withColumn("__at", aim.cast(panel.schema["at"].dataType)).join(met, ["road_id", "__at"], "left")
    error = F.abs(F.col("predicted_vehicle_count") - F.col("actual_vehicle_count")).cast("double")
    return joined.select(*predictions.columns, "actual_vehicle_count", error.alias("rmse"))
