"""Keeping predictions and, later, what really happened."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .. import functions as V

PREDICTION_TYPES = ("CONGESTION", "VEHICLE_COUNT", "RIDE_DEMAND")


def record_predictions(scored: DataFrame, *, model_name: str, prediction_type: str, predicted_at: Column,
                       horizon_minutes: int) -> DataFrame:
    """Scored rows as rows of the predictions table, the actuals still open."""
    if prediction_type not in PREDICTION_TYPES:
        raise ValueError(f"prediction type {prediction_type!r} is not one of {PREDICTION_TYPES}")
    def own(name: str, as_type: str, source: str | None = None) -> Column:
        source = source or name
        return (F.col(source) if source in scored.columns else F.lit(None)).cast(as_type).alias(name)
    return scored.select(
        F.lit(model_name).alias("model_name"), F.lit(prediction_type).alias("prediction_type"),
        own("road_id", "int"), own("sensor_id", "string"), predicted_at.alias("predicted_at"),
        F.lit(horizon_minutes).alias("prediction_horizon_minutes"),
        own("predicted_vehicle_count", "int"), own("predicted_congestion_level", "string"),
        own("predicted_avg_speed", "double", "predicted_average_speed"), own("confidence_score", "double"))


def with_actuals(predictions: DataFrame, events: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Add the observed count and level for the hour each prediction was made for, and its error.

    The readings of a road and hour are averaged before the join, so the join sees one row per road
    and hour. Predictions whose hour has no reading keep empty actuals.
    """
    at = F.date_trunc("hour", ts)
    observed = events.groupBy("road_id", at.alias("__hour")).agg(
        F.avg("vehicle_count").alias("__count"), F.avg("congestion_index").alias("__index"))
    observed = observed.select("road_id", "__hour",
                               F.round("__count").cast("int").alias("actual_vehicle_count"),
                               V.congestion_level(V.round_numeric(F.col("__index"), 9)).alias("actual_congestion_level"))
    aim = F.col("predicted_at") + F.make_dt_interval(mins=F.col("prediction_horizon_minutes"))
    joined = predictions.withColumn("__hour", F.date_trunc("hour", aim)).join(observed, ["road_id", "__hour"], "left")
    error = F.abs(F.col("predicted_vehicle_count") - F.col("actual_vehicle_count")).cast("double")
    return joined.withColumn("rmse", error).drop("__hour").select(
        *predictions.columns, "actual_vehicle_count", "actual_congestion_level", "rmse")
