"""Scoring tables with a fitted model, or with the capacity rule where there is none."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, functions as F

from .. import functions as V
from .features import FEATURES, SCALED, VECTOR

# Fixed values of the traffic model: features a row does not supply.
FEATURE_DEFAULTS = {
    "hour": 12, "day_of_week": 0, "month": 6, "is_weekend": False, "is_rush_hour": False,
    "temperature_celsius": 25.0, "humidity_percent": 50.0, "average_speed_kmh": 60.0,
    "num_lanes": 3, "speed_limit_kmh": 60,
}
COUNT = "predicted_count"


def fill_feature_defaults(df: DataFrame) -> DataFrame:
    return df.withColumns({
        name: F.coalesce(F.col(name), F.lit(value).cast(df.schema[name].dataType)) if name in df.columns
        else F.lit(value) for name, value in FEATURE_DEFAULTS.items()})


def score_vehicle_count(df: DataFrame, model: PipelineModel | None = None) -> DataFrame:
    """Add `predicted_count`, a double that is never negative."""
    filled = fill_feature_defaults(df)
    if model is None:
        return filled.withColumn(COUNT, V.rule_vehicle_count(
            F.col("hour"), F.col("num_lanes"), F.col("is_rush_hour"), F.col("is_weekend")))
    # The model's inputs are doubles; the row keeps its own types.
    numbers = F.struct(*[F.col(name).cast("double").alias(name) for name in FEATURES])
    rows = filled.select(F.struct(*filled.columns).alias("__row"), numbers.alias("__x")).select("__row", "__x.*")
    scored = model.transform(rows).drop(VECTOR, SCALED)
    return scored.select("__row.*", F.greatest(F.lit(0.0), F.col("prediction")).alias(COUNT))


def score_congestion(df: DataFrame, model: PipelineModel | None = None) -> DataFrame:
    """Add the predicted count, speed, congestion index and level."""
    scored = score_vehicle_count(df, model)
    limit = F.col("speed_limit_kmh")
    speed = V.expected_speed(F.col(COUNT), F.col("num_lanes"), limit)
    index = V.congestion_index(F.col("__speed"), limit)
    return (scored.withColumn("__speed", speed).withColumn("__index", index).withColumns({
        "predicted_vehicle_count": F.col(COUNT).cast("int"),
        "predicted_average_speed": V.round_half_even(F.col("__speed"), 1),
        "predicted_congestion_index": V.round_half_even(F.col("__index"), 2),
        "predicted_congestion_level": V.congestion_level(F.col("__index")),
    }).drop("__speed", "__index", COUNT))


def forecast_24h(df: DataFrame, model: PipelineModel | None = None) -> DataFrame:
    """Each row for every hour of the day: its label and predicted vehicles.

    The rush flag follows the hour; all other features stay as they are.
    """
    hours = df.drop("hour", "is_rush_hour").withColumn("hour", F.explode(F.sequence(F.lit(0), F.lit(23))))
    scored = score_vehicle_count(hours.withColumn("is_rush_hour", V.is_rush_hour(F.col("hour"))), model)
    return scored.withColumns({
        "hour_label": V.hour_label(F.col("hour")),
        "predicted_vehicles": F.col(COUNT).cast("int"),
    }).drop(COUNT)
