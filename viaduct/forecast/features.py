"""Training rows, features and the train/test split."""

from __future__ import annotations

from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from ..operators.dimensions import DEFAULT_LIMIT, BroadcastLimit
from ..operators.joins import join_roads, join_weather_inner

# Fixed values of the traffic model: the inputs of a forecast, in order, and what it forecasts.
FEATURES = (
    "hour", "day_of_week", "month", "is_weekend", "is_rush_hour", "temperature_celsius",
    "humidity_percent", "average_speed_kmh", "num_lanes", "speed_limit_kmh",
)
LABEL = "vehicle_count"
# Names a raw reading uses for the same measure.
RAW_NAMES = {"temperature": "temperature_celsius", "humidity": "humidity_percent"}
VECTOR, SCALED = "raw_features", "features"


def build_training_set(events: DataFrame, roads: DataFrame, weather: DataFrame,
                       limit: BroadcastLimit = DEFAULT_LIMIT) -> DataFrame:
    """Readings with their road and the weather recorded for them; both must exist."""
    return join_weather_inner(join_roads(events, roads, limit), weather, limit)


def prepare_features(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The features as doubles and the label, without rows that lack one; `keep` passes through."""
    df = df.withColumns({name: F.col(raw) for raw, name in RAW_NAMES.items() if raw in df.columns})
    numbers = [F.col(c).cast("double").alias(c) for c in FEATURES if c not in keep]
    label = [] if LABEL in keep else [F.col(LABEL).cast("double").alias(LABEL)]
    return df.select(*keep, *numbers, *label).dropna(subset=[*FEATURES, LABEL])


def feature_stages(features: tuple[str, ...] = FEATURES) -> list:
    """Assemble and standardise. As pipeline stages they are fitted on the training rows alone."""
    return [
        VectorAssembler(inputCols=list(features), outputCol=VECTOR),
        StandardScaler(inputCol=VECTOR, outputCol=SCALED, withMean=True, withStd=True),
    ]


def standardized(prepared: DataFrame, keep: tuple[str, ...] = (),
                 features: tuple[str, ...] = FEATURES) -> DataFrame:
    """Each feature less its mean, over its standard deviation, as columns `z_<feature>`."""
    assembler, scaler = feature_stages(features)
    assembled = assembler.transform(prepared)
    scaled = scaler.fit(assembled).transform(assembled).withColumn("__z", vector_to_array(SCALED))
    return scaled.select(*keep, *[F.col("__z")[i].alias(f"z_{name}") for i, name in enumerate(features)])


def bucket_of(key: Column, buckets: int, seed: int = 42) -> Column:
    """A number below `buckets` that depends on the key and the seed only."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % buckets


def split(df: DataFrame, key: str, test_percent: int = 20, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Training and test rows by a hash of the key.

    A row stays on its side however the data is partitioned, ordered or read again.
    """
    bucket = bucket_of(F.col(key), 100, seed)
    return df.where(bucket >= test_percent), df.where(bucket < test_percent)
