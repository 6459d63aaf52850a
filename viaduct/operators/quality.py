"""Validity rules, cleaning and quarantine. One set of rules serves batch and stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, functions as F

from ..functions import valid_coordinates
from ..session import shared_dir
from .dimensions import DEFAULT_LIMIT, BroadcastLimit, measure, within

CORE_COLUMNS = ("sensor_id", "vehicle_count", "average_speed_kmh", "timestamp")
MAX_SPEED_KMH = 200.0
CORRUPT = "_corrupt_record"


def core_present(columns=CORE_COLUMNS) -> Column:
    present = F.lit(True)
    for name in columns:
        present = present & F.col(name).isNotNull()
    return present


def in_range(max_speed: float | None = MAX_SPEED_KMH) -> Column:
    """Non-negative count and speed, and speed up to `max_speed` unless that is None."""
    speed = F.col("average_speed_kmh")
    rule = (F.col("vehicle_count") >= 0) & (speed >= 0)
    if max_speed is not None:
        rule = rule & (speed <= max_speed)
    return F.coalesce(rule, F.lit(False))


def drop_missing_core(df: DataFrame, columns=CORE_COLUMNS) -> DataFrame:
    return df.dropna(subset=list(columns))


def filter_ranges(df: DataFrame, max_speed: float | None = MAX_SPEED_KMH) -> DataFrame:
    return df.where(in_range(max_speed))


def filter_coordinates(df: DataFrame) -> DataFrame:
    """Drop readings off the globe; a frame without coordinates passes unchanged."""
    if not {"latitude", "longitude"} <= set(df.columns):
        return df
    return df.where(valid_coordinates(F.col("latitude"), F.col("longitude")))


def row_digest(df: DataFrame) -> list[Column]:
    """Two 64-bit hashes of a whole row, as `__digest_0` and `__digest_1`. A hash passes over nulls, so where they stand
    is hashed too."""
    nulls = F.concat(*[F.when(F.col(f"`{c}`").isNull(), "1").otherwise("0") for c in df.columns])
    return [F.xxhash64(F.lit(k), nulls, *[F.col(f"`{c}`") for c in df.columns]).alias(f"__digest_{k}") for k in (0, 1)]


def drop_exact_duplicates(df: DataFrame, limit: BroadcastLimit = DEFAULT_LIMIT) -> DataFrame:
    """Whole-row distinct, for tables most of whose rows are single.

    Only digests of rows go through a shuffle to find those that occur again; single rows stay where they are, and the
    distinct of whole rows runs over the rest. Rows with one digest are compared in full there, so chance hits change
    nothing. The digests are read from `df` when this is called, so it must give the same rows when read again. If too
    many digests are repeated for a broadcast, whole rows are compared at once: copies collapse before that shuffle.
    A stream keeps its rows in state.
    """
    if df.isStreaming:
        return df.dropDuplicates()
    names, keys = df.columns, ["__digest_0", "__digest_1"]
    shared_dir(df.sparkSession)
    repeated = (df.select(*row_digest(df)).groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
                .select(*keys).checkpoint())
    if not within(measure(repeated), limit):
        return df.dropDuplicates()
    marked = df.select("*", *row_digest(df)).join(
        F.broadcast(repeated.withColumn("__again", F.lit(True))), keys, "left")
    single = marked.where("__again IS NULL").select(*names)
    return single.unionByName(marked.where("__again").select(*names).dropDuplicates())


def clean_readings(df: DataFrame, max_speed: float | None = MAX_SPEED_KMH,
                   observe: tuple[Observation, Observation] | None = None,
                   core=CORE_COLUMNS) -> DataFrame:
    """Valid readings, each once.

    The row rules run before the distinct: the result is the same, and rows about to be dropped are
    not shuffled. `observe` takes two observations, filled with the row counts in and out when an
    action runs, so that no counting job is needed.
    """
    if observe:
        df = df.observe(observe[0], F.count(F.lit(1)).alias("rows"))
    kept = (df.transform(drop_missing_core, core)
            .transform(filter_coordinates)
            .transform(filter_ranges, max_speed)
            .transform(drop_exact_duplicates))
    if observe:
        kept = kept.observe(observe[1], F.count(F.lit(1)).alias("rows"))
    return kept


def reading_error(df: DataFrame, max_speed: float | None = None, core=CORE_COLUMNS) -> Column:
    """Why a reading is bad, or null for a good one. Rules on columns the frame lacks are left out.

    A record is malformed if it is no JSON or a core field or coordinate has the wrong type. Other fields of the wrong
    type are null, and the reading is good.
    """
    rules = []
    if CORRUPT in df.columns:
        read = [*core, *(c for c in ("latitude", "longitude") if c in df.columns)]
        rules.append((F.col(CORRUPT).isNotNull() & ~core_present(read), "malformed JSON"))
    rules.append((~core_present(core), "missing core field"))
    if "timestamp_parsed" in df.columns:
        rules.append((F.col("timestamp_parsed").isNull(), "bad timestamp"))
    if {"latitude", "longitude"} <= set(df.columns):
        rules.append((~valid_coordinates(F.col("latitude"), F.col("longitude")), "coordinates out of range"))
    rules.append((~in_range(max_speed), "count or speed out of range"))
    error = F.lit(None).cast("string")
    for broken, reason in reversed(rules):
        error = F.when(broken, F.lit(reason)).otherwise(error)
    return error


def quarantine(df: DataFrame, payload: str = "value", failed_at: Column | None = None,
               max_speed: float | None = None, core=CORE_COLUMNS) -> tuple[DataFrame, DataFrame]:
    """Split into good readings and dead letters `(original_payload, error, failed_at)`.

    `payload` names the column with the message as received; without one the row itself is kept as
    JSON. Both results are lazy, so the branches may feed different sinks.
    """
    original = F.col(payload) if payload in df.columns else F.to_json(F.struct(*df.columns))
    when = F.current_timestamp() if failed_at is None else failed_at
    marked = df.withColumn("__error", reading_error(df, max_speed, core))
    good = marked.where(F.col("__error").isNull()).drop("__error", CORRUPT, payload)
    bad = marked.where(F.col("__error").isNotNull()).select(
        original.alias("original_payload"), F.col("__error").alias("error"), when.alias("failed_at"))
    return good, bad
