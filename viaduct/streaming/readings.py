"""From message text to clean readings."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions import parse_ts, valid_coordinates
from ..operators.quality import CORRUPT, in_range, reading_error
from ..schemas import READING

EVENT_TIME = "timestamp_parsed"


def parse_messages(messages: DataFrame, schema: StructType) -> DataFrame:
    """JSON in `value` to columns. The message stays in `value`, and in `_corrupt_record` if it is bad.

    A field of the wrong type turns null and marks the record as corrupt, so route on the mark. The
    record is parsed inside a generator: a filter on its fields would else be pushed below the parsing
    and parse the text once more for each field it names.
    """
    marked = StructType([*schema.fields, StructField(CORRUPT, StringType(), True)])
    parsed = F.from_json("value", marked, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    fields = messages.select("value", F.inline(F.array(parsed)))
    return fields.select(*marked.names, "value")


def parse_readings(messages: DataFrame) -> DataFrame:
    """Sensor messages to the fields of a reading, plus its event time as an instant."""
    return parse_messages(messages, READING).transform(with_event_time)


def with_event_time(readings: DataFrame, ts: str = "timestamp") -> DataFrame:
    return readings.withColumn(EVENT_TIME, parse_ts(F.col(ts)))


def clean_stream(readings: DataFrame, max_speed: float | None = None, strict: bool = False) -> DataFrame:
    """Readings with a count and speed of 0 or more and coordinates on the globe. Keeps no state.

    `max_speed` adds a cap on the speed. A record that is no JSON has no count and goes; a mistyped field that no rule
    reads is null. `strict` leaves out all that `quarantine` takes: also readings without a sensor or a time.
    """
    if strict:
        kept = reading_error(readings, max_speed).isNull()
    else:
        kept = in_range(max_speed)
        if {"latitude", "longitude"} <= set(readings.columns):
            kept = kept & valid_coordinates(F.col("latitude"), F.col("longitude"))
    return readings.where(kept).drop(CORRUPT, "value")


def dedupe_stream(readings: DataFrame, keys: tuple[str, ...] = ("sensor_id", EVENT_TIME),
                  ts: str = EVENT_TIME, delay: str = "10 minutes") -> DataFrame:
    """One reading per key; state is dropped as the watermark passes.

    The time must be a `timestamp`; a batch frame is deduplicated as a whole.
    """
    if not readings.isStreaming:
        return readings.dropDuplicates(list(keys))
    return readings.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))


def dedupe_closed(readings: DataFrame, keys: tuple[str, ...] = ("sensor_id", EVENT_TIME),
                  ts: str = EVENT_TIME, delay: str = "10 minutes") -> DataFrame:
    """One reading per key, the smallest, given out once the watermark has passed its time.

    Other than with `dedupe_stream`, tasks reduce the copies of a key before the shuffle, so that a flood of one key
    in one batch stays spread over the tasks that read it and each sends one row on. The price is the wait for the
    watermark; `ts` must be one of the keys. A batch frame is deduplicated as a whole.
    """
    if ts not in keys:
        raise ValueError(f"{ts} must be one of the keys")
    rest = [c for c in readings.columns if c not in keys]
    timed = readings.withWatermark(ts, delay) if readings.isStreaming else readings
    if not rest:
        return timed.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).select(*readings.columns)
    first = timed.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("__first"))
    return first.select(*keys, "__first.*").select(*readings.columns)
