"""Readings that wait for their weather, where both come as streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

HOUR = 3600


def join_weather_streams(readings: DataFrame, weather: DataFrame, key: tuple[str, ...], *, ts: str = "timestamp",
                         weather_ts: str = "timestamp", max_age_hours: int = 3, delay: str = "10 minutes",
                         weather_delay: str = "10 minutes", tie_break: str = "weather_id") -> DataFrame:
    """Each reading with the latest weather at or before it that is younger than `max_age_hours`, or with none.

    A left outer join on bounds of the event times, both sides under a watermark: a reading stays in state until no
    weather that it could meet can still come, whichever of the two topics lags. Of the weather it met the latest is
    kept, and the reading is given out once both watermarks have passed it. `key` and the time tell readings apart.
    Weather is repeated for the hours that it may serve, so that the join has an equal key; what is kept of it in state
    grows with `max_age_hours`, not with its history. Columns of weather that clash get `_weather`.
    """
    clashes = {c: f"{c}_weather" for c in weather.columns if c in readings.columns}
    weather_ts, tie_break = clashes.get(weather_ts, weather_ts), clashes.get(tie_break, tie_break)
    weather = weather.withColumnsRenamed(clashes)
    names = weather.columns
    age = F.expr(f"INTERVAL {max_age_hours} HOURS")
    first = F.floor(F.unix_seconds(weather_ts) / HOUR)
    timed = weather.withWatermark(weather_ts, weather_delay).withColumn(
        "__hour", F.explode(F.sequence(first, first + max_age_hours)))
    waiting = readings.withWatermark(ts, delay).withColumn("__own_hour", F.floor(F.unix_seconds(ts) / HOUR))
    within = ((F.col("__own_hour") == F.col("__hour")) & (F.col(weather_ts) <= F.col(ts))
              & (F.col(weather_ts) > F.col(ts) - age))
    met = waiting.join(timed, within, "leftOuter")
    own = [c for c in readings.columns if c not in (*key, ts)]
    found = met.groupBy(*key, ts).agg(F.first(F.struct(*own)).alias("__reading"),
                                      F.max(F.struct(weather_ts, tie_break, F.struct(*names).alias("all"))).alias("__met"))
    return found.select(*key, ts, "__reading.*", *[F.col(f"__met.all.{c}").alias(c) for c in names]).select(
        *readings.columns, *names)
