"""As-of join: the latest observation at or before each event.

Observations become validity intervals `[from, until)`. Both sides are keyed by a time bucket, so
the join is an equi-join on the bucket plus a range filter, and an event meets only the handful of
intervals of its own bucket. Buckets follow the observations: quantiles of their times bound cells that
hold equally many of them, and each cell is cut into as many buckets, so a burst after a long gap does
not share one. No window runs over the whole series: successors are found within a day, and across days
from one row per day.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import shared_dir
from .dimensions import DEFAULT_LIMIT, BroadcastLimit, measure, row_bytes

# Buckets over which events later than the last observation are spread.
TAIL_BUCKETS = 64
# Quantiles of the observations' times. They travel with the query as one array.
CELLS = 1024
_FROM, _UNTIL, _BUCKET = "__valid_from", "__valid_until", "__bucket"


def latest_per_instant(series: DataFrame, ts: str, tie_break: str, by: tuple[str, ...] = ()) -> DataFrame:
    """Keep one row per series and instant, the one with the greatest `tie_break`."""
    picked = series.groupBy(*by, ts).agg(F.max_by(F.struct(*series.columns), F.col(tie_break)).alias("__row"))
    return picked.select("__row.*")


def validity_intervals(series: DataFrame, ts: str, by: tuple[str, ...] = ()) -> DataFrame:
    """Add `[__valid_from, __valid_until)` to each row; the last row of a series stays open.

    Rows of one series must differ in time (see `latest_per_instant`).
    """
    dated = series.withColumns({"__day": F.to_date(ts), _FROM: F.col(ts)})
    in_day = Window.partitionBy(*by, "__day").orderBy(_FROM)
    # One row per series and day: bounded by the calendar, not by the number of observations.
    days = dated.groupBy(*by, "__day").agg(F.min(_FROM).alias("__first"))
    over_days = Window.partitionBy(*(by or [F.lit(0)])).orderBy("__day")
    days = days.select(*by, "__day", F.lead("__first").over(over_days).alias("__next_day"))
    return (dated.withColumn("__next", F.lead(_FROM).over(in_day))
            .join(days, [*by, "__day"])
            .withColumn(_UNTIL, F.coalesce("__next", "__next_day"))
            .drop("__day", "__next", "__next_day"))


class _EvenBuckets:
    """Buckets of a given width."""

    def __init__(self, seconds: int, first_micros: int, last_micros: int):
        self.seconds = seconds
        self.first, self.last = (micros // 1_000_000 // seconds for micros in (first_micros, last_micros))

    def of(self, ts: Column) -> Column:
        return F.floor(F.unix_seconds(ts.cast("timestamp")) / self.seconds)


class _CellBuckets:
    """Cells between quantiles of the observations' times, each cut into `parts` buckets of one width.

    `bounds` are microseconds, ascending; the first is the first observation's time."""

    def __init__(self, bounds: list[int], last_micros: int, observations: int):
        self.bounds = [*bounds, last_micros + 1]
        self.parts = max(1, -(-observations // len(bounds)))
        self.first, self.last = 0, len(bounds) * self.parts - 1

    def of(self, ts: Column) -> Column:
        """-1 before the first observation, from last + 1 on after the last. The cell is found by halving the array;
        a time is looked at as one value, so that it is computed once."""
        micros = F.unix_micros(ts.cast("timestamp"))
        cells = len(self.bounds) - 1
        bounds = F.lit(self.bounds)

        def halve(range_: Column, _) -> Column:
            middle = F.floor((range_["low"] + range_["past"]) / 2).cast("int")
            up = range_["at"] >= F.get(bounds, middle)
            open_ = range_["past"] - range_["low"] > 1
            return F.struct(F.when(open_ & up, middle).otherwise(range_["low"]).alias("low"),
                            F.when(open_ & ~up, middle).otherwise(range_["past"]).alias("past"),
                            range_["at"].alias("at"))

        def bucket(range_: Column) -> Column:
            cell, at = range_["low"], range_["at"]
            low, past = F.get(bounds, cell), F.get(bounds, cell + 1)
            part = F.floor((at - low) * F.lit(float(self.parts)) / F.greatest(past - low, F.lit(1)))
            inside = cell * self.parts + F.least(part, F.lit(self.parts - 1))
            return (F.when(at < self.bounds[0], F.lit(-1)).when(at >= self.bounds[-1], F.lit(self.last + 1))
                    .otherwise(inside).cast("long"))

        start = F.struct(F.lit(0).alias("low"), F.lit(cells).alias("past"), micros.alias("at"))
        steps = F.sequence(F.lit(1), F.lit(max(1, cells.bit_length())))
        return F.when(micros.isNotNull(), F.aggregate(steps, start, halve, bucket))


def _within(series: DataFrame, ts: str, tie_break: str, by: tuple[str, ...], first: int, last: int) -> DataFrame:
    """The observations that events between two instants (microseconds) can meet: those in between, and of each
    series the last one up to the first event."""
    first, last = (F.timestamp_micros(F.lit(micros)).cast(series.schema[ts].dataType) for micros in (first, last))
    before = series.where(F.col(ts) <= first).groupBy(*by).agg(
        F.max_by(F.struct(*series.columns), F.struct(ts, tie_break)).alias("__row"))
    between = series.where((F.col(ts) > first) & (F.col(ts) <= last))
    # An aggregate without keys gives a row also where there was none.
    return between.unionByName(before.where("__row IS NOT NULL").select("__row.*"))


def asof_join(events: DataFrame, series: DataFrame, *, event_ts: str, series_ts: str, tie_break: str,
              by: tuple[str, ...] = (), bucket_seconds: int | None = None,
              limit: BroadcastLimit = DEFAULT_LIMIT, prune: bool = False) -> DataFrame:
    """Left as-of join of `events` with `series`, optionally within equal `by` columns.

    The series is written to the shared folder once; what is measured there is also what is joined, so a table
    that grows meanwhile gives the matches it held at the call. For the same reason streams are refused: call this
    on the micro-batches of `foreachBatch`, with the series as it then is.

    With `prune` the events' time span is looked up first, and only the observations are written that they can meet:
    for micro-batches, which would else write the whole history each time.

    An interval is repeated in each bucket it crosses, and an event is compared with all intervals of its bucket.
    Buckets follow the observations unless `bucket_seconds` gives them one width.
    """
    if events.isStreaming or series.isStreaming:
        raise ValueError("join each micro-batch with the series as it then is, within foreachBatch")
    by = tuple(by)
    shared_dir(series.sparkSession)
    observed = series.where(F.col(series_ts).isNotNull())
    if prune:
        at = F.unix_micros(F.col(event_ts).cast("timestamp"))
        span = events.agg(F.min(at).alias("first"), F.max(at).alias("last")).first()
        if span["first"] is None:
            observed = observed.limit(0)
        else:
            observed = _within(observed, series_ts, tie_break, by, span["first"], span["last"])
    observed = observed.checkpoint()
    micros = F.unix_micros(F.col(series_ts).cast("timestamp"))
    measured = measure(
        observed, F.max(row_bytes(observed)).alias("widest"), F.max(series_ts).alias("last"),
        F.min(micros).alias("first_micros"), F.max(micros).alias("last_micros"),
        F.percentile_approx(micros, [k / CELLS for k in range(CELLS)], 10 * CELLS).alias("bounds"),
        (F.count_distinct(*by) if by else F.lit(1)).alias("series"))
    if measured["last"] is None:
        absent = [F.lit(None).cast(f.dataType).alias(f.name) for f in series.schema.fields if f.name not in by]
        return events.select("*", *absent)
    if bucket_seconds is None:
        bounds = sorted({measured["first_micros"], *measured["bounds"]})
        buckets = _CellBuckets(bounds, measured["last_micros"], measured["rows"])
    else:
        buckets = _EvenBuckets(bucket_seconds, measured["first_micros"], measured["last_micros"])

    intervals = validity_intervals(latest_per_instant(observed, series_ts, tie_break, by), series_ts, by)
    # Open intervals also take the buckets after the last, over which later events are spread by chance.
    crossed = F.sequence(buckets.of(F.col(_FROM)),
                         F.coalesce(buckets.of(F.col(_UNTIL)), F.lit(buckets.last + TAIL_BUCKETS)))
    candidates = intervals.withColumn(_BUCKET, F.explode(crossed))
    # Per series, intervals tile the span, so they cross at most one bucket edge more than they are many.
    most_rows = 2 * measured["rows"] + measured["series"] * (buckets.last - buckets.first + 1 + TAIL_BUCKETS)
    if most_rows <= limit.rows and most_rows * measured["widest"] <= limit.bytes:
        candidates = F.broadcast(candidates)

    own = F.col(_BUCKET)
    hashed = [f.name for f in events.schema.fields if not re.search("map<|variant", f.dataType.simpleString())]
    spread = F.pmod(F.xxhash64(F.lit(0), *hashed), F.lit(TAIL_BUCKETS))
    # Events without a time match nothing; they are spread over buckets that no interval has.
    keyed = events.withColumn(_BUCKET, buckets.of(F.col(event_ts))).withColumn(
        _BUCKET, F.when(own.isNull(), buckets.first - 2 - spread).when(own > buckets.last, buckets.last + 1 + spread)
        .otherwise(own))
    e, c = keyed.alias("e"), candidates.alias("c")
    matched = ((F.col(f"e.{_BUCKET}") == F.col(f"c.{_BUCKET}"))
               & (F.col(f"e.{event_ts}") >= F.col(f"c.{_FROM}"))
               & (F.col(f"c.{_UNTIL}").isNull() | (F.col(f"e.{event_ts}") < F.col(f"c.{_UNTIL}"))))
    for key in by:
        matched = matched & (F.col(f"e.{key}") == F.col(f"c.{key}"))
    taken = [F.col(f"c.{name}") for name in series.columns if name not in by]
    return e.join(c, matched, "left").select(*[F.col(f"e.{name}") for name in events.columns], *taken)


def asof_weather(events: DataFrame, weather: DataFrame, *, event_ts: str = "timestamp",
                 weather_ts: str = "timestamp", by: tuple[str, ...] = (), bucket_seconds: int | None = None,
                 limit: BroadcastLimit = DEFAULT_LIMIT, prune: bool = False) -> DataFrame:
    """Attach to each reading the latest weather at or before it; none before the first report.

    The match replaces a `weather_id` the readings already have; other clashing names get `_weather`.
    """
    events = events.drop("weather_id")
    clashes = {c: f"{c}_weather" for c in weather.columns if c in events.columns and c not in by}
    return asof_join(events, weather.withColumnsRenamed(clashes), event_ts=event_ts,
                     series_ts=clashes.get(weather_ts, weather_ts), tie_break="weather_id",
                     by=by, bucket_seconds=bucket_seconds, limit=limit, prune=prune)
