"""Aggregates and batch reports.

Reports start from one road x hour aggregate that carries sums and counts, so a road that holds a
third of all readings is combined before the shuffle and only a few rows per road travel. Names are
looked up after that, where both sides are about as small as the roads table, so those joins carry no hint.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import round_half_even, round_numeric
from ..functions.traffic import CONGESTED_LEVELS, TOP_LEVEL

CONGESTED_ABOVE = 0.5
PERIODS = {"DAILY": "day", "WEEKLY": "week", "MONTHLY": "month"}
HOURS = range(24)


def _mean(total: str, count: str) -> Column:
    return F.try_divide(F.sum(total), F.sum(count))


def road_hour_parts(events: DataFrame, keys: tuple[str, ...] = ("road_id",)) -> DataFrame:
    """Sums and counts per road and hour: everything the reports are made from."""
    return events.groupBy(*keys, "hour").agg(
        F.sum("vehicle_count").alias("hour_vehicles"),
        F.sum("average_speed_kmh").alias("speed_sum"),
        F.count("average_speed_kmh").alias("speed_count"),
        F.sum("congestion_index").alias("index_sum"),
        F.count("congestion_index").alias("index_count"),
        F.count_if(F.col("congestion_index") > CONGESTED_ABOVE).alias("congested"),
    )


def road_hour_volume(events: DataFrame) -> DataFrame:
    return events.groupBy("road_id", "hour").agg(F.sum("vehicle_count").alias("total_hour_vehicles"))


def road_daily_stats(events: DataFrame) -> DataFrame:
    return events.groupBy("road_id").agg(
        F.avg("average_speed_kmh").alias("avg_speed"),
        F.sum("vehicle_count").alias("total_vehicles"),
        F.avg("congestion_index").alias("congestion_score"),
        F.count_if(F.col("congestion_index") > CONGESTED_ABOVE).alias("congestion_hours"),
    )


def _busiest(volume: str) -> Column:
    """The hour with the greatest volume; of equal ones the earliest."""
    return F.max_by("hour", F.struct(F.col(volume), -F.col("hour")))


def peak_hour(events: DataFrame, keep_ties: bool = False) -> DataFrame:
    """Busiest hour per road. With `keep_ties` every hour that shares the first rank is kept."""
    volume = road_hour_volume(events)
    if not keep_ties:
        return volume.groupBy("road_id").agg(_busiest("total_hour_vehicles").alias("peak_hour"))
    ranked = Window.partitionBy("road_id").orderBy(F.desc("total_hour_vehicles"))
    return (volume.withColumn("__rank", F.rank().over(ranked)).where("__rank = 1")
            .select("road_id", F.col("hour").alias("peak_hour")))


def _report(parts: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    return parts.groupBy(*keys).agg(
        _mean("speed_sum", "speed_count").alias("avg_speed"),
        F.sum("hour_vehicles").alias("total_vehicles"),
        _busiest("hour_vehicles").alias("peak_hour"),
        F.sum("congested").alias("congestion_hours"),
        _mean("index_sum", "index_count").alias("congestion_score"),
    )


def select_report_columns(report: DataFrame) -> DataFrame:
    return report.select("report_type", "report_date", "road_id", "avg_speed", "total_vehicles",
                         "peak_hour", "congestion_hours", "congestion_score")


def daily_report(events: DataFrame, report_date: dt.date | Column) -> DataFrame:
    """One row per road over all given events, dated `report_date`, in one pass over the events.

    `congestion_hours` counts readings with an index above one half.
    """
    day = report_date if isinstance(report_date, Column) else F.lit(report_date)
    report = _report(road_hour_parts(events), ("road_id",))
    return report.transform(_dated, "DAILY", day).transform(select_report_columns)


def _dated(report: DataFrame, report_type: str, day: Column) -> DataFrame:
    return report.withColumns({"report_type": F.lit(report_type), "report_date": day.cast("date")})


def period_report(events: DataFrame, period: str, ts: str = "timestamp") -> DataFrame:
    """The same report per road and day, week (from Monday) or month; dated by its first day."""
    dated = events.withColumn("__start", F.trunc(F.col(ts).cast("date"), PERIODS[period])
                              if period != "DAILY" else F.col(ts).cast("date"))
    report = _report(road_hour_parts(dated, ("__start", "road_id")), ("__start", "road_id"))
    return report.transform(_dated, period, F.col("__start")).transform(select_report_columns)


def report_of_parts(parts: DataFrame, period: str) -> DataFrame:
    """The report from rows of `road_hour_parts` of any finer grain, dated by their column `__start`."""
    keys = ("__start", "road_id")
    sums = [c for c in parts.columns if c not in (*keys, "date", "hour")]
    summed = parts.groupBy(*keys, "hour").agg(*[F.sum(c).alias(c) for c in sums])
    return _report(summed, keys).transform(_dated, period, F.col("__start")).transform(select_report_columns)


def lookback_filter(df: DataFrame, as_of: dt.datetime | Column, hours: int = 24, ts: str = "timestamp",
                    date_partitioned: bool = False) -> DataFrame:
    """Rows later than `as_of` less `hours`. A literal `as_of` reaches the Parquet scan.

    Of a dataset that `write_date_partitioned` wrote, folders of earlier days are not scanned if
    `date_partitioned` says so. They have been listed when the dataset was opened; `read_date_partitions` opens
    only the days in question.
    """
    since = (as_of if isinstance(as_of, Column) else F.lit(as_of)) - F.expr(f"INTERVAL {hours} HOURS")
    if date_partitioned:
        df = df.where(F.make_date("year", "month", "day") >= F.to_date(since))
    return df.where(F.col(ts) > since)


def road_congestion_summary(events: DataFrame, roads: DataFrame, as_of: dt.datetime | Column | None = None,
                            hours: int = 24, ts: str = "timestamp") -> DataFrame:
    """Rounded averages and critical readings per road; over the last `hours` if `as_of` is given.

    The events are aggregated by road id before the road's name is looked up.
    """
    if as_of is not None:
        events = lookback_filter(events, as_of, hours, ts)
    parts = events.groupBy("road_id").agg(
        F.sum("average_speed_kmh").alias("speed_sum"), F.count("average_speed_kmh").alias("speed_count"),
        F.sum("vehicle_count").alias("vehicle_sum"), F.count("vehicle_count").alias("vehicle_count"),
        F.sum("congestion_index").alias("index_sum"), F.count("congestion_index").alias("index_count"),
        F.count_if(F.col("congestion_level") == TOP_LEVEL).alias("critical"))
    named = parts.join(roads.select("road_id", "road_name", "speed_limit_kmh"), "road_id")
    return named.groupBy("road_name", "speed_limit_kmh").agg(
        round_numeric(_mean("speed_sum", "speed_count"), 2).alias("avg_speed"),
        round_numeric(_mean("vehicle_sum", "vehicle_count"), 2).alias("avg_vehicle_count"),
        round_numeric(_mean("index_sum", "index_count"), 2).alias("avg_congestion_index"),
        F.sum("critical").alias("critical_events_count"))


def hourly_profile(events: DataFrame, roads: DataFrame) -> DataFrame:
    """Mean vehicle count by hour and road name."""
    parts = events.groupBy("road_id", "hour").agg(
        F.sum("vehicle_count").alias("vehicle_sum"), F.count("vehicle_count").alias("vehicle_rows"))
    named = parts.join(roads.select("road_id", "road_name"), "road_id")
    return named.groupBy("hour", "road_name").agg(_mean("vehicle_sum", "vehicle_rows").alias("vehicle_count"))


def congestion_heatmap(events: DataFrame, roads: DataFrame) -> DataFrame:
    """Mean congestion index, one row per road and one column per hour (`h00` to `h23`)."""
    parts = events.groupBy("road_id", "hour").agg(
        F.sum("congestion_index").alias("index_sum"), F.count("congestion_index").alias("index_count"))
    named = parts.join(roads.select("road_id", "road_name"), "road_id")
    # The hours are known, so no job is needed to find the columns.
    cells = named.groupBy("road_name").pivot("hour", list(HOURS)).agg(_mean("index_sum", "index_count"))
    return cells.select("road_name", *[F.col(f"`{h}`").alias(f"h{h:02d}") for h in HOURS])


def network_kpis(events: DataFrame) -> DataFrame:
    """Total vehicles, mean speed, congested readings and number of roads, as one row."""
    return events.agg(
        F.sum("vehicle_count").alias("total_vehicles"),
        round_half_even(F.avg("average_speed_kmh"), 1).alias("avg_speed"),
        F.count_if(F.col("congestion_level").isin(*CONGESTED_LEVELS)).alias("congested_count"),
        F.count_distinct("road_name").alias("road_count"))


def level_distribution(events: DataFrame) -> DataFrame:
    """Rows per congestion level and their share of all rows."""
    counts = events.groupBy("congestion_level").agg(F.count(F.lit(1)).alias("row_count"))
    # Over the handful of levels, not over the events.
    whole = F.sum("row_count").over(Window.partitionBy())
    return counts.withColumn("share", F.col("row_count") / whole)


def volume_by_road_level(events: DataFrame, roads: DataFrame) -> DataFrame:
    """Vehicles per road name and congestion level."""
    parts = events.groupBy("road_id", "congestion_level").agg(F.sum("vehicle_count").alias("vehicles"))
    named = parts.join(roads.select("road_id", "road_name"), "road_id")
    return named.groupBy("road_name", "congestion_level").agg(F.sum("vehicles").alias("vehicle_count"))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def ride_demand(rides: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Requests per pickup road, hour of day and status."""
    return rides.groupBy("pickup_road_id", F.hour(ts).alias("hour"), "status").agg(
        F.count(F.lit(1)).alias("requests"))
