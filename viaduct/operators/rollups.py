"""Reports from a stored table of mergeable sums: road x hour x day.

The table holds what a report needs of the readings, by date. When days change only these are read again and replaced;
reports of any period add up the stored rows and never see a reading.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import shared_dir
from .reports import PERIODS, report_of_parts, road_hour_parts


def road_hour_days(events: DataFrame, ts: str = "timestamp") -> DataFrame:
    """One row of sums per date, road and hour."""
    return road_hour_parts(events.withColumn("date", F.to_date(ts)), ("date", "road_id"))


def update_rollup(events: DataFrame, path: str, days: list[dt.date] | None = None, ts: str = "timestamp") -> None:
    """Bring the stored sums up to date for the days given, or for all days of `events`.

    Readings of other days are not read: the filter on the time reaches the scan. A day whose readings are all gone
    leaves the table.
    """
    spark = events.sparkSession
    if days is None:
        road_hour_days(events, ts).repartition("date").write.mode("overwrite").option(
            "partitionOverwriteMode", "static").partitionBy("date").parquet(path)
        return
    system = spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    zone_free = events.schema[ts].dataType.simpleString() == "timestamp_ntz"

    def start(day: dt.date):
        text = F.lit(f"{day} 00:00:00")
        return F.to_timestamp_ntz(text) if zone_free else F.to_timestamp(text)
    changed = None
    for day in sorted(set(days)):
        of_day = (F.col(ts) >= start(day)) & (F.col(ts) < start(day + dt.timedelta(days=1)))
        changed = of_day if changed is None else changed | of_day
    if changed is None:
        return
    shared_dir(spark)
    sums = road_hour_days(events.where(changed), ts).checkpoint()
    sums.repartition("date").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date").parquet(path)
    left = {row["date"] for row in spark.read.parquet(path).select("date").distinct().collect()}  # names of folders
    there = {row["date"] for row in sums.select("date").distinct().collect()}
    for day in (set(days) & left) - there:
        system.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/date={day}"), True)


def read_rollup(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def report_from_rollup(sums: DataFrame, period: str) -> DataFrame:
    """The report of `period_report`, from stored sums."""
    start = F.col("date") if period == "DAILY" else F.trunc("date", PERIODS[period])
    return report_of_parts(sums.withColumn("__start", start), period)
