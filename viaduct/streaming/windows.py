"""Sliding-window averages per road."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

MEASURES = {
    "avg_vehicle_count": "vehicle_count",
    "avg_speed_kmh": "average_speed_kmh",
    "avg_congestion_index": "congestion_index",
}


def windowed_metrics(readings: DataFrame, ts: str = "timestamp_parsed", *, minutes: int = 5, every: int = 1,
                     delay: str = "10 minutes", by: str = "road_name") -> DataFrame:
    """Averages over windows of `minutes` that start each `every` minutes, per road.

    Readings are summed per slide, and slides are added up to windows. On a stream both steps keep state under one
    watermark: readings more than `delay` behind the latest are dropped, a slide's sums are closed once the watermark
    has passed its end, and a window is given out once it has passed the window's end (append mode). On a batch frame
    all windows are given.
    """
    if minutes % every:
        raise ValueError("the window must be a multiple of its slide")
    timed = readings.withWatermark(ts, delay) if readings.isStreaming else readings.where(F.col(ts).isNotNull())
    # Aggregate once per slide, then add the slides up: readings are not repeated for each window.
    panes = timed.groupBy(F.window(ts, f"{every} minutes").alias("pane"), by).agg(
        *[part for source in MEASURES.values() for part in
          (F.sum(source).alias(f"{source}_sum"), F.count(source).alias(f"{source}_n"))])
    # A stream's panes are given out as the watermark passes them, and carry their time on to the second aggregation.
    pane_time = F.window_time("pane") if readings.isStreaming else F.col("pane.start")
    windows = panes.groupBy(F.window(pane_time, f"{minutes} minutes", f"{every} minutes").alias("window"), by)
    means = windows.agg(*[_mean(source).alias(name) for name, source in MEASURES.items()])
    return means.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), by,
                        *MEASURES)


def _mean(source: str) -> Column:
    return F.try_divide(F.sum(f"{source}_sum"), F.sum(f"{source}_n"))
