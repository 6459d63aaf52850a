"""Time the headline queries and print one JSON line.

BENCH_SF_DIR chooses the data, BENCH_CPUS the cores. Each query is planned and run in full, size checks
included, into a sink that keeps nothing; the better of two runs counts, streams and models run once.
"""

from __future__ import annotations

import json
import os
import time

from viaduct.plans import QUERIES
from viaduct.session import build_session

HEADLINE = (
    "daily_report", "period_report_weekly", "road_congestion_summary", "hourly_profile", "congestion_heatmap",
    "network_kpis", "current_status", "latest_events", "volume_trend_by_hour", "search_rows",
    "clean_and_derive", "conform_events", "asof_weather", "join_weather_inner",
    "check_references", "check_not_null_unique", "insert_ignore",
    "parse_readings", "clean_stream", "quarantine", "windowed_metrics",
    "score_congestion", "forecast_24h", "evaluate_by_road", "record_predictions", "ride_demand",
)
# Streams and models, which also pay for checkpoints and iterations.
LONG = ("stream_windowed_metrics", "sink_raw_parquet", "train_linear_all_features", "train_forest", "train_gbt")


def seconds(run, rounds: int) -> float:
    best = float("inf")
    for _ in range(rounds):
        start = time.perf_counter()
        run().write.format("noop").mode("overwrite").save()
        best = min(best, time.perf_counter() - start)
    return round(best, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", {
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "8g",
        "spark.ui.showConsoleProgress": "false",
        # Plans are timed too; do not record a call site for every expression.
        "spark.python.sql.dataFrameDebugging.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    seconds(lambda: QUERIES["daily_report"](spark, sf_dir), 1)
    timed = {name: seconds(lambda: QUERIES[name](spark, sf_dir), 2) for name in HEADLINE}
    long = {name: seconds(lambda: QUERIES[name](spark, sf_dir), 1) for name in LONG}
    events = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(timed.values()), 3), "unit": "sec",
        "queries": {**timed, **long}, "sf": sf_dir.rsplit("sf", 1)[-1],
        "stream_rows_per_sec": round(events / long["stream_windowed_metrics"]), "cpus": int(cpus),
    }))


if __name__ == "__main__":
    main()
