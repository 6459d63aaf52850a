"""Starting several sinks on one cleaned stream."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.quality import quarantine
from .readings import parse_readings

Sink = Callable[[DataFrame, str], StreamingQuery]


def run_stream(messages: DataFrame, sinks: dict[str, Sink], dead_letters: Sink | None, checkpoints: str,
               max_speed: float | None = None) -> dict[str, StreamingQuery]:
    """Parse, split off bad messages, and start one query per sink.

    A sink takes (stream, checkpoint folder). Each query has its own checkpoint and fails on its own;
    each reads the source for itself.
    """
    good, bad = quarantine(parse_readings(messages), max_speed=max_speed)
    root = checkpoints.rstrip("/")
    started = {name: sink(good, f"{root}/{name}") for name, sink in sinks.items()}
    if dead_letters is not None:
        started["dead_letters"] = dead_letters(bad, f"{root}/dead_letters")
    return started


def await_any(spark: SparkSession, timeout: float | None = None) -> bool | None:
    """Block until any query ends; a failed one raises here instead of going unnoticed."""
    return spark.streams.awaitAnyTermination(timeout)
