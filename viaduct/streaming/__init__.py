"""Operators for streams of readings; all of them also take a batch frame."""

from .conform import conformed_batches
from .readings import clean_stream, dedupe_closed, dedupe_stream, parse_messages, parse_readings, with_event_time
from .runner import await_any, run_stream
from .weather import join_weather_streams
from .windows import windowed_metrics

__all__ = ["await_any", "clean_stream", "conformed_batches", "dedupe_closed", "dedupe_stream", "join_weather_streams", "parse_messages", "parse_readings", "run_stream",
           "windowed_metrics", "with_event_time"]
