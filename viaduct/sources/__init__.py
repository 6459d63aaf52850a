"""Readers for files, Kafka and JDBC."""

from .files import (SourceNotFound, load_reference_dimensions, read_csv, read_date_partitions,
                    read_events_with_fallback, read_parquet)
from .jdbc import JdbcTarget, read_query, read_table
from .kafka import decode_value, kafka_options, read_kafka_batch, read_kafka_stream

__all__ = [
    "JdbcTarget", "SourceNotFound", "decode_value", "kafka_options", "load_reference_dimensions",
    "read_csv", "read_date_partitions", "read_events_with_fallback", "read_kafka_batch", "read_kafka_stream", "read_parquet",
    "read_query", "read_table",
]
