"""Writers for files, JDBC and Kafka."""

from .files import export_csv, sink_raw_parquet, write_date_partitioned, write_parquet
from .jdbc import jdbc_micro_batch, sink_jdbc_micro_batch, write_jdbc
from .kafka import to_messages, write_kafka, write_kafka_stream
from .merge import latest_rows_batches, merge_date_partitioned, read_latest_rows
from .replay import parquet_micro_batch, sink_micro_batch

__all__ = [
    "export_csv", "jdbc_micro_batch", "latest_rows_batches", "merge_date_partitioned", "parquet_micro_batch",
    "read_latest_rows", "sink_jdbc_micro_batch", "sink_micro_batch", "sink_raw_parquet", "to_messages", "write_date_partitioned", "write_jdbc",
    "write_kafka", "write_kafka_stream", "write_parquet",
]
