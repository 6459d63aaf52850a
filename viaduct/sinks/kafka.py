"""Kafka topics as a target."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

# Wait for all replicas, and compress.
PRODUCER_OPTIONS = {"kafka.acks": "all", "kafka.compression.type": "gzip",
                    "kafka.retries": "5", "kafka.linger.ms": "10"}


def to_messages(df: DataFrame, key: str | None = None) -> DataFrame:
    """Rows as `(key, value)`: the value is the row in JSON, the key one column as text."""
    row_key = F.col(key).cast("string") if key else F.lit(None).cast("string")
    return df.select(row_key.alias("key"), F.to_json(F.struct(*df.columns)).alias("value"))


def write_kafka(df: DataFrame, servers: str, topic: str, key: str | None = None) -> None:
    (to_messages(df, key).write.format("kafka").options(**PRODUCER_OPTIONS)
     .option("kafka.bootstrap.servers", servers).option("topic", topic).save())


def write_kafka_stream(stream: DataFrame, servers: str, topic: str, checkpoint: str,
                       key: str | None = None, **trigger) -> StreamingQuery:
    writer = (to_messages(stream, key).writeStream.format("kafka").options(**PRODUCER_OPTIONS)
              .option("kafka.bootstrap.servers", servers).option("topic", topic)
              .option("checkpointLocation", checkpoint))
    return (writer.trigger(**trigger) if trigger else writer).start()
