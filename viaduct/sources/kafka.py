"""Kafka topics. The connector (spark-sql-kafka-0-10) comes with the cluster, not with this library."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def kafka_options(servers: str, topics: str | list[str], *, starting_offsets: str, group_id: str | None = None,
                  max_offsets_per_trigger: int | None = None, min_partitions: int | None = None) -> dict[str, str]:
    """Source options. `min_partitions` lets a topic of few partitions be read by more tasks."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topics if isinstance(topics, str) else ",".join(topics),
        "startingOffsets": starting_offsets,
        "kafka.group.id": group_id,
        "maxOffsetsPerTrigger": max_offsets_per_trigger,
        "minPartitions": min_partitions,
    }
    return {key: str(value) for key, value in options.items() if value is not None}


def decode_value(messages: DataFrame) -> DataFrame:
    """The message body as text, whatever else the source carries."""
    return messages.select(F.col("value").cast("string").alias("value"))


def read_kafka_stream(spark: SparkSession, servers: str, topics: str | list[str], *,
                      starting_offsets: str = "latest", **options) -> DataFrame:
    """A stream of message bodies; the offsets reached are kept in the query's checkpoint.

    A consumer that calls a function on what arrives is this stream, from `earliest`, into
    `sinks.sink_micro_batch`; a failing function fails the query and no offset is passed over.
    """
    chosen = kafka_options(servers, topics, starting_offsets=starting_offsets, **options)
    return decode_value(spark.readStream.format("kafka").options(**chosen).load())


def read_kafka_batch(spark: SparkSession, servers: str, topics: str | list[str], *,
                     starting_offsets: str = "earliest", ending_offsets: str = "latest", **options) -> DataFrame:
    """The messages between two offsets as a batch."""
    chosen = kafka_options(servers, topics, starting_offsets=starting_offsets, **options)
    return decode_value(spark.read.format("kafka").options(**chosen, endingOffsets=ending_offsets).load())
