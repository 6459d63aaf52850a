"""Micro-batch sinks that stay right when a batch is run again.

`foreachBatch` may repeat a batch after a failure. Every row therefore carries the id of its batch,
and a repeat either replaces what the first attempt wrote or adds only what is missing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

BATCH = "batch_id"
BatchWriter = Callable[[DataFrame, int], None]


def sink_micro_batch(stream: DataFrame, write: BatchWriter, checkpoint: str, **trigger) -> StreamingQuery:
    """Run `write(batch, batch_id)` on each micro-batch; an error in it fails the query."""
    writer = stream.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(write)
    return (writer.trigger(**trigger) if trigger else writer).start()


def parquet_micro_batch(path: str, prepare: Callable[[DataFrame], DataFrame] = lambda df: df) -> BatchWriter:
    """A writer with one folder per batch: a repeat overwrites its own folder and nothing else."""
    def write(batch: DataFrame, batch_id: int) -> None:
        (prepare(batch).withColumn(BATCH, F.lit(batch_id))
         .write.option("partitionOverwriteMode", "dynamic").mode("overwrite").partitionBy(BATCH).parquet(path))
    return write


def missing_of_batch(batch: DataFrame, batch_id: int, target: DataFrame, key: list[str]) -> DataFrame:
    """The rows of a repeated batch that its first attempt did not get to write.

    `target` is filtered on the batch id, which a database can answer from an index.
    """
    written = target.where(F.col(BATCH) == batch_id).select(*key)
    return batch.withColumn(BATCH, F.lit(batch_id)).join(written, key, "left_anti")
