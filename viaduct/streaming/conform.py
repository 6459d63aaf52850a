"""From a stream of readings to the event table, micro-batch by micro-batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from ..operators.features import conform_events
from ..sinks.replay import BatchWriter

#: Gives the sensors, roads and weather as they are at the call.
LoadDimensions = Callable[[], tuple[DataFrame, DataFrame, DataFrame]]


def conformed_batches(load: LoadDimensions, write: BatchWriter, **names) -> BatchWriter:
    """A writer for `sink_micro_batch` that fits each batch to the event table and hands it to `write`.

    The dimensions are loaded anew for every batch, so that weather which arrives after the stream has started is
    matched from the next batch on; of its history a batch stores and joins only what its time span can meet. `names`
    goes to `conform_events`. Repeating a batch gives the same rows as long as
    the dimensions have not changed; `write` must replace or complete what the first attempt wrote.
    """
    def run(batch: DataFrame, batch_id: int) -> None:
        write(conform_events(batch, *load(), prune=True, **names), batch_id)
    return run
