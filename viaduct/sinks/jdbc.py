"""Relational tables over JDBC."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..sources.jdbc import JdbcTarget, read_table
from .replay import BatchWriter, missing_of_batch, sink_micro_batch

# What to do with rows the table already has -> Spark's save mode.
SAVE_MODES = {"append": "append", "replace": "overwrite", "fail": "errorifexists"}


def write_jdbc(df: DataFrame, target: JdbcTarget, table: str, if_exists: str = "append") -> None:
    """Write a frame to a table.

    An empty frame never replaces a table. Appending one writes nothing, so it is not looked at first,
    which would compute part of it twice.
    """
    mode = SAVE_MODES[if_exists]
    if mode != "append" and df.isEmpty():
        return
    df.write.format("jdbc").options(**target.write_options()).option("dbtable", table).mode(mode).save()


def jdbc_micro_batch(target: JdbcTarget, table: str, key: list[str],
                     prepare: Callable[[DataFrame], DataFrame] = lambda df: df) -> BatchWriter:
    """A replay-safe writer: rows an earlier attempt at the same batch wrote are not written again.

    The table needs a `batch_id` column.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        present = read_table(batch.sparkSession, target, table)
        write_jdbc(missing_of_batch(prepare(batch), batch_id, present, key), target, table)
    return write


def sink_jdbc_micro_batch(stream: DataFrame, target: JdbcTarget, table: str, key: list[str], checkpoint: str,
                          prepare: Callable[[DataFrame], DataFrame] = lambda df: df, **trigger) -> StreamingQuery:
    return sink_micro_batch(stream, jdbc_micro_batch(target, table, key, prepare), checkpoint, **trigger)
