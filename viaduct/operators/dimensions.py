"""Joining a large table to a dimension.

A dimension is broadcast only after its rows and bytes were counted. Past the limit the join is
left to Catalyst as an ordinary equi-join: both sides shuffle on the key, and adaptive execution
splits the partitions of hot keys (see `session.DEFAULTS`). Both ways give the same rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T


@dataclass(frozen=True)
class BroadcastLimit:
    rows: int = 1_000_000
    bytes: int = 128 * 1024 * 1024


DEFAULT_LIMIT = BroadcastLimit()

# Types whose width varies by row; the others are counted at their fixed width.
_FIXED_WIDTH = 16


def row_bytes(df: DataFrame) -> Column:
    """Width of one row, from the real lengths of its texts."""
    width = F.lit(_FIXED_WIDTH * len(df.columns)).cast("long")
    for field in df.schema.fields:
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            width = width + F.coalesce(F.octet_length(field.name), F.lit(0))
        elif isinstance(field.dataType, (T.StructType, T.ArrayType, T.MapType, T.VariantType)):
            width = width + F.coalesce(F.octet_length(F.to_json(F.struct(field.name))), F.lit(0))
    return width


def measure(dim: DataFrame, *extra: Column):
    """Rows, bytes and any further aggregates of the dimension, in one distributed aggregate."""
    return dim.agg(F.count(F.lit(1)).alias("rows"),
                   F.coalesce(F.sum(row_bytes(dim)), F.lit(0)).alias("bytes"), *extra).first()


def within(measured, limit: BroadcastLimit) -> bool:
    return measured["rows"] <= limit.rows and measured["bytes"] <= limit.bytes


def sized(dim: DataFrame, limit: BroadcastLimit = DEFAULT_LIMIT) -> DataFrame:
    """The dimension, marked for broadcast if its measured size allows it."""
    return F.broadcast(dim) if within(measure(dim), limit) else dim


def join_dim(facts: DataFrame, dim: DataFrame, on, how: str = "inner",
             limit: BroadcastLimit = DEFAULT_LIMIT) -> DataFrame:
    """Join `facts` to a dimension on equal keys; `how` is inner, left, left_semi or left_anti."""
    return facts.join(sized(dim, limit), on, how)
