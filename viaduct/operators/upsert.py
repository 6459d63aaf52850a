"""Insert rows whose key is new."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, functions as F

from .dimensions import DEFAULT_LIMIT, BroadcastLimit, measure, within


def insert_ignore(incoming: DataFrame, existing: DataFrame, key: list[str],
                  limit: BroadcastLimit = DEFAULT_LIMIT) -> DataFrame:
    """The rows of `incoming` to append: those whose key `existing` lacks, one per key.

    Among incoming rows with the same key the smallest row wins, so the choice does not depend on
    partitioning. The target may be far larger than the batch: where the batch's keys are few enough
    to broadcast, the target is reduced to the keys in question, and neither side is shuffled for
    the comparison. A key with a null conflicts with nothing: such rows all pass, copies included.
    """
    unkeyed = reduce(or_, [F.col(c).isNull() for c in key])
    nulls, incoming = incoming.where(unkeyed), incoming.where(~unkeyed)
    wanted = incoming.select(*key).distinct()
    taken = existing.select(*key)
    if within(measure(wanted), limit):
        # The keys in question that are taken cannot be more than those just counted.
        taken = F.broadcast(taken.join(F.broadcast(wanted), key, "left_semi").distinct())
    fresh = incoming.join(taken, key, "left_anti")
    rest = [c for c in incoming.columns if c not in key]
    if not rest:
        return fresh.distinct().unionByName(nulls)
    smallest = fresh.groupBy(*key).agg(F.min(F.struct(*rest)).alias("__rest"))
    return smallest.select(*key, "__rest.*").select(*incoming.columns).unionByName(nulls)
