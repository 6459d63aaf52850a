"""Exact duplicates by two-pass Bloom filtering.

Texts are equal if they are identical after A-Z are lower-cased; they are compared by the SHA-256 of that form. The
first pass puts the hashes of all rows into a filter of fixed size (`bloom`), the second finds the rows whose hash
may occur again. Only those are shuffled; all others are certainly single and pass straight through.

Of equal texts the row with the largest doc_id stays; null ids rank below all others, and of rows that repeat an id
with the same text one stays. A null text counts as empty, so all null and empty texts are one group. A group may
hold any share of the rows: groups are reduced to one row before the shuffle, and their rows find the result again by
an equi-join whose large partitions adaptive execution splits. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .bloom import passes, repeated_plane
from .merging import begin_task
from .words import lower_ascii, text_of


def text_digest(column: str = "text") -> Column:
    """Lowercase hex SHA-256 of the normalised text."""
    return F.sha2(lower_ascii(text_of(column)), 256)


def _flagged(frame: DataFrame, plane: np.ndarray) -> DataFrame:
    """The frame, whose column `_hash` becomes `_again`: whether the hash may be repeated."""
    shared = frame.sparkSession.sparkContext.broadcast(plane)
    names = frame.columns
    kinds = frame.withColumn("_again", F.lit(True)).drop("_hash").schema

    def run(batches):
        begin_task()
        for batch in batches:
            again = passes(shared.value, batch.column("_hash").to_numpy(zero_copy_only=False))
            columns = {n: batch.column(n) for n in names if n != "_hash"}
            yield pa.RecordBatch.from_pydict({**columns, "_again": pa.array(again, pa.bool_())})

    return frame.mapInArrow(run, kinds)


def duplicate_groups(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, keep_id (of the row that stays), group_size, kept, text_sha256."""
    digests = docs.select("doc_id", text_digest().alias("text_sha256"))
    digests = digests.withColumn("_row", F.monotonically_increasing_id()).checkpoint()
    hashes = digests.select(F.xxhash64("text_sha256").alias("_hash"))
    plane = repeated_plane(hashes, digests.count())
    rows = _flagged(digests.withColumn("_hash", F.xxhash64("text_sha256")), plane)
    single = rows.filter("NOT _again").select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), "text_sha256")
    again = rows.filter("_again").drop("_again")
    best = again.groupBy("text_sha256").agg(F.max(F.struct("doc_id", "_row")).alias("_best"),
                                            F.count(F.lit(1)).alias("group_size"))
    # Read back from a file, so that the join deals out both sides itself and can split the rows of a large group.
    best = best.checkpoint()
    grouped = again.join(best, "text_sha256").select(
        "doc_id", F.col("_best.doc_id").alias("keep_id"), "group_size",
        (F.col("_row") == F.col("_best._row")).alias("kept"), "text_sha256")
    return single.unionByName(grouped)


def drop_duplicates(docs: DataFrame) -> DataFrame:
    """The rows that stay, with all their columns. Of rows that agree in id and text any one stays.

    Texts travel only for rows that may be repeated, and of each group one row per task.
    """
    digests = docs.select(text_digest().alias("_digest")).checkpoint()
    plane = repeated_plane(digests.select(F.xxhash64("_digest").alias("_hash")), digests.count())
    marked = docs.select(F.struct(*docs.columns).alias("_doc"), text_digest().alias("_digest"))
    flagged = _flagged(marked.withColumn("_hash", F.xxhash64("_digest")), plane)
    single = flagged.filter("NOT _again").select("_doc.*")
    best = (flagged.filter("_again").groupBy("_digest")
            .agg(F.max_by("_doc", F.struct(F.col("_doc").getField("doc_id"))).alias("_doc")).select("_doc.*"))
    return single.unionByName(best)
