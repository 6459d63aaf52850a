"""Intermediate tables in the shared folder.

A table that has been written and read again has no lineage left to recompute, has the size statistics of its files,
and can be pruned by column. (A checkpoint keeps the size estimate of its plan, which multiplies with every join of an
iteration.) The files go when the session ends, or earlier by `forget`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from viaduct.session import shared_path


def stored(frame: DataFrame, name: str = "step") -> DataFrame:
    """The frame, written as Parquet and read again."""
    spark = frame.sparkSession
    path = shared_path(spark, f"llm-{name}")
    frame.write.parquet(path)
    _filesystem(spark, path).deleteOnExit(_path(spark, path))
    again = spark.read.schema(frame.schema).parquet(path)
    again._stored_at = path
    return again


def forget(frame: DataFrame) -> None:
    """Remove the files of a stored frame that nothing will read any more."""
    path, spark = frame._stored_at, frame.sparkSession
    _filesystem(spark, path).delete(_path(spark, path), True)


def drawn_by_hash(frame: DataFrame, key: str, most: int, rows: int) -> DataFrame:
    """At most `most` of the rows, the first by the hash of the key. Only hashes below a bound that some more rows than
    these fall under take part, so that a task does not offer `most` rows of its own however many tasks there are."""
    hashed = F.xxhash64(key)
    share = (most + 10 * most ** 0.5 + 100) / max(1, rows)  # ten standard deviations more than asked for
    if share < 1:
        frame = frame.where(F.pmod(hashed, F.lit(1 << 62)) < F.lit(int(share * (1 << 62))))
        hashed = F.pmod(hashed, F.lit(1 << 62))
    return frame.orderBy(hashed, key).limit(most)


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _filesystem(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())
