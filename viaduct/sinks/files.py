"""Parquet and CSV datasets."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.option("compression", "snappy").mode(mode).parquet(path)


def write_date_partitioned(df: DataFrame, path: str, ts: str = "timestamp") -> None:
    """Write under `year=/month=/day=`, replacing only the days that occur in `df`.

    A frame without the time column is written unpartitioned. The rebalance keeps a day's rows in
    few files and lets adaptive execution split a day that holds much more than the others.
    """
    if ts not in df.columns:
        write_parquet(df, path)
        return
    parts = {"year": F.year(ts), "month": F.month(ts), "day": F.dayofmonth(ts)}
    dealt = df.withColumns(parts).hint("rebalance", *parts)
    # Rows of a road lie together, in time order, so that row groups can be skipped by either.
    order = [c for c in ("road_id", ts) if c in df.columns]
    (dealt.sortWithinPartitions(*parts, *order)
       .write.option("compression", "snappy").option("partitionOverwriteMode", "dynamic")
       .mode("overwrite").partitionBy(*parts).parquet(path))


def export_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """A folder of CSV files, each with a header; times keep their microseconds."""
    (df.write.option("header", True)
     .option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]XXX")
     .option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]").mode(mode).csv(path))


def sink_raw_parquet(stream: DataFrame, path: str, checkpoint: str,
                     partition_by: tuple[str, ...] = ("month", "hour"), **trigger) -> StreamingQuery:
    """Append a stream to Parquet; the file sink's log makes each row land exactly once."""
    writer = (stream.writeStream.format("parquet").outputMode("append")
              .option("path", path).option("checkpointLocation", checkpoint)
              .option("compression", "snappy").partitionBy(*partition_by))
    return (writer.trigger(**trigger) if trigger else writer).start()
