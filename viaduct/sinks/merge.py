"""Late rows into the lake by date, and a maintained table of the latest row per key.

Both write beside what is there and then swap, so that a failed run leaves the table as it was.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.serving import latest_per_key
from ..session import shared_dir
from ..sources.files import read_days
from .files import write_date_partitioned
from .replay import BatchWriter

STAGING = "_staging"  # readers of the table pass over names that begin so
WHOLE = "_whole"      # marks a staging folder that was written to its end
VERSION = "version="


def _folder(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def merge_date_partitioned(df: DataFrame, path: str, key: tuple[str, ...], ts: str = "timestamp") -> None:
    """Add rows to a dataset of `write_date_partitioned`; a row whose key a touched day already holds replaces it.

    Only the days that occur in `df` are opened, merged into a staging folder, and swapped in one after the other; the
    other rows of those days stay. Running it again changes nothing. The key must fix the day: have the time column or
    a value that never changes its day. Of rows of `df` with one key the greatest is taken; a null in a key is a value
    like any other. Rows without a time have no day and are refused.

    Days are swapped by renaming folders. If that is cut off, the day in hand is whole in its staging folder and the
    next run merges it in first.
    """
    spark = df.sparkSession
    shared_dir(spark)
    rest = [c for c in df.columns if c not in key]
    batch = df.groupBy(*key).agg(F.max(F.struct(*rest)).alias("__row")).select(*key, "__row.*").select(*df.columns).checkpoint()
    days = [row[0] for row in batch.select(F.to_date(ts)).distinct().collect()]  # bounded by the calendar
    if None in days:
        raise ValueError(f"rows without {ts} have no day")
    root = path.rstrip("/")
    _finish(spark, root)
    if not days:
        return
    kept = read_days(spark, root, sorted(days), df.schema).select(*df.columns)
    taken = batch.select(*[F.col(c).alias(f"__{c}") for c in key])
    same = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in key]
    merged = kept.join(taken, same, "left_anti").unionByName(batch)
    staged = f"{root}/{STAGING}-{uuid.uuid4().hex}"
    write_date_partitioned(merged, staged, ts)
    system, _ = _folder(spark, root)
    system.create(spark._jvm.org.apache.hadoop.fs.Path(f"{staged}/{WHOLE}")).close()
    _finish(spark, root)


def _finish(spark: SparkSession, root: str) -> None:
    """Swap in the days of whole staging folders; drop others."""
    system, target = _folder(spark, root)
    if not system.exists(target):
        return
    path = spark._jvm.org.apache.hadoop.fs.Path
    for status in system.listStatus(target):
        staged = status.getPath()
        if not staged.getName().startswith(STAGING):
            continue
        if not system.exists(path(staged, WHOLE)):
            system.delete(staged, True)
            continue
        for folder in system.globStatus(path(staged, "year=*/month=*/day=*")) or ():
            day = folder.getPath()
            own = path(target, "/".join([day.getParent().getParent().getName(), day.getParent().getName(), day.getName()]))
            system.delete(own, True)
            system.mkdirs(own.getParent())
            if not system.rename(day, own):
                raise OSError(f"could not move {day} to {own}")
        system.delete(staged, True)


def _versions(spark: SparkSession, root: str) -> list[int]:
    """The whole versions of a table, ascending."""
    system, target = _folder(spark, root)
    if not system.exists(target):
        return []
    path = spark._jvm.org.apache.hadoop.fs.Path
    names = [s.getPath() for s in system.listStatus(target) if s.getPath().getName().startswith(VERSION)]
    return sorted(int(p.getName().removeprefix(VERSION)) for p in names if system.exists(path(p, "_SUCCESS")))


def latest_rows_batches(path: str, key: str, ts: str, tie_break: str, keep_versions: int = 2,
                        prepare: Callable[[DataFrame], DataFrame] = lambda df: df) -> BatchWriter:
    """A writer for `sink_micro_batch` that maintains the latest row of each key.

    Each batch merges its latest rows with the version before and writes the next, named by the batch. Rows may come
    in any order, and a batch that is run again reads the version before its own once more, so that it gives the same
    table. Of rows at one instant the greatest `tie_break` stays. The table has one row per key; older versions than
    the last `keep_versions` are removed.
    """
    root = path.rstrip("/")

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = prepare(batch)
        before = [v for v in _versions(spark, root) if v < batch_id]
        if before:
            rows = spark.read.parquet(f"{root}/{VERSION}{before[-1]}").unionByName(rows)
        latest_per_key(rows, key, ts, tie_break).write.mode("overwrite").parquet(f"{root}/{VERSION}{batch_id}")
        system, _ = _folder(spark, root)
        for old in [v for v in _versions(spark, root) if v <= batch_id][:-keep_versions]:
            system.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{VERSION}{old}"), True)
    return write


def read_latest_rows(spark: SparkSession, path: str) -> DataFrame:
    """The table as the last whole batch left it."""
    versions = _versions(spark, path.rstrip("/"))
    if not versions:
        raise FileNotFoundError(path)
    return spark.read.parquet(f"{path.rstrip('/')}/{VERSION}{versions[-1]}")
