"""CSV and Parquet. Schemas are declared, never inferred, so opening a file starts no job."""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from ..operators.quality import CORRUPT
from ..schemas import HISTORY_FILES


class SourceNotFound(FileNotFoundError):
    """None of the given paths exists."""


def _open(load, path: str) -> DataFrame:
    try:
        return load(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise SourceNotFound(path) from error
        raise


def read_csv(spark: SparkSession, path: str, schema: StructType, bad_records: str = "fail") -> DataFrame:
    """A CSV with a header that must match the schema, or reading it fails; a missing file raises `SourceNotFound`.

    A value that does not fit its column makes the reading fail. With `bad_records="keep"` it turns null and the
    record stays as received in `_corrupt_record`, which is null for good records.
    """
    if bad_records not in ("fail", "keep"):
        raise ValueError("bad_records is fail or keep")
    reader = spark.read.option("header", True).option("enforceSchema", False)
    if bad_records == "fail":
        return _open(reader.schema(schema).option("mode", "FAILFAST").csv, path)
    marked = StructType([*schema.fields, StructField(CORRUPT, StringType(), True)])
    return _open(reader.schema(marked).option("columnNameOfCorruptRecord", CORRUPT).csv, path)


def read_parquet(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A Parquet dataset; a missing path gives an empty frame of the schema."""
    try:
        return _open(spark.read.schema(schema).parquet, path)
    except SourceNotFound:
        return spark.createDataFrame([], schema)


def read_events_with_fallback(spark: SparkSession, parquet_path: str, csv_path: str,
                              parquet_schema: StructType, csv_schema: StructType) -> DataFrame:
    """The Parquet lake if it is there, else the CSV, else `SourceNotFound`."""
    try:
        return _open(spark.read.schema(parquet_schema).parquet, parquet_path)
    except SourceNotFound:
        return read_csv(spark, csv_path, csv_schema)


def read_date_partitions(spark: SparkSession, path: str, since: dt.date, until: dt.date,
                         schema: StructType | None = None) -> DataFrame:
    """The days from `since` to `until`, both included, of what `write_date_partitioned` wrote; see `read_days`."""
    return read_days(spark, path, [since + dt.timedelta(days=n) for n in range((until - since).days + 1)], schema)


def read_days(spark: SparkSession, path: str, days: list[dt.date], schema: StructType | None = None) -> DataFrame:
    """These days of what `write_date_partitioned` wrote.

    Only the folders of these days are opened, so that a lake of many years is not listed for one day of it. Days
    without a folder hold no rows; if none has one, the frame is empty and needs the schema.
    """
    root = path.rstrip("/")
    folders = [f"{root}/year={day.year}/month={day.month}/day={day.day}" for day in days]
    files = spark._jvm.org.apache.hadoop.fs
    system = files.Path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    there = [folder for folder in folders if system.exists(files.Path(folder))]
    reader = spark.read.option("basePath", root)
    reader = reader.schema(schema) if schema is not None else reader
    if there:
        return reader.parquet(*there)
    if schema is None:
        raise SourceNotFound(f"{root} has none of {len(days)} days from {min(days)} to {max(days)}" if days else root)
    return spark.createDataFrame([], schema)


def load_reference_dimensions(spark: SparkSession, folder: str, views: bool = False,
                              required: tuple[str, ...] = ()) -> dict[str, DataFrame]:
    """The history files that exist in a folder, by table name; also as temporary views if asked.

    A table that is not in the result had no file; one that is `required` raises `SourceNotFound` instead.
    """
    tables = {}
    for name, (file_name, schema) in HISTORY_FILES.items():
        try:
            tables[name] = read_csv(spark, f"{folder.rstrip('/')}/{file_name}", schema)
        except SourceNotFound:
            if name in required:
                raise
            continue
        if views:
            tables[name].createOrReplaceTempView(name)
    return tables
