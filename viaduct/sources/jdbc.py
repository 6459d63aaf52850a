"""Relational tables over JDBC, and free SELECTs with bound parameters."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class JdbcTarget:
    """Where a database is. The driver jar must be on the cluster's class path."""
    url: str
    user: str | None = None
    password: str | None = field(default=None, repr=False)
    driver: str = "org.postgresql.Driver"
    batch_size: int = 10_000
    connections: int = 16

    def options(self) -> dict[str, str]:
        given = {"url": self.url, "user": self.user, "password": self.password, "driver": self.driver}
        return {key: value for key, value in given.items() if value is not None}

    def read_options(self) -> dict[str, str]:
        return {**self.options(), "fetchsize": str(self.batch_size)}

    def write_options(self) -> dict[str, str]:
        # numPartitions caps the open connections, whatever the number of tasks upstream.
        return {**self.options(), "batchsize": str(self.batch_size), "numPartitions": str(self.connections)}


def read_table(spark: SparkSession, target: JdbcTarget, table: str, query: str | None = None, *,
               split_on: str | None = None, bounds: tuple[object, object] | None = None) -> DataFrame:
    """A whole table or the result of a SELECT.

    A large table should name a numeric, date or timestamp column to split on: it is then read over
    several connections at once. The bounds only shape the split and drop no rows; where they are not
    given the database is asked for the least and greatest value. Without a split one connection reads all.
    """
    source = f"({query}) AS selected" if query else table
    reader = spark.read.format("jdbc").options(**target.read_options())
    if split_on is None:
        return reader.option("dbtable", source).load()
    if bounds is None:
        extremes = f"SELECT min({split_on}) AS low, max({split_on}) AS high FROM {source}"
        found = spark.read.format("jdbc").options(**target.read_options()).option("query", extremes).load().first()
        bounds = found[0], found[1]
    if None in bounds:  # an empty table
        return reader.option("dbtable", source).load()
    return reader.options(partitionColumn=split_on, lowerBound=str(bounds[0]), upperBound=str(bounds[1]),
                          numPartitions=str(target.connections)).option("dbtable", source).load()


def read_query(spark: SparkSession, query: str, params: dict | None = None,
               tables: dict[str, DataFrame] | None = None) -> DataFrame:
    """A SELECT over views with named parameters (`:name`), bound as values and not pasted as text.

    `tables` may be given instead of views; the query then names them in braces, such as `{roads}`.
    """
    return spark.sql(query, args=params or {}, **(tables or {}))
