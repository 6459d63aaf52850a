"""The register of queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .model import TABLE_SQL, TrafficModel

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a function of the traffic model under a name; `sql` runs on the model's tables."""
    def register(build: Callable[[TrafficModel], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(TrafficModel(spark, sf_dir))
        run.__name__ = run.__qualname__ = name
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = with_tables(sql)
        return build
    return register


def with_tables(sql: str) -> str:
    """The SQL after the definitions of the model's tables; it may add definitions of its own."""
    sql = sql.strip()
    if sql.startswith("WITH "):
        return f"WITH {TABLE_SQL},\n{sql.removeprefix('WITH ')}"
    return f"WITH {TABLE_SQL}\n{sql}"


def rounded(expression: str, digits: int = 6) -> str:
    """SQL twin of `functions.round_numeric`: half up, after cutting noise past the 12th decimal."""
    return f"CAST(round(CAST({expression} AS DECIMAL(38,12)), {digits}) AS DOUBLE)"
