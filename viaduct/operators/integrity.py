"""Key, not-null and reference checks. Each returns violations; an empty result means all is well."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

from .dimensions import DEFAULT_LIMIT, BroadcastLimit, join_dim


def check_references(child: DataFrame, references: dict[str, tuple[DataFrame, str]],
                     limit: BroadcastLimit = DEFAULT_LIMIT) -> DataFrame:
    """Values of foreign-key columns that the parent table lacks, with how many rows hold them.

    `references` maps a column of `child` to (parent table, parent key). The child is read once for all
    references and reduced to its distinct values per column before the anti join, so a value held by most
    rows costs no more than a rare one. A null refers to nothing and is no violation. Without references
    there are no violations.
    """
    if not references:
        return child.sparkSession.createDataFrame([], "column_name string, missing_key string, rows long")

    def key_of(column: str, kind) -> Column:
        return F.col(column).cast(kind).cast("string")

    kinds = {column: parent.schema[key].dataType for column, (parent, key) in references.items()}
    held = F.array(*[F.struct(F.lit(column).alias("column_name"), key_of(column, kind).alias("missing_key"))
                     for column, kind in kinds.items()])
    used = (child.select(F.inline(held)).where(F.col("missing_key").isNotNull())
            .groupBy("column_name", "missing_key").agg(F.count(F.lit(1)).alias("rows")))
    known = reduce(DataFrame.unionAll, [
        parent.select(F.lit(column).alias("column_name"), key_of(key, kinds[column]).alias("missing_key"))
        for column, (parent, key) in references.items()]).distinct()
    return join_dim(used, known, ["column_name", "missing_key"], "left_anti", limit).select(
        "column_name", "missing_key", "rows")


def violating_rows(child: DataFrame, column: str, parent: DataFrame, key: str,
                   limit: BroadcastLimit = DEFAULT_LIMIT) -> DataFrame:
    """The rows of `child` themselves whose reference is dangling."""
    known = parent.select(F.col(key).alias(column)).distinct()
    return join_dim(child.where(F.col(column).isNotNull()), known, column, "left_anti", limit)


def check_not_null_unique(df: DataFrame, required: list[str], unique: list[str]) -> DataFrame:
    """One row per broken rule: `(rule, column_name, violations)`.

    All rules are counted in one pass. For a unique column the violations are the rows beyond the first
    of each value; nulls do not clash. Without rules there are no violations.
    """
    if not required and not unique:
        return df.sparkSession.createDataFrame([], "rule string, column_name string, violations long")

    def noted(rule: str, column: str, value: Column, counts: Column) -> Column:
        return F.struct(F.lit(rule).alias("rule"), F.lit(column).alias("column_name"), value.alias("value"),
                        counts.cast("long").alias("n"))

    def written(column: str) -> Column:
        nested = isinstance(df.schema[column].dataType, (ArrayType, MapType, StructType))
        return F.to_json(column) if nested else F.col(column).cast("string")

    notes = [noted("NOT NULL", c, F.lit(None).cast("string"), F.col(c).isNull()) for c in required]
    notes += [noted("UNIQUE", c, written(c), F.col(c).isNotNull()) for c in unique]
    counted = (df.select(F.inline(F.array(*notes))).where("n > 0")
               .groupBy("rule", "column_name", "value").agg(F.sum("n").alias("n")))
    beyond = F.when(F.col("rule") == "UNIQUE", F.col("n") - 1).otherwise(F.col("n"))
    return (counted.groupBy("rule", "column_name").agg(F.sum(beyond).alias("violations"))
            .where(F.col("violations") > 0))
