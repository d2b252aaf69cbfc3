"""Data-quality checks. Each is one pass and gives one row: check, failures."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _row(df: DataFrame, name: str, failures: Column) -> DataFrame:
    return df.agg(failures.cast("bigint").alias("failures")).select(F.lit(name).alias("check"), "failures")


def not_empty(df: DataFrame) -> DataFrame:
    return _row(df.limit(1), "not_empty", (F.count("*") == 0).cast("int"))


def at_least(df: DataFrame, floor: int) -> DataFrame:
    return _row(df, "at_least", (F.count("*") < floor).cast("int"))


def unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows beyond the first of each key."""
    return _row(df.groupBy(*keys).agg(F.count("*").alias("n")), "unique", F.coalesce(F.sum(F.col("n") - 1), F.lit(0)))


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return _row(df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1"), "duplicate_keys", F.count("*"))


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    keys = parent.select(F.col(parent_key).alias(child_key)).distinct()
    return _row(child.where(F.col(child_key).isNotNull()).join(keys, child_key, "left_anti"), "orphans", F.count("*"))


def not_null(df: DataFrame, column: str) -> DataFrame:
    return _row(df, f"not_null_{column}", F.count_if(F.col(column).isNull()))


def accepted(df: DataFrame, column: str, values: list) -> DataFrame:
    return _row(df, f"accepted_{column}", F.count_if(~F.col(column).isin(values)))


def unknown_values(df: DataFrame, column: str, known: list) -> DataFrame:
    return df.where(~F.col(column).isin(known)).select(column).distinct()


def fresh(df: DataFrame, column: str, now: Column, days: int) -> DataFrame:
    """Fails if the newest value is more than days before now, or there is none."""
    return _row(df, "fresh", (~F.coalesce(F.max(column) >= now - F.expr(f"interval {days} days"), F.lit(False))).cast("int"))


def holds(df: DataFrame, name: str, condition: Column) -> DataFrame:
    """Rows for which the condition isn't true."""
    return _row(df, name, F.count_if(~F.coalesce(condition, F.lit(False))))


def all_of(*checks: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, checks)


def require(df: DataFrame, condition: Column, message: str) -> DataFrame:
    """df itself; reading it fails with the message at the first row for which the condition isn't true."""
    return df.where(F.when(F.coalesce(condition, F.lit(False)), F.lit(True)).otherwise(F.raise_error(F.lit(message)).cast("boolean")))


def fingerprint(df: DataFrame) -> DataFrame:
    """Order-independent checksum of a table: rows, and sum and exclusive or of row hashes."""
    h = F.xxhash64(*df.columns)
    return df.agg(F.count("*").alias("rows"), F.sum(h.cast("decimal(38,0)")).alias("sum"), F.bit_xor(h).alias("xor"))
