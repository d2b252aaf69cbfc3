"""Collapsing versioned records: one row per key, or the first n."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: list[str], order: list[Column], n: int = 1) -> DataFrame:
    """The first n rows of each key in the order given, which must break all ties. Spark keeps n rows a key and task
    before the shuffle (WindowGroupLimit), so hot keys cost little."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rank", F.row_number().over(w)).where(F.col("__rank") <= n).drop("__rank")


def latest(df: DataFrame, keys: list[str], version: str, tie: list[str]) -> DataFrame:
    """The row with the greatest (version, *tie) per key, by a hash aggregation of structs; null versions lose."""
    rest = [c for c in df.columns if c not in keys and c != version and c not in tie]
    best = F.max(F.struct(*[F.col(c) for c in (version, *tie, *rest)])).alias("best")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col(f"best.{c}").alias(c) for c in (version, *tie, *rest)])


def latest_non_null(df: DataFrame, keys: list[str], columns: list[str], order: Column) -> DataFrame:
    """For each column by itself, its value at the greatest order among rows where it is not null."""
    return df.groupBy(*keys).agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), order)).alias(c) for c in columns])


def prefer(candidates: DataFrame, keys: list[str], version: str, tie: list[str], accepted: Column) -> DataFrame:
    """Latest first, filter second: a key whose latest row isn't accepted has no row."""
    return latest(candidates, keys, version, tie).where(accepted)
