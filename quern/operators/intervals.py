"""Gaps and islands over closed intervals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def islands(df: DataFrame, keys: list[str], start: str, end: str, gap: Column, tie: list[str]) -> DataFrame:
    """Adds island: a number per key that grows where an interval starts at least `gap` after every earlier end."""
    w = Window.partitionBy(*keys).orderBy(start, end, *tie)
    reach = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    fresh = df.withColumn("__new", F.coalesce((F.col(start) >= reach + gap).cast("int"), F.lit(0)))
    return fresh.withColumn("island", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0)).cast("bigint")).drop("__new")


def uncovered(df: DataFrame, keys: list[str], start: str, end: str, fallback: str) -> DataFrame:
    """Primary rows, and the fallback rows that overlap no primary interval of their keys.

    In one sort by start, the furthest primary end so far tells an earlier primary that reaches in; in one the other way
    round, the least primary start so far tells a later one that begins inside. No pairs are made, and both frames only grow:
    one that shrinks towards its end would be worked out anew for every row."""
    primary = ~F.col(fallback)
    last = F.col(fallback).cast("int")
    before = Window.partitionBy(*keys).orderBy(start, last).rowsBetween(Window.unboundedPreceding, 0)
    after = Window.partitionBy(*keys).orderBy(F.col(start).desc(), last.desc()).rowsBetween(Window.unboundedPreceding, 0)
    marked = df.withColumn("__reach", F.max(F.when(primary, F.col(end))).over(before)).withColumn("__next", F.min(F.when(primary, F.col(start))).over(after))
    covered = F.coalesce(F.col("__reach") >= F.col(start), F.lit(False)) | F.coalesce(F.col("__next") <= F.col(end), F.lit(False))
    return marked.where(primary | ~covered).drop("__reach", "__next")


def changes(df: DataFrame, keys: list[str], order: str, state: str) -> DataFrame:
    """Runs of equal state per key: one row per run with its first and last order value and the number of rows."""
    w = Window.partitionBy(*keys).orderBy(order)
    fresh = df.withColumn("__new", F.coalesce((~F.col(state).eqNullSafe(F.lag(state).over(w))).cast("int"), F.lit(1)))
    run = fresh.withColumn("run", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0)).cast("bigint"))
    return run.groupBy(*keys, "run").agg(F.min(order).alias("from"), F.max(order).alias("to"), F.first(state).alias(state), F.count("*").alias("rows"))
