"""Publication of tables: staged swaps, partition replacement, merges, retention."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F


class EmptyStage(ValueError):
    """A stage without rows is never published."""


def _files(spark: SparkSession, path: str) -> tuple:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def _move(spark: SparkSession, source: str, target: str) -> None:
    fs, where = _files(spark, source)
    if not fs.rename(where, _files(spark, target)[1]):
        raise OSError(f"{source} could not be renamed to {target}")


def _exists(spark: SparkSession, path: str) -> bool:
    fs, where = _files(spark, path)
    return bool(fs.exists(where))


def _delete(spark: SparkSession, path: str) -> None:
    fs, where = _files(spark, path)
    fs.delete(where, True)


def recover(spark: SparkSession, path: str) -> None:
    """Ends a swap that was broken off between two of its steps: a validated table that stands beside the target takes its
    place, and what it replaced goes."""
    coming, old = f"{path}.next", f"{path}.old"
    if _exists(spark, coming):
        if _exists(spark, path):
            _delete(spark, old)
            _move(spark, path, old)
        _move(spark, coming, path)
    if _exists(spark, path):
        _delete(spark, old)


def current(spark: SparkSession, path: str) -> DataFrame | None:
    """The table as last published, at any moment of a swap; None if there never was one."""
    for where in (f"{path}.next", path, f"{path}.old"):
        if _exists(spark, where):
            return spark.read.parquet(where)
    return None


def swap(df: DataFrame, path: str, *, least_rows: int = 1, check: Callable[[DataFrame], None] | None = None) -> int:
    """Writes beside the target, validates what was written, then renames it into place; the old table goes last. A failed
    check leaves the target as it was. Returns the rows published.

    The table counts as published with its rename to `.next`. Whoever is broken off after that, `recover` or the next
    swap ends it. Between the target's two renames only `current` sees the table."""
    spark = df.sparkSession
    stage = f"{path}.stage-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(stage)
    staged = spark.read.schema(df.schema).parquet(stage)
    rows = staged.count()
    try:
        if rows < least_rows:
            raise EmptyStage(f"{rows} rows, {least_rows} asked for")
        if check:
            check(staged)
    except Exception:
        _delete(spark, stage)
        raise
    recover(spark, path)
    _move(spark, stage, f"{path}.next")
    recover(spark, path)
    return rows


def recover_partitions(spark: SparkSession, path: str) -> None:
    """Ends an exchange of partitions that was broken off: those in `_next` take the place of the target's."""
    coming, old = f"{path}/_next", f"{path}/_old"
    if _exists(spark, coming):
        fs, where = _files(spark, coming)
        fs.mkdirs(_files(spark, old)[1])
        for found in fs.listStatus(where):
            name = found.getPath().getName()
            if "=" in name:
                if _exists(spark, f"{path}/{name}"):
                    _delete(spark, f"{old}/{name}")
                    _move(spark, f"{path}/{name}", f"{old}/{name}")
                _move(spark, f"{coming}/{name}", f"{path}/{name}")
    _delete(spark, coming)
    _delete(spark, old)
    if _exists(spark, path):  # stages that were never finished
        fs, where = _files(spark, path)
        for found in fs.listStatus(where):
            if found.getPath().getName().startswith("_stage-"):
                fs.delete(found.getPath(), True)


def has_partitions(spark: SparkSession, path: str) -> bool:
    if not _exists(spark, path):
        return False
    fs, where = _files(spark, path)
    return any("=" in found.getPath().getName() for found in fs.listStatus(where))


def swap_partitions(df: DataFrame, path: str, by: str) -> None:
    """Exchanges the partitions that df has rows of for df's, all or, after `recover_partitions`, none; others stay."""
    spark, stage = df.sparkSession, f"{path}/_stage-{uuid.uuid4().hex}"
    recover_partitions(spark, path)
    df.write.partitionBy(by).option("compression", "zstd").parquet(stage)
    _move(spark, stage, f"{path}/_next")
    recover_partitions(spark, path)


def replace_partitions(df: DataFrame, path: str, by: list[str]) -> None:
    """Replaces just the partitions that df has rows of; never from an empty stage."""
    if df.isEmpty():
        raise EmptyStage("no partition to replace")
    df.write.partitionBy(*by).option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(path)


def drop_partition(spark: SparkSession, path: str, column: str, value: str) -> bool:
    fs, where = _files(spark, f"{path}/{column}={value}")
    return bool(fs.delete(where, True))


def replace_window(current: DataFrame, fresh: DataFrame, inside: Column) -> DataFrame:
    """current with the rows inside a window exchanged for fresh ones: loading the same range twice changes nothing."""
    return current.where(~F.coalesce(inside, F.lit(False))).unionByName(fresh.where(inside))


def upsert(current: DataFrame, fresh: DataFrame, keys: list[str], touched: str) -> DataFrame:
    """current with fresh rows put in by key; the touched column keeps its old value where nothing else differs."""
    values = [c for c in fresh.columns if c not in keys and c != touched]
    old = current.select(*keys, F.lit(True).alias("__old"), *[F.col(c).alias(f"__{c}") for c in [*values, touched]])
    joined = fresh.withColumn("__new", F.lit(True)).join(old, keys, "full")
    is_new = F.coalesce("__new", F.lit(False))
    same = F.coalesce("__old", F.lit(False))
    for c in values:
        same = same & F.col(c).eqNullSafe(F.col(f"__{c}"))
    picked = [F.when(is_new, F.col(c)).otherwise(F.col(f"__{c}")).alias(c) for c in values]
    stamp = F.when(is_new & ~same, F.col(touched)).otherwise(F.col(f"__{touched}")).alias(touched)
    return joined.select(*keys, *picked, stamp)


def absent(current: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of current whose key isn't among the incoming ones: what a full reload would delete."""
    return current.join(incoming.select(*keys).distinct(), keys, "left_anti")


def deactivate_absent(current: DataFrame, incoming: DataFrame, keys: list[str], flag: str) -> DataFrame:
    """The soft form: absent rows stay, with the flag off."""
    marks = incoming.select(*keys).distinct().withColumn("__in", F.lit(True))
    return current.join(marks, keys, "left").withColumn(flag, F.col(flag) & F.coalesce("__in", F.lit(False))).drop("__in")


def missing_keys(current: DataFrame, incoming: DataFrame, keys: list[str]) -> DataFrame:
    """Incoming rows whose natural key isn't known yet, once each."""
    return incoming.dropDuplicates(keys).join(current.select(*keys), keys, "left_anti")


def unexpired(df: DataFrame, until: str, days: int, now: Column) -> DataFrame:
    """Rows whose retention, `days` after their own end, hasn't run out."""
    return df.where(F.col(until) + F.expr(f"interval {days} days") >= now)


def rows(df: DataFrame) -> Iterator[Row]:
    """Rows for a client, a partition at a time."""
    return df.toLocalIterator(prefetchPartitions=True)
