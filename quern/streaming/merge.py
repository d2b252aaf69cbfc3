"""Structured Streaming: idempotent merges of mergeable state, fan-out, windows, sessions, replay."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources import publish


def folder_stream(spark: SparkSession, path: str, schema, files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def seen_window(df: DataFrame, keys: list[str], at: str, label: str) -> DataFrame:
    """State that merges by minimum, maximum and set union only, so that replays and late rows change nothing."""
    return df.groupBy(*keys).agg(F.min(at).alias("first_seen"), F.max(at).alias("last_seen"), F.array_sort(F.collect_set(label)).alias("labels"))


def merged(states: DataFrame, keys: list[str]) -> DataFrame:
    """Partial states of the same keys as one."""
    return states.groupBy(*keys).agg(F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("labels")))).alias("labels"))


#: Parts of a merged table: a batch rewrites those that its keys fall into.
BUCKETS = 64


def merge_stream(stream: DataFrame, target: str, checkpoint: str, keys: list[str], at: str, label: str, buckets: int = BUCKETS) -> StreamingQuery:
    """Keeps a table of seen windows, dealt into buckets by key. Each batch's partial states are merged with those in the
    buckets that it touches, and these buckets are exchanged; others are neither read nor written. Running a batch again,
    or after it was broken off anywhere, gives the same table. Only a first batch may find no table."""

    def apply(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        publish.recover_partitions(spark, target)
        fresh = seen_window(batch, keys, at, label).withColumn("bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")).persist()
        try:
            touched = [r["bucket"] for r in fresh.select("bucket").distinct().collect()]  # one of `buckets` numbers each
            if not touched:
                return
            if publish.has_partitions(spark, target):
                known = spark.read.schema(fresh.schema).parquet(target).where(F.col("bucket").isin(touched)).select(*fresh.columns)
                fresh_and_known = known.unionByName(fresh)
            elif number:
                raise FileNotFoundError(f"{target} is gone, though batch {number} is not the first")
            else:
                fresh_and_known = fresh
            publish.swap_partitions(merged(fresh_and_known, ["bucket", *keys]), target, "bucket")
        finally:
            fresh.unpersist()

    return stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def buffered(stream: DataFrame, folder: str, checkpoint: str, *, rows: int, seconds: float, attempts: int = 3) -> StreamingQuery:
    """A sink that flushes what came in every so many seconds, in files of at most `rows` rows. A flush that fails is tried
    again, into the same folder of its own, before the query fails; the query started anew takes it up where it was."""

    def apply(batch: DataFrame, number: int) -> None:
        for attempt in range(attempts):
            try:
                batch.write.mode("overwrite").option("maxRecordsPerFile", rows).parquet(f"{folder}/batch={number}")
                return
            except Exception:  # noqa: BLE001
                if attempt + 1 == attempts:
                    raise

    return stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(processingTime=f"{seconds} seconds").start()


def refreshed(spark: SparkSession, make: Callable[[], DataFrame], path: str, checkpoint: str, seconds: float, least_rows: int = 1) -> StreamingQuery:
    """Publishes a full snapshot anew at once and then every so many seconds; a stage below least_rows leaves the last one."""

    def apply(_: DataFrame, __: int) -> None:
        try:
            publish.swap(make(), path, least_rows=least_rows)
        except publish.EmptyStage:
            pass

    clock = spark.readStream.format("rate").option("rowsPerSecond", 1).load()
    return clock.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(processingTime=f"{seconds} seconds").start()


def to_table(stream: DataFrame, folder: str, mode: str) -> DataFrame:
    """Runs a stream to the end of its input into a table in a folder, which each batch in complete mode replaces."""
    write = "overwrite" if mode == "complete" else "append"
    running = stream.writeStream.outputMode(mode).foreachBatch(lambda batch, _: batch.write.mode(write).parquet(f"{folder}/table")).option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()
    running.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{folder}/table")


def fan_out(stream: DataFrame, sinks: dict[str, Callable[[DataFrame], DataFrame]], folder: str, checkpoint: str) -> StreamingQuery:
    """One batch, many targets. A batch writes to folders named by its number, so a replay overwrites what it wrote
    before; it counts as done only after every sink has it."""

    def apply(batch: DataFrame, number: int) -> None:
        kept = batch.persist()
        try:
            for name, shape in sinks.items():
                shape(kept).write.mode("overwrite").parquet(f"{folder}/{name}/batch={number}")
        finally:
            kept.unpersist()

    return stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def changed_keys(df: DataFrame, since: Column, loaded: str, keys: list[str]) -> DataFrame:
    """All rows of the keys that have a row loaded after the mark: what to derive anew."""
    touched = df.where(F.col(loaded) > since).select(*keys).distinct()
    return df.join(touched, keys, "left_semi")


def windows(df: DataFrame, at: str, size: str, slide: str, by: list[str], late: str = "1 day") -> DataFrame:
    """Counts and sums by event-time window; works on streams and tables."""
    return df.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, late).groupBy(F.window(at, size, slide), *by).agg(F.count("*").alias("n"), F.sum(F.col("value").cast("decimal(18,4)")).cast("double").alias("total"))


def sessions(df: DataFrame, at: str, gap: str, by: list[str], late: str = "1 day") -> DataFrame:
    return df.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, late).groupBy(F.session_window(at, gap).alias("session"), *by).agg(F.count("*").alias("n"))


def health(df: DataFrame, at: str, now: Column, minutes: int, failed: Column) -> DataFrame:
    """One row: the current window against the one before it."""
    age = (F.unix_timestamp(now) - F.unix_timestamp(F.col(at))) / 60
    current, before = (age >= 0) & (age < minutes), (age >= minutes) & (age < 2 * minutes)
    return df.agg(F.count_if(current).alias("current"), F.count_if(before).alias("before"), F.count_if(current & failed).alias("failed"), F.count_if(before & failed).alias("failed_before"))


def decision(running: bool, age_minutes: float, due_minutes: float, least_minutes: float) -> str:
    """Whether a debounced refresh may start."""
    return "running" if running else "too_fresh" if age_minutes < least_minutes else "due_soon" if due_minutes < least_minutes else "allow"
