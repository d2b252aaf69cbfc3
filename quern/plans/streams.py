"""Streaming queries over the events table, each run to the end of its input, and batch forms of the same state."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import shared_dir
from ..streaming import merge
from .catalog import Tables, query


def drained(t: Tables, shape, mode: str = "complete") -> DataFrame:
    """What a stream over the events gives once it has read them all."""
    events = t.spark.readStream.schema(t.events.schema).option("pathGlobFilter", "events.parquet").parquet(t.folder) if not t.events.inputFiles()[0].rstrip("/").split("/")[-2].endswith(".parquet") else t.spark.readStream.schema(t.events.schema).parquet(f"{t.folder}/events.parquet")
    return merge.to_table(shape(events), f"{shared_dir(t.spark)}/quern-stream-{uuid.uuid4().hex}", mode)


@query("t01_t02_mergeable_state", "SELECT user_id, min(ts) AS first_seen, max(ts) AS last_seen, string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS labels FROM events GROUP BY 1")
def _(t: Tables) -> DataFrame:
    return drained(t, lambda e: merge.seen_window(e, ["user_id"], "ts", "event_type")).withColumn("labels", F.array_join("labels", ","))


@query("t03_late_merge", "SELECT user_id, min(ts) AS first_seen, max(ts) AS last_seen, string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS labels FROM events GROUP BY 1")
def _(t: Tables) -> DataFrame:
    late = merge.seen_window(t.events.where("event_id % 2 = 0"), ["user_id"], "ts", "event_type")
    early = merge.seen_window(t.events.where("event_id % 2 = 1"), ["user_id"], "ts", "event_type")
    return merge.merged(late.unionByName(early).unionByName(late), ["user_id"]).withColumn("labels", F.array_join("labels", ","))


@query("t04_high_water_mark", "SELECT user_id, count(*) AS n FROM events WHERE user_id IN (SELECT user_id FROM events WHERE event_id > 9000) GROUP BY 1")
def _(t: Tables) -> DataFrame:
    return merge.changed_keys(t.events, F.lit(9000), "event_id", ["user_id"]).groupBy("user_id").agg(F.count("*").alias("n"))


@query("t05_cursor_replay", "SELECT event_type, count(*) AS n, count(DISTINCT event_id) AS ids FROM events GROUP BY 1")
def _(t: Tables) -> DataFrame:
    replayed = t.events.unionByName(t.events.where("event_id < 500")).dropDuplicates(["event_id"])
    return replayed.groupBy("event_type").agg(F.count("*").alias("n"), F.countDistinct("event_id").alias("ids"))


@query("t07_sliding_windows", "SELECT CAST(w AS VARCHAR) AS start, event_type, count(*) AS n FROM (SELECT event_type, unnest([time_bucket(INTERVAL 15 MINUTES, ts), time_bucket(INTERVAL 15 MINUTES, ts) - INTERVAL 15 MINUTES]) AS w FROM events) GROUP BY 1, 2")
def _(t: Tables) -> DataFrame:
    found = drained(t, lambda e: merge.windows(e, "ts", "30 minutes", "15 minutes", ["event_type"]))
    return found.select(F.date_format("window.start", "yyyy-MM-dd HH:mm:ss").alias("start"), "event_type", "n")


@query("t07_tumbling_windows", "SELECT CAST(time_bucket(INTERVAL 1 HOUR, ts) AS VARCHAR) AS start, count(*) AS n, CAST(sum(CAST(value AS DECIMAL(18,4))) AS DOUBLE) AS total FROM events GROUP BY 1")
def _(t: Tables) -> DataFrame:
    found = drained(t, lambda e: merge.windows(e, "ts", "1 hour", "1 hour", []))
    return found.select(F.date_format("window.start", "yyyy-MM-dd HH:mm:ss").alias("start"), "n", "total")


@query(
    "t07_sessions",
    """WITH e AS (SELECT user_id, ts, ts >= lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL 6 HOURS AS fresh FROM events), s AS (SELECT *, sum(CASE WHEN fresh THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM e)
    SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS start, count(*) AS n FROM s GROUP BY user_id, k""",
)
def _(t: Tables) -> DataFrame:
    return merge.sessions(t.events, "ts", "6 hours", ["user_id"]).select("user_id", F.date_format("session.start", "yyyy-MM-dd HH:mm:ss").alias("start"), "n")


@query("t07_health", "SELECT count(*) FILTER (a >= 0 AND a < 1440) AS current, count(*) FILTER (a >= 1440 AND a < 2880) AS before, count(*) FILTER (a >= 0 AND a < 1440 AND value < 10) AS failed, count(*) FILTER (a >= 1440 AND a < 2880 AND value < 10) AS failed_before FROM (SELECT value, (floor(epoch(TIMESTAMP '2024-01-20')) - floor(epoch(ts))) / 60 AS a FROM events)")
def _(t: Tables) -> DataFrame:
    return merge.health(t.events, "ts", F.lit("2024-01-20").cast("timestamp"), 1440, F.col("value") < 10)
