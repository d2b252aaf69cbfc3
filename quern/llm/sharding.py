"""Rendezvous hashing of stable record keys over weighted shards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .storage import materialize, shuffle_width


def rendezvous(key: Column, weights: list[float]) -> Column:
    """The shard whose score for the key is best: -ln(u) / weight is least, u being the key's and shard's hash in (0, 1).

    Key and weights alone decide. One more shard, or more weight for one, moves keys only into that shard. A null key
    hashes like any other value. Equal scores go to the lower shard."""
    if not weights or any(w <= 0 for w in weights):
        raise ValueError("weights must be positive")
    unit = lambda k: (F.shiftrightunsigned(F.xxhash64(key, F.lit(k)), 11) + F.lit(0.5)) * F.lit(2.0**-53)
    return F.least(*[F.struct((-F.ln(unit(k)) / F.lit(float(w))).alias("score"), F.lit(k).alias("shard")) for k, w in enumerate(weights)])["shard"] if len(weights) > 1 else F.lit(0)


def numbered(rows: DataFrame, group: str, order: list[str], spread: Column) -> DataFrame:
    """Adds slot: a number from 0 without gaps within group. Rows are dealt into buckets by spread, ranked within
    (group, bucket) and moved up by the buckets before, so that no task holds a whole group."""
    buckets = shuffle_width(rows.sparkSession)
    dealt = rows.withColumn("__bucket", F.pmod(spread, F.lit(buckets)))
    sizes = dealt.groupBy(group, "__bucket").agg(F.count("*").alias("__n"))
    before = F.coalesce(F.sum("__n").over(Window.partitionBy(group).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.select(F.col(group).alias("__g"), F.col("__bucket").alias("__b"), before.alias("__before"))
    ranked = dealt.withColumn("__rank", F.row_number().over(Window.partitionBy(group, "__bucket").orderBy(*order)) - 1)
    joined = ranked.join(starts, F.col(group).eqNullSafe(F.col("__g")) & (F.col("__bucket") == F.col("__b")))
    return joined.withColumn("slot", (F.col("__rank") + F.col("__before")).cast("bigint")).drop("__bucket", "__n", "__rank", "__g", "__b", "__before")


def assign_shards(docs: DataFrame, *, weights: list[float], key_col: str = "doc_id", carry: dict[str, Column] | None = None) -> DataFrame:
    """key, shard, grown_shard (with one more shard of mean weight), slot and the carried columns; one row per row.

    Rows with equal keys, nulls included, share a shard; slots within a shard are gapless from 0. An empty table gives
    an empty result. Other columns are ignored."""
    carry = carry or {}
    rows = docs.select(F.col(key_col), *[c.alias(n) for n, c in carry.items()])
    rows = rows.withColumn("shard", rendezvous(F.col(key_col), weights)).withColumn("grown_shard", rendezvous(F.col(key_col), [*weights, sum(weights) / len(weights)]))
    rows = materialize(rows)
    return numbered(rows, "shard", [key_col, *carry], F.xxhash64(F.col(key_col), F.lit("slot"), *[F.col(c) for c in carry]))
