"""Rollups of facts: contracts, latest figures, exchange rates, turnover guards, centroids, folds of sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geo

NO_AMOUNT = -1.0


def per_source_then_best(facts: DataFrame, key: str, source: str, described: list[str], winner: str, amount: str, day: str) -> DataFrame:
    """One row per key from winner-level facts. Each (key, source) is summed first, with its least winner, the number of
    distinct winners and its greatest day and descriptions; the source with the greatest amount then gives every column,
    the lesser source name among equals. A key without any amount has a null one, unlike a true zero."""
    per = facts.groupBy(key, source).agg(
        *[F.max(c).alias(c) for c in described],
        F.min(winner).alias("first_winner"),
        F.countDistinct(winner).alias("winners"),
        F.max(day).alias("day"),
        F.coalesce(F.sum(F.col(amount).cast("decimal(18,4)")).cast("double"), F.lit(NO_AMOUNT)).alias("priority"),
    )
    columns = [*described, "first_winner", "winners", "day"]
    order = F.struct((-F.col("priority")).alias("p"), F.col(source).isNull().alias("n"), F.col(source).alias("s"))
    best = per.groupBy(key).agg(F.min_by(F.struct(source, *columns), order).alias("b"), F.max("priority").alias("p"))
    return best.select(key, f"b.{source}", *[f"b.{c}" for c in columns], F.nullif("p", F.lit(NO_AMOUNT)).alias("amount"))


def counted_once(facts: DataFrame, reference: str, source: str, holder: str, amount: str) -> DataFrame:
    """Totals per holder where a reference that several sources report counts once, with its greatest figure."""
    each = facts.groupBy(reference, source, holder).agg(F.sum(F.col(amount).cast("decimal(18,4)")).alias("v"))
    once = each.groupBy(reference, holder).agg(F.max("v").alias("v"), F.count("*").alias("sources"))
    return once.groupBy(holder).agg(F.sum("v").cast("double").alias("total"), F.count("*").alias("contracts"), F.count_if(F.col("sources") > 1).alias("shared"))


def latest_summary(facts: DataFrame, key: str, year: str, order: list[Column], amount: Column, fallback: Column) -> DataFrame:
    """The newest year's row per key, its amount or the fallback, and the number of distinct years."""
    w = Window.partitionBy(key)
    ranked = facts.withColumn("__n", F.row_number().over(w.orderBy(F.col(year).desc_nulls_last(), *order))).withColumn("years", F.size(F.collect_set(year).over(w)).cast("bigint"))
    return ranked.where("__n = 1").withColumn("amount", F.coalesce(amount, fallback)).drop("__n")


def flag_outliers(daily: DataFrame, key: str, value: str, factor: float, least_days: int) -> DataFrame:
    """Adds implausible: the value is more than factor times the key's own median over at least least_days days. Rows are
    flagged, not dropped; keys with a shorter history or no positive median are never flagged."""
    medians = daily.groupBy(key).agg(F.median(value).alias("__median"), F.count("*").alias("__days")).where((F.col("__days") >= least_days) & (F.col("__median") > 0))
    return daily.join(medians, key, "left").withColumn("implausible", F.coalesce(F.col(value) > F.col("__median") * factor, F.lit(False))).drop("__median", "__days")


def cross_rates(rates: DataFrame, day: str, currency: str, rate: str, to: str) -> DataFrame:
    """Rates into one currency from rates per one base currency, on the days where both legs exist."""
    leg = rates.where(F.col(currency) == to).select(day, F.col(rate).alias("__to"))
    return rates.join(leg, day).select(day, currency, (F.col("__to") / F.col(rate)).alias("factor"))


def robust_centroids(points: DataFrame, key: str, least: int) -> DataFrame:
    """Median latitude and longitude of keys with at least `least` points, and the greatest distance to them in metres."""
    usable = points.where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull() & (F.col(key) != ""))
    middle = usable.groupBy(key).agg(F.median("latitude").alias("lat"), F.median("longitude").alias("lon"), F.count("*").alias("points")).where(F.col("points") >= least)
    spread = usable.join(middle, key).groupBy(key, "lat", "lon", "points").agg(F.max(geo.haversine(F.col("latitude"), F.col("longitude"), F.col("lat"), F.col("lon"))).alias("spread"))
    return spread


def fold(suggestions: DataFrame, key: str, fields: list[str], ranks: DataFrame, register: list[str], required: str) -> DataFrame:
    """One row per key: for each field the value of the highest-ranked source, then the newest, then the least uid.

    suggestions: key, source, observed_at, uid and the fields; null and empty mean no opinion. ranks: field, source, rank,
    few rows; a source without a rank for a field has no say in it. Keys for which no register source gives the required
    field are left out. Fields become rows, meet their ranks, and the best value of each comes by one aggregation."""
    long = suggestions.select(key, "source", "observed_at", "uid", F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value")) for f in fields])).alias("x")).select(key, "source", "observed_at", "uid", "x.field", "x.value")
    known = long.where("value is not null and value <> ''")
    weighed = known.join(F.broadcast(ranks), ["field", "source"])
    order = F.struct((-F.col("rank")).alias("r"), (-F.unix_micros(F.col("observed_at").cast("timestamp"))).alias("o"), F.col("uid").alias("u"))
    best = weighed.groupBy(key, "field").agg(F.min_by(F.struct("value", "source"), order).alias("b"))
    wide = best.groupBy(key).agg(*[x for f in fields for x in (F.max(F.when(F.col("field") == f, F.col("b.value"))).alias(f), F.coalesce(F.max(F.when(F.col("field") == f, F.col("b.source"))), F.lit("")).alias(f"{f}_source"))])
    named = known.where(F.col("source").isin(register) & (F.col("field") == required)).select(key).distinct()
    return wide.join(named, key, "left_semi")


def changed_fields(before: DataFrame, after: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """key, change_kind (created, removed, updated) and the names of the changed columns in order, for keys that changed."""
    old = before.select(key, F.lit(1).alias("__before"), *[F.col(c).alias(f"__{c}") for c in columns])
    joined = after.withColumn("__after", F.lit(1)).join(old, key, "full")
    names = F.array_compact(F.array(*[F.when(~F.col(c).eqNullSafe(F.col(f"__{c}")), F.lit(c)) for c in columns]))
    kind = F.when(F.col("__before").isNull(), "created").when(F.col("__after").isNull(), "removed").otherwise("updated")
    return joined.select(key, kind.alias("change_kind"), names.alias("changed")).where((F.size("changed") > 0) | (F.col("change_kind") != "updated"))


def state_hash(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Order-independent fingerprint of each key's rows."""
    row = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("\\N")) for c in columns])
    return df.groupBy(key).agg(F.sha2(F.array_join(F.array_sort(F.collect_list(row)), "\n"), 256).alias("state"))


def state_changes(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """Keys whose state hash differs (changed), is new, or is gone (tombstone)."""
    joined = after.select(key, F.col("state").alias("now")).join(before.select(key, F.col("state").alias("was")), key, "full")
    kind = F.when(F.col("was").isNull(), "new").when(F.col("now").isNull(), "tombstone").otherwise("changed")
    return joined.where(~F.col("now").eqNullSafe(F.col("was"))).select(key, kind.alias("change"))
