"""Filter builders, paging and facets."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def all_true(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def optional(wanted: dict[str, str]) -> Column:
    """Equality for each column that has a value wanted; empty ones don't filter."""
    return all_true([F.col(c) == v for c, v in wanted.items() if v != ""])


@dataclass
class Facets:
    """A filter put together from what a caller chose. Amount bounds may come in either order and be open (None);
    date bounds may be years, months or days and cover the last one whole."""

    values: dict[str, list] = field(default_factory=dict)
    prefixes: dict[str, str] = field(default_factory=dict)
    amounts: dict[str, tuple] = field(default_factory=dict)
    dates: dict[str, tuple] = field(default_factory=dict)

    def condition(self) -> Column:
        out = [F.col(c).isin(v) for c, v in self.values.items() if v]
        out += [F.col(c).startswith(p) for c, p in self.prefixes.items() if p]
        for c, (a, b) in self.amounts.items():
            a, b = (b, a) if a is not None and b is not None and a > b else (a, b)
            out += [F.col(c) >= a] if a is not None else []
            out += [F.col(c) <= b] if b is not None else []
        for c, (a, b) in self.dates.items():
            a, b = (b, a) if a and b and a > b else (a, b)
            out += [F.col(c) >= first_day(a)] if a else []
            out += [F.col(c) < after_last_day(b)] if b else []
        return all_true(out)


def first_day(text: str) -> Column:
    return F.lit(f"{text}-01-01"[:10] if len(text) == 4 else f"{text}-01"[:10] if len(text) == 7 else text).cast("timestamp")


def after_last_day(text: str) -> Column:
    step = {4: "1 year", 7: "1 month"}.get(len(text), "1 day")
    return first_day(text) + F.expr(f"interval {step}")


def keyset_page(df: DataFrame, key: str, after: object, size: int) -> DataFrame:
    """The next distinct keys beyond a cursor."""
    return df.where(F.col(key) > F.lit(after)).select(key).distinct().orderBy(key).limit(size)


def page(df: DataFrame, order: list[Column], page: int, size: int, most: int = 200) -> DataFrame:
    """A page of an ordered table; sizes are held between 1 and most, and pages before the first are the first."""
    size = min(max(size, 1), most)
    return df.orderBy(*order).offset((max(page, 1) - 1) * size).limit(size)


def facets(df: DataFrame, column: str, search: str, k: int) -> DataFrame:
    """The k commonest values that contain the search text, those that begin with it first."""
    counted = df.where(F.contains(F.lower(column), F.lit(search.lower()))).groupBy(F.col(column).alias("facet")).agg(F.count("*").alias("n"))
    return counted.orderBy(F.lower("facet").startswith(search.lower()).desc(), F.col("n").desc(), "facet").limit(k)


def key_boundaries(df: DataFrame, key: str, every: int) -> DataFrame:
    """Every n-th key in order. Keys are dealt into ranges, numbered within each and moved up by the ranges before."""
    ranged = df.select(key).repartitionByRange(df.sparkSession.sparkContext.defaultParallelism, key).sortWithinPartitions(key).withColumn("__part", F.spark_partition_id())
    sizes = ranged.groupBy("__part").agg(F.count("*").alias("__n"))
    before = sizes.select("__part", F.coalesce(F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__before"))
    numbered = ranged.withColumn("__rank", F.row_number().over(Window.partitionBy("__part").orderBy(key))).join(before, "__part")
    return numbered.where((F.col("__rank") + F.col("__before")) % every == 0).select(F.col(key).alias("boundary"))
