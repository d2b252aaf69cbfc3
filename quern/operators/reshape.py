"""Wide to long and back, and JSON to rows."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def candidates(df: DataFrame, keys: list[str], options: list[tuple[str, Column]]) -> DataFrame:
    """One row per option that has a value: keys, kind, value, position."""
    rows = F.posexplode(F.array(*[F.struct(F.lit(kind).alias("kind"), value.cast("string").alias("value")) for kind, value in options])).alias("position", "option")
    return df.select(*keys, rows).where("option.value is not null").select(*keys, "option.kind", "option.value", F.col("position").cast("bigint").alias("position"))


def long_to_wide(df: DataFrame, keys: list[str], name: str, value: str, names: list[str]) -> DataFrame:
    """One column per name with the greatest value; names are given, so no pass over the data finds them."""
    return df.groupBy(*keys).pivot(name, names).agg(F.max(value))


def scalars(document: str) -> list[tuple[str, str, str]]:
    """(RFC 6901 path, type, value) of every scalar in a JSON text, in document order; none for broken JSON."""
    try:
        todo = [("", json.loads(document))]
    except (TypeError, ValueError):
        return []
    out = []
    while todo:
        path, node = todo.pop()
        if isinstance(node, dict):
            todo += [(f"{path}/{str(k).replace('~', '~0').replace('/', '~1')}", v) for k, v in reversed(node.items())]
        elif isinstance(node, list):
            todo += [(f"{path}/{k}", v) for k, v in reversed(list(enumerate(node)))]
        else:
            kind = "null" if node is None else "boolean" if isinstance(node, bool) else "number" if isinstance(node, int | float) else "string"
            out.append((path, kind, node if isinstance(node, str) else json.dumps(node)))
    return out


def json_scalars(df: DataFrame, key: str, document: str) -> DataFrame:
    """key, path, type, value for every scalar of a JSON column."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(k, *s) for k, d in zip(pdf[key], pdf[document], strict=True) for s in scalars(d)]
            yield pd.DataFrame(rows, columns=[key, "path", "type", "value"])

    return df.select(key, document).mapInPandas(run, f"`{key}` {df.schema[key].dataType.simpleString()}, path string, type string, value string")


def sum_maps(df: DataFrame, keys: list[str], column: str) -> DataFrame:
    """The sum of map columns by key of the map: one map per group."""
    long = df.select(*keys, F.explode(column).alias("k", "v")).groupBy(*keys, "k").agg(F.sum("v").alias("v"))
    return long.groupBy(*keys).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("k", "v")))).alias(column))
