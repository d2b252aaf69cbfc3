"""Vector arithmetic on array columns, and search against small sets of reference vectors."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def normalised(v: Column) -> Column:
    """Divided by the Euclidean length; zeros where it is below 1e-9."""
    size = F.sqrt(dot(v, v))
    return F.transform(v, lambda x: F.when(size < 1e-9, F.lit(0.0)).otherwise(x.cast("double") / size))


def quantised(v: Column) -> Column:
    """int8 codes of a vector by its own scale, as struct scale and codes."""
    scale = F.greatest(F.array_max(F.transform(v, lambda x: F.abs(x.cast("double")))), F.lit(1e-12)) / 127
    return F.struct(scale.alias("scale"), F.transform(v, lambda x: F.round(x.cast("double") / scale).cast("tinyint")).alias("codes"))


def restored(q: Column) -> Column:
    return F.transform(q["codes"], lambda x: x.cast("double") * q["scale"])


def nearest(queries: DataFrame, rows: DataFrame, k: int, *, id_col: str, vector_col: str, block: int = 4096, asked_block: int = 2048) -> DataFrame:
    """Exact cosine neighbours: query_id, id, cosine, nth, the k best of all rows for each query, itself excluded.

    Rows are read in blocks, once for each block of about asked_block queries, which is sent to every task; each task
    keeps its k best for every query, and the tasks' best meet by query."""
    blocks = max(1, -(-queries.count() // asked_block))
    part = F.pmod(F.xxhash64(id_col), F.lit(blocks))
    found = [_found(queries.where(part == n) if blocks > 1 else queries, rows, k, id_col, vector_col, block) for n in range(blocks)]

    from ..operators.latest import first_per_key

    top = first_per_key(reduce(DataFrame.unionByName, found), ["query_id"], [F.col("cosine").desc(), F.col("id")], k)
    return top.groupBy("query_id").agg(F.array_sort(F.collect_list(F.struct((-F.col("cosine")).alias("c"), "id"))).alias("all")).select("query_id", F.posexplode("all").alias("nth", "x")).select("query_id", F.col("x.id").alias("id"), (-F.col("x.c")).alias("cosine"), (F.col("nth") + 1).cast("bigint").alias("nth"))


def _found(queries: DataFrame, rows: DataFrame, k: int, id_col: str, vector_col: str, block: int) -> DataFrame:
    """query_id, id, cosine: the k best of each block of rows for each query."""
    stated = queries.select(id_col, vector_col).toArrow()
    ids = stated.column(id_col).to_numpy()
    asked = _unit(stated.column(vector_col).combine_chunks())
    shared = rows.sparkSession.sparkContext.broadcast((ids, asked))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_ids, own = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, block):
                part = batch.slice(at, block)
                there = part.column(id_col).to_numpy()
                cosine = np.round(own @ _unit(part.column(vector_col)).T, 9)
                cosine[own_ids[:, None] == there[None, :]] = -np.inf
                best = np.lexsort((np.broadcast_to(there, cosine.shape), -cosine), axis=1)[:, :k]
                query = np.repeat(own_ids, best.shape[1])
                values = np.take_along_axis(cosine, best, axis=1).ravel()
                live = np.isfinite(values)
                yield pa.RecordBatch.from_arrays([pa.array(query[live]), pa.array(there[best.ravel()][live]), pa.array(values[live])], ["query_id", "id", "cosine"])

    return rows.select(id_col, vector_col).mapInArrow(run, "query_id bigint, id bigint, cosine double")


def _unit(vectors: pa.ListArray) -> np.ndarray:
    width = len(vectors[0]) if len(vectors) else 0
    m = np.asarray(vectors.flatten(), dtype=np.float64).reshape(len(vectors), width)
    size = np.sqrt((m * m).sum(axis=1, keepdims=True))
    return np.where(size < 1e-9, 0.0, m / np.maximum(size, 1e-9))


def classify(df: DataFrame, references: DataFrame, *, id_col: str, vector_col: str, code_col: str, reference_col: str, k: int = 3, spread_over: int = 10) -> DataFrame:
    """id, top (the k best of the references as score and code, ties by code), margin and confidence.

    The reference table must be small: it goes to every task as a matrix, and each batch of rows is multiplied by it.
    margin is the best score less the next. confidence tells how far the best stands above the rest: scores less their
    median over the median absolute deviation (1e-6 at least), then softmax over the spread_over best."""
    table = references.select(code_col, reference_col).orderBy(code_col).toArrow()
    codes = table.column(code_col).to_pylist()
    shared = df.sparkSession.sparkContext.broadcast(_unit(table.column(reference_col).combine_chunks()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        names = np.array(codes)
        kind = pa.list_(pa.struct([("score", pa.float64()), ("code", pa.int64() if names.dtype.kind == "i" else pa.string())]))
        for batch in batches:
            scores = np.round(_unit(batch.column(vector_col)) @ own.T, 9)
            order = np.argsort(-scores, axis=1, kind="stable")
            ranked = np.take_along_axis(scores, order, axis=1)
            margin = ranked[:, 0] - ranked[:, 1] if ranked.shape[1] > 1 else ranked[:, 0]
            middle = np.median(scores, axis=1, keepdims=True)
            spread = np.maximum(np.median(np.abs(scores - middle), axis=1, keepdims=True), 1e-6)
            z = (ranked[:, :spread_over] - middle) / spread
            sure = 1 / np.exp(z - z[:, :1]).sum(axis=1)
            top = [[{"score": float(x), "code": names[i].item()} for x, i in zip(r[:k], o[:k], strict=True)] for r, o in zip(ranked, order, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(id_col), pa.array(top, kind), pa.array(margin), pa.array(sure)], [id_col, "top", "margin", "confidence"])

    kinds = df.schema[id_col].dataType.simpleString(), "bigint" if references.schema[code_col].dataType.simpleString() in ("int", "bigint") else "string"
    return df.select(id_col, vector_col).mapInArrow(run, f"`{id_col}` {kinds[0]}, top array<struct<score:double,code:{kinds[1]}>>, margin double, confidence double")


def spread_statistics(df: DataFrame, vector: str, width: int) -> DataFrame:
    """n, mean pairwise cosine, participation ratio and entropy rank of the covariance spectrum.

    Moments are summed in one pass over the rows; only width squared sums reach the last step."""

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total, square = 0, np.zeros(width), np.zeros((width, width))
        for batch in batches:
            m = _unit(batch.column(0))
            if len(m):
                n, total, square = n + len(m), total + m.sum(axis=0), square + m.T @ m
        yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([total.tolist()]), pa.array([square.ravel().tolist()])], ["n", "total", "square"])

    def finish(key: tuple, table: pa.Table) -> pa.Table:
        n = sum(table.column("n").to_pylist())
        total = np.sum([x for x in table.column("total").to_pylist()], axis=0)
        square = np.sum([x for x in table.column("square").to_pylist()], axis=0).reshape(width, width)
        mean = total / max(n, 1)
        spectrum = np.clip(np.linalg.eigvalsh(square / max(n, 1) - np.outer(mean, mean)), 0, None)
        share = spectrum / spectrum.sum() if spectrum.sum() else spectrum
        live = share[share > 0]
        pairwise = (total @ total - np.trace(square)) / max(n * (n - 1), 1)
        return pa.table({"n": [n], "mean_cosine": [float(pairwise)], "participation": [float(1 / (share * share).sum()) if len(live) else 0.0], "entropy_rank": [float(np.exp(-(live * np.log(live)).sum())) if len(live) else 0.0]})

    parts = df.select(vector).mapInArrow(moments, "n bigint, total array<double>, square array<double>")
    return parts.groupBy(F.lit(1).alias("one")).applyInArrow(finish, "n bigint, mean_cosine double, participation double, entropy_rank double")
