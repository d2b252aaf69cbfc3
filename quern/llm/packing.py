"""Best-fit packing of tokenized documents by minimum bin slack.

Pieces differ, for packing, only in length, of which there are at most `capacity`. The plan is made from the counts of
each length: the longest length left opens a bin, and a subset-sum over the available lengths, kept as the bits of an
integer, finds the fullest feasible combination for the rest; it is removed as many times as the counts allow. The plan
has a few thousand patterns whatever the number of documents. Pieces then find their bin and offset by their rank among
the pieces of their length."""

from __future__ import annotations

import json
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .sharding import numbered
from .storage import materialize

_encoders: dict[str, object] = {}


def encoder(path: str):
    """tiktoken over the byte-level BPE vocabulary of a tokenizers JSON file. The ids are those of the tokenizers
    library with add_special_tokens=False, at about five times its speed. Added tokens in a text get their own ids, as the
    library gives by default, when asked for by allowed_special="all"."""
    if path not in _encoders:
        import tiktoken

        visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in visible]
        byte_of = {chr(b): b for b in visible} | {chr(256 + k): b for k, b in enumerate(hidden)}
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        before = spec.get("pre_tokenizer") or {}
        if spec["model"]["type"] != "BPE" or before.get("type") != "ByteLevel" or before.get("add_prefix_space") or before.get("use_regex") is False or spec.get("normalizer"):
            raise ValueError("the tokenizer must be a byte-level BPE with the usual splits and no normalizer")
        special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        ranks = {bytes(byte_of[c] for c in token): rank for token, rank in spec["model"]["vocab"].items() if token not in special}
        pattern = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
        _encoders[path] = tiktoken.Encoding("quern", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special)
    return _encoders[path]


def cut(length: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: full ones, the first being shorter where the length asks for it."""
    first = length % capacity
    starts = ([0] if first else []) + list(range(first, length, capacity))
    return [(s, min(capacity, (first if s == 0 and first else capacity))) for s in starts]


def pieces(docs: DataFrame, *, tokenizer: str, capacity: int, end_id: int, id_col: str, text_col: str, ids: bool) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 and, if asked for, ids; a null text has the end id alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer).encode_to_numpy
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                out: list[list] = [[] for _ in range(6)]
                for doc, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist(), strict=True):
                    found = np.append(encode(text or "", allowed_special="all").astype("<u4"), np.array([end_id], "<u4"))
                    for k, (start, length) in enumerate(cut(len(found), capacity)):
                        own = found[start : start + length]
                        for column, value in zip(out, (doc, k, start, length, zlib.crc32(own.tobytes()), own.astype(np.int32) if ids else None), strict=True):
                            column.append(value)
                arrays = [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int32()), pa.array(out[2], pa.int64()), pa.array(out[3], pa.int64()), pa.array(out[4], pa.int64())]
                arrays += [pa.array(out[5], pa.list_(pa.int32()))] if ids else []
                yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][: len(arrays)])

    schema = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint" + (", ids array<int>" if ids else "")
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, schema)


def fullest(counts: dict[int, int], room: int) -> Counter:
    """The lengths, long ones first among equals, whose sum comes closest to room from below."""
    reach, steps = 1, []
    mask = (1 << (room + 1)) - 1
    for length in sorted((x for x in counts if x <= room and counts[x] > 0), reverse=True):
        for _ in range(min(counts[length], room // length)):
            after = (reach | reach << length) & mask
            if after == reach:
                break
            steps.append((length, reach))
            reach = after
        if reach >> room & 1:
            break
    at, taken = reach.bit_length() - 1, Counter()
    for length, before in reversed(steps):
        if not before >> at & 1:
            taken[length] += 1
            at -= length
    return taken


def plan(counts: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """Patterns {length: copies} with the number of bins that follow each."""
    left = {n: c for n, c in counts.items() if c > 0}
    out = []
    while left:
        seed = max(left)
        rest = left | {seed: left[seed] - 1}
        pattern = fullest(rest, capacity - seed) + Counter({seed: 1})
        times = min(left[n] // k for n, k in pattern.items())
        out.append((dict(pattern), times))
        for n, k in pattern.items():
            left[n] -= k * times
            if not left[n]:
                del left[n]
    return out


def placements(patterns: list[tuple[dict[int, int], int]]) -> list[tuple[int, int, int, int, int, list[int]]]:
    """For each length of each pattern: length, first rank, rank after the last, first bin, copies a bin, their offsets."""
    rows, used, bins = [], Counter(), 0
    for pattern, times in patterns:
        offset = 0
        for length in sorted(pattern, reverse=True):
            copies = pattern[length]
            rows.append((length, used[length], used[length] + copies * times, bins, copies, [offset + k * length for k in range(copies)]))
            used[length] += copies * times
            offset += copies * length
        bins += times
    return rows


def pack(docs: DataFrame, *, tokenizer: str, capacity: int = 1024, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text", ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids): every piece of every row, placed.

    Only documents longer than capacity are cut. A null or empty text is the end id alone. Repeated rows, or rows with
    a null id, are packed each. An empty table gives an empty result; other columns are ignored. The counts that reach
    the driver have at most `capacity` rows."""
    spark = docs.sparkSession
    table = materialize(pieces(docs, tokenizer=tokenizer, capacity=capacity, end_id=end_id, id_col=id_col, text_col=text_col, ids=ids))
    counts = {r["length"]: r["n"] for r in table.groupBy("length").agg(F.count("*").alias("n")).collect()}
    places = placements(plan(counts, capacity))
    steps = spark.createDataFrame(places, "p_length bigint, first bigint, after bigint, bin bigint, copies bigint, offsets array<bigint>")
    by_length = F.broadcast(steps.groupBy("p_length").agg(F.sort_array(F.collect_list(F.struct("first", "after", "bin", "copies", "offsets"))).alias("steps")))
    ranked = numbered(table, "length", ["doc_id", "piece", "start"], F.xxhash64("doc_id", "piece"))
    placed = ranked.join(by_length, F.col("length") == F.col("p_length")).withColumn("step", F.expr("element_at(steps, cast(aggregate(steps, 0, (n, s) -> n + if(s.first <= slot, 1, 0)) as int))"))
    nth = F.col("slot") - F.col("step.first")
    out = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if ids else [])]
    return placed.select(*out, (F.col("step.bin") + F.floor(nth / F.col("step.copies"))).alias("sequence_id"), F.expr("step.offsets[cast(pmod(slot - step.first, step.copies) as int)]").alias("offset"))
