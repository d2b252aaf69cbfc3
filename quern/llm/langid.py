"""Multilingual mixture inference.

Each language has a smoothed distribution over hashed byte 4-grams of lower-cased letters. A document's grams are taken
to come from a mixture of languages, whose proportions expectation-maximisation estimates. The language set grows from
the best single language by the language with the steepest gain, as long as the likelihood rises by more than the
penalty; overlapping grams are counted as a quarter each."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text_arrays import pieces, slices, string_buffers

BUCKETS = 1 << 16
SMOOTHING = 0.5
OVERLAP = 4
ROUNDS = 12
#: Gain in log-likelihood that one more language must bring, times the log of the number of grams.
PENALTY = 2.0

_LETTER = np.full(256, 32, np.uint8)
_LETTER[97:123] = np.arange(97, 123)
_LETTER[128:] = np.arange(128, 256)


def grams(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Row and bucket of every 4-gram with a letter at both ends or beside one space; rows ascend."""
    data, offsets = string_buffers(pc.utf8_lower(column))
    if len(data) < 4:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    data = _LETTER[data]
    n = len(data) - 3
    space = data == 32
    spaces = space[:n].astype(np.int8) + space[1 : n + 1] + space[2 : n + 2] + space[3:]
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    usable = np.flatnonzero((spaces < 2) & (row[:n] == row[3:]))
    wide = data.astype(np.uint32)
    code = wide[usable] | wide[usable + 1] << 8 | wide[usable + 2] << 16 | wide[usable + 3] << 24
    return row[usable], ((code * np.uint32(2654435761)) >> np.uint32(16)).astype(np.int64)


class Model:
    """Probabilities of BUCKETS grams in each language, and their logarithms."""

    def __init__(self, languages: list[str], counts: np.ndarray):
        self.languages = languages
        total = counts.sum(axis=0) + SMOOTHING * BUCKETS
        self.chance = ((counts + SMOOTHING) / total).astype(np.float32)
        self.log = np.log(self.chance)

    def infer(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per row: proportions of the languages, those outside the chosen set being 0; grams; posterior of the best single
        language against the next. Grams are held in 32 bits, sums over a row's grams in 64."""
        rows, k = len(column), len(self.languages)
        row, bucket = grams(column)
        share = np.full((rows, k), 1.0 / k)
        sure = np.full(rows, 1.0 / k)
        codes, times = np.unique(row * BUCKETS + bucket, return_counts=True)
        row, bucket, weight = (codes // BUCKETS).astype(np.int32), codes % BUCKETS, times.astype(np.float32) / np.float32(OVERLAP)
        size = np.bincount(row, weight, rows)
        some = np.flatnonzero(size > 0)
        if not len(some):
            return share, size, sure
        add = lambda values, starts: np.add.reduceat(values, starts, axis=0, dtype=np.float64)
        single = add(weight[:, None] * self.log[bucket], np.searchsorted(row, some))
        best = single.argmax(axis=1)
        level = single[np.arange(len(some)), best]
        if k > 1:
            ordered = np.sort(single, axis=1)
            sure[some] = 1 / (1 + np.exp(-np.minimum(ordered[:, -1] - ordered[:, -2], 50)))
        else:
            sure[some] = 1.0
        pi = np.zeros((len(some), k))
        pi[np.arange(len(some)), best] = 1.0
        chosen = pi > 0
        penalty = PENALTY * np.log(size[some] + 2)
        place = np.full(rows, -1, np.int32)
        place[some] = np.arange(len(some))
        active, index, chance = np.arange(len(some)), place[row], self.chance[bucket]
        for _ in range(k - 1):  # index: which of active each gram belongs to
            now = np.arange(len(active))
            starts = np.searchsorted(index, now)
            mixed = np.einsum("ij,ij->i", pi[active].astype(np.float32)[index], chance)
            slope = add(chance * (weight / mixed)[:, None], starts)
            slope[chosen[active]] = -np.inf
            new = slope.argmax(axis=1)
            amount = add(weight, starts)
            steep = slope[now, new] > amount * 1.0001
            live = steep[index]
            if not live.any():
                break
            to = np.cumsum(steep) - 1  # only what can gain goes on
            active, new, amount = active[steep], new[steep], amount[steep]
            index, chance, weight = to[index[live]].astype(np.int32), chance[live], weight[live]
            now = np.arange(len(active))
            starts = np.searchsorted(index, now)
            members = chosen[active].copy()
            members[now, new] = True
            trial = np.where(members, 0.8 * pi[active], 0.0)
            trial[now, new] = 0.2
            trial /= trial.sum(axis=1, keepdims=True)
            for _ in range(ROUNDS):
                part = trial.astype(np.float32)[index]
                part *= chance
                part *= (weight / part.sum(axis=1))[:, None]
                trial = add(part, starts) / amount[:, None]
            reached = add(weight * np.log(np.einsum("ij,ij->i", trial.astype(np.float32)[index], chance)), starts)
            better = reached - level[active] > penalty[active]
            if not better.any():
                break
            won = active[better]
            pi[won], level[won], chosen[won] = trial[better], reached[better], members[better]
            live, to = better[index], np.cumsum(better) - 1
            active, index, chance, weight = won, to[index[live]].astype(np.int32), chance[live], weight[live]
        share[some] = pi
        return share, size, sure


def sampled(train: DataFrame, lang_col: str, key: str, per_language: int) -> DataFrame:
    """About per_language rows of each language, chosen by the hash of a key; all rows of smaller languages."""
    sizes = train.groupBy(lang_col).agg(F.count("*").alias("n")).collect()  # a row for each language
    share = F.lit(1.0)
    for r in sizes:
        share = F.when(F.col(lang_col) == r[lang_col], F.lit(min(1.0, per_language / r["n"]))).otherwise(share)
    return train.where(F.pmod(F.xxhash64(F.col(key), F.lit("language sample")), F.lit(1 << 20)) < share * (1 << 20))


def fit(train: DataFrame, *, text_col: str = "text", lang_col: str = "lang") -> Model:
    """Counts grams by language on the executors; at most BUCKETS rows for each language reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "text"):
                names, which = np.unique(np.array(piece.column("lang").to_pylist()), return_inverse=True)
                row, bucket = grams(piece.column("text"))
                codes, times = np.unique(which[row] * BUCKETS + bucket, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(names[codes // BUCKETS].tolist(), pa.string()), pa.array(codes % BUCKETS, pa.int64()), pa.array(times, pa.int64())], ["lang", "bucket", "n"])

    chosen = train.select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).where("text is not null and lang is not null")
    table = chosen.mapInArrow(run, "lang string, bucket bigint, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    names = sorted(set(table.column("lang").to_pylist()))
    counts = np.zeros((BUCKETS, len(names)))
    if names:
        counts[table.column("bucket").to_numpy(), np.searchsorted(names, table.column("lang").to_pylist())] = table.column("n").to_numpy()
    return Model(names, counts)


def predict(docs: DataFrame, model: Model, *, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """id, keep, lang_pred, score and languages (name to proportion, for the chosen set); one row per row of docs.

    lang_pred is the language with the greatest proportion, the first by name among equals; `und`, with score 0 and no
    languages, if the text is null or has no letter, or if no language was learned. score is that proportion times the
    posterior of the best single language against the next. Repeated rows return each. An empty table gives an empty
    result. Other columns are ignored."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = pa.struct([("lang_pred", pa.string()), ("score", pa.float64()), ("languages", pa.map_(pa.string(), pa.float64()))])

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = shared.value
        for batch in batches:
            for piece in pieces(batch):
                texts = piece.to_pylist()
                lettered = np.array([bool(t) and any(map(str.isalpha, t)) for t in texts]) & bool(own.languages)
                if own.languages:
                    share, _, sure = own.infer(piece)
                    main = share.argmax(axis=1)
                    score = np.where(lettered, np.clip(share[np.arange(len(texts)), main] * sure, 0, 1), 0.0)
                else:
                    share, main, score = np.zeros((len(texts), 0)), np.zeros(len(texts), int), np.zeros(len(texts))
                names = [own.languages[m] if ok else "und" for m, ok in zip(main, lettered, strict=True)]
                maps = [[(own.languages[j], float(p[j])) for j in np.flatnonzero(p > 0)] if ok else [] for p, ok in zip(share, lettered, strict=True)]
                yield pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(score, pa.float64()), pa.array(maps, kind[2].type)], fields=list(kind))

    found = F.arrow_udf(run, "struct<lang_pred: string, score: double, languages: map<string, double>>").asNondeterministic()
    rows = docs.select(*keep, F.col(id_col).alias("__id"), found(text_col).alias("__found"))
    return rows.select(*keep, F.col("__id").alias(id_col), "__found.*")
