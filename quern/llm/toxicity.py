"""Toxicity by the nearest labelled examples.

Features are words of letters, and those first 4, 5 and 6 bytes of words that the labelled examples tie to the label. A text
is the unit TF-IDF vector of its features, with document frequencies counted over the whole corpus, times a strength: 1
for features that are tied to the label beyond chance, less the weaker the tie, and BASE_STRENGTH for all others, so that every
text with a known word is searched. The index holds the examples' vectors by feature, in blocks of BLOCK examples with the
greatest weight of each feature in each block. A query bounds every block's cosine by those weights, evaluates the blocks
with the highest bounds, and then all that can still reach the neighbours found, which makes the search exact. Neighbours vote
with the weight of their cosine; votes are calibrated on the examples themselves. No example, in calibration or as a text of the
corpus, is its own neighbour."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .langid import _LETTER
from .storage import materialize
from .text_arrays import U64, Words, mix, slices, string_buffers

PREFIXES = (4, 5, 6)
BLOCK, FIRST_BLOCKS = 64, 8
NEIGHBOURS = 15
#: Labelled rows that ties are learned from at most, and those of each label that are indexed at most.
MAX_EXAMPLES, MAX_INDEXED = 16_384, 1024
#: Least lower bound of a tied feature's share of toxic examples, the chance that any feature is taken to be tied in full by
#: accident, and the strength of features without a tie.
LEAST_SHARE, CHANCE, BASE_STRENGTH = 0.5, 0.05, 0.01
#: Weight of the prior in a vote, as if that much cosine stood for examples without any feature.
PRIOR = 1.0


def features(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row and hash of every feature occurrence, and whether it is a whole word; rows do not descend within a kind."""
    data, offsets = string_buffers(pc.utf8_lower(column))
    words = Words(_LETTER[data], offsets, lower=False)
    out_row, out_hash = [words.row], [words.hash]
    size = words.end - words.start
    for k in PREFIXES:
        at = words.start[size >= k]
        code = np.zeros(len(at), U64)
        for j in range(k):
            code = code << U64(8) | words.data[at + j].astype(U64)
        out_row.append(words.row[size >= k])
        out_hash.append(mix(code * U64(16) + U64(k)))
    return np.concatenate(out_row), np.concatenate(out_hash), np.repeat([True, False], [len(words.row), sum(map(len, out_row[1:]))])


class Vocabulary:
    """Feature hashes in order, with a table over 20 bits to pass over most others quickly."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = np.unique(hashes)
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[(self.hashes & U64(0xFFFFF)).astype(np.int64)] = True

    def count(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """row, feature number and occurrences, in order of row and feature."""
        row, found, _ = features(column)
        likely = self.maybe[(found & U64(0xFFFFF)).astype(np.int64)]
        row, found = row[likely], found[likely]
        at = np.searchsorted(self.hashes, found)
        at[at == len(self.hashes)] = 0
        hit = self.hashes[at] == found if len(self.hashes) else np.zeros(len(found), bool)
        width = max(len(self.hashes), 1)
        codes, times = np.unique(row[hit] * width + at[hit], return_counts=True)
        return codes // width, codes % width, times


def unit_vector(features_: np.ndarray, times: np.ndarray, idf: np.ndarray) -> np.ndarray:
    weight = (1 + np.log(times)) * idf[features_]
    norm = np.sqrt((weight * weight).sum())
    return weight / norm if norm > 0 else weight


def ranges(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all ranges one after another, and the size of each."""
    size = end - start
    upto = np.cumsum(size, dtype=np.int32)
    return np.arange(upto[-1] if len(upto) else 0, dtype=np.int32) + np.repeat(start - (upto - size), size), size


class BlockMaxIndex:
    """Exact cosine search over sparse unit vectors. Postings are in order of feature and example; those of one feature in one
    block are an entry, which knows the greatest weight in it."""

    def __init__(self, vectors: list[tuple[np.ndarray, np.ndarray]], n_features: int):
        self.size = len(vectors)
        self.blocks = -(-self.size // BLOCK)
        feature = np.concatenate([np.empty(0, np.int64), *[f for f, _ in vectors]])
        owner = np.repeat(np.arange(self.size), [len(f) for f, _ in vectors])
        weight = np.concatenate([np.empty(0), *[w for _, w in vectors]])
        order = np.lexsort((owner, feature))
        feature, self.owner, self.weight = feature[order], owner[order].astype(np.int32), weight[order]
        block = self.owner // BLOCK
        first = np.flatnonzero(np.concatenate([[True], (feature[1:] != feature[:-1]) | (block[1:] != block[:-1])])[: len(feature)])
        self.entry = np.append(first, len(feature)).astype(np.int32)
        self.block = block[first]
        self.most = np.maximum.reduceat(self.weight, first) if len(first) else np.empty(0)
        self.of = np.searchsorted(feature[first], np.arange(n_features + 1)).astype(np.int32)

    def nearest(self, feature: np.ndarray, weight: np.ndarray, k: int, leave_out: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """The k examples with the greatest positive cosine, the lower number first among equals, and the cosines."""
        entries, size = ranges(self.of[feature], self.of[feature + 1])
        block, weight = self.block[entries], np.repeat(weight, size)
        bound = np.bincount(block, weight * self.most[entries], self.blocks)
        ids, cosines, least, done = np.empty(0, np.int64), np.empty(0), 0.0, np.zeros(self.blocks, bool)
        for most in (FIRST_BLOCKS, self.blocks):
            chosen = ~done & (bound > 0) & ((bound >= least - 1e-12) if len(ids) >= k else True)
            if chosen.sum() > most:
                chosen[np.argsort(-np.where(chosen, bound, -1.0), kind="stable")[most:]] = False
            if not chosen.any():
                break
            done |= chosen
            own = chosen[block]
            at, size = ranges(self.entry[entries[own]], self.entry[entries[own] + 1])
            score = np.bincount(self.owner[at], self.weight[at] * np.repeat(weight[own], size), self.size)
            some = np.flatnonzero(score > 0)
            some = some[some != leave_out]
            if len(some) > 4 * k:  # far fewer to order
                some = some[score[some] >= np.partition(score[some], -k)[-k] - 1e-9]
            ids, cosines = np.concatenate([ids, some]), np.concatenate([cosines, score[some]])
            order = np.lexsort((ids, -np.round(cosines, 12)))[:k]
            ids, cosines = ids[order], cosines[order]
            least = cosines[-1] if len(ids) else 0.0
        return ids, cosines


class Scorer:
    """The fitted operator: vocabulary, weights of features, index, labels and calibration."""

    def __init__(self, vocabulary: Vocabulary, idf: np.ndarray, vectors: list, labels: np.ndarray, ids: list, stands_for: np.ndarray, base: float, blank: tuple[float, float]):
        """stands_for: how many labelled rows each example stands for. base: the label's share among labelled rows. blank:
        rows without any feature, and how many of them have the label."""
        self.vocabulary, self.idf, self.labels, self.ids, self.stands_for, self.base = vocabulary, idf, labels, ids, stands_for, base
        self.place = {i: k for k, i in enumerate(ids)}
        self.blank = (blank[1] + base) / (blank[0] + 1.0)
        units = [(f, unit_vector(f, t, idf)) for f, t in vectors]
        self.index = BlockMaxIndex(units, len(idf))
        raw = np.array([self.vote(f, w, k)[0] for k, (f, w) in enumerate(units)]) if units else np.empty(0)
        self.steps = isotonic(raw, labels, stands_for) if len(raw) else (np.empty(0), np.empty(0))

    def vote(self, feature: np.ndarray, weight: np.ndarray, leave_out: int = -1) -> tuple[float, np.ndarray, np.ndarray]:
        near, cosine = self.index.nearest(feature, weight, NEIGHBOURS, leave_out)
        say = cosine * self.stands_for[near] / max(float(self.stands_for.mean()), 1e-9)
        return (float((say * self.labels[near]).sum()) + PRIOR * self.base) / (float(say.sum()) + PRIOR), near, cosine

    def score(self, feature: np.ndarray, times: np.ndarray, doc: int | None = None) -> tuple[float, list]:
        """The calibrated score, and the neighbours that it rests on as (example id, cosine, label)."""
        if not len(feature) or not len(self.steps[0]):
            return self.blank, []
        raw, near, cosine = self.vote(feature, unit_vector(feature, times, self.idf), self.place.get(doc, -1))
        if not len(near):
            return self.blank, []
        return float(np.interp(raw, *self.steps)), [(self.ids[k], float(c), int(self.labels[k])) for k, c in zip(near, cosine, strict=True)]


def isotonic(raw: np.ndarray, labels: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Pool-adjacent-violators fit of the label's chance to the vote, drawn a little towards the mean; points to interpolate."""
    weights = np.ones(len(raw)) if weights is None else weights
    order = np.argsort(raw, kind="stable")
    pools: list[list[float]] = []
    for x, y, w in zip(raw[order], labels[order], weights[order], strict=True):
        pools.append([float(x * w), float(y * w), float(w)])
        while len(pools) > 1 and (pools[-2][1] / pools[-2][2] >= pools[-1][1] / pools[-1][2] or pools[-2][0] / pools[-2][2] >= pools[-1][0] / pools[-1][2]):
            pools[-2:] = [[a + b for a, b in zip(pools[-2], pools[-1], strict=True)]]
    mean = (labels * weights).sum() / weights.sum()
    xs = np.array([p[0] / p[2] for p in pools])
    ys = np.array([(p[1] + mean) / (p[2] + 1) for p in pools])
    return xs, np.maximum.accumulate(ys)


def tied_features(examples: DataFrame, base: float) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the features that the examples tie to the label, and their strengths; examples has text and label and is
    bounded. A tie has a share of toxic examples whose lower bound is LEAST_SHARE; its strength is the fourth power of its surprise
    by the Chernoff bound against that which no feature tried would reach by accident, 1 at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "text"):
                row, found, _ = features(piece.column("text"))
                order = np.lexsort((row, found))
                row, found = row[order], found[order]
                first = np.ones(len(found), bool)
                first[1:] = (found[1:] != found[:-1]) | (row[1:] != row[:-1])
                row, found = row[first], found[first]
                label = piece.column("label").to_numpy(zero_copy_only=False)[row]
                names, at = np.unique(found, return_index=True)
                if len(names):
                    yield pa.RecordBatch.from_arrays([pa.array(names.view(np.int64)), pa.array(np.add.reduceat(label, at).astype(np.int64)), pa.array(np.diff(np.append(at, len(found))).astype(np.int64))], ["feature", "pos", "n"])

    table = materialize(examples.mapInArrow(run, "feature bigint, pos bigint, n bigint").groupBy("feature").agg(F.sum("pos").alias("pos"), F.sum("n").alias("n")))
    tried = max(table.count(), 1)
    share, z = F.col("pos") / F.col("n"), 1.64
    lower = (share + z * z / (2 * F.col("n")) - z * F.sqrt(share * (1 - share) / F.col("n") + z * z / (4 * F.col("n") * F.col("n")))) / (1 + z * z / F.col("n"))
    surprise = F.col("n") * (share * F.ln(share / base) + F.when(share < 1, (1 - share) * F.ln((1 - share) / (1 - base))).otherwise(0.0))
    strength = F.pow(F.least(F.lit(1.0), surprise / float(np.log(tried / CHANCE))), F.lit(4.0))
    found = table.where("pos > 0").where((lower >= LEAST_SHARE) & (share > base)).select("feature", strength.alias("strength")).toArrow()
    return found.column("feature").to_numpy().astype(np.int64).view(U64), found.column("strength").to_numpy().astype(float)


def words_of(examples: DataFrame) -> np.ndarray:
    """Hashes of all words of the examples, which are bounded."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "text"):
                _, found, whole = features(piece.column("text"))
                yield pa.RecordBatch.from_arrays([pa.array(np.unique(found[whole]).view(np.int64))], ["feature"])

    return examples.select("text").mapInArrow(run, "feature bigint").distinct().toArrow().column("feature").to_numpy().astype(np.int64).view(U64)


def score_texts(docs: DataFrame, labelled: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", max_examples: int = MAX_EXAMPLES, max_indexed: int = MAX_INDEXED) -> DataFrame:
    """doc_id, score, evidence (the neighbours: example id, cosine, label); one row per row of docs.

    labelled: id_col and label_col (0 or 1) of rows of docs that may be learned from. Ties are learned from its max_examples
    rows with the lowest id hashes; of these the max_indexed lowest of each label are the examples of the index, each standing
    for as many of its label as were left out. Null labels, and ids that docs lacks, are passed over; ids should be unique in
    labelled, and of repeated ones the greatest label counts. Null, empty and otherwise featureless texts get the share of
    the label among examples without features, drawn to its share among all. Without labelled rows every score is 0. An
    empty table gives an empty result; other columns are ignored."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    known = labelled.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("bigint").alias("doc_id")).agg(F.max(F.col(label_col).cast("int")).alias("label"))
    known = known.orderBy(F.xxhash64("doc_id", F.lit("examples")), "doc_id").limit(max_examples)
    examples = materialize(rows.join(F.broadcast(known), "doc_id").dropDuplicates(["doc_id"]))
    sizes = {r["label"]: r["n"] for r in examples.groupBy("label").agg(F.count("*").alias("n")).collect()}  # two rows
    base = (sizes.get(1, 0) + 0.5) / (sum(sizes.values()) + 1) if sizes else 0.0
    order = Window.partitionBy("label").orderBy(F.xxhash64("doc_id", F.lit("examples")), "doc_id")  # of max_examples rows
    chosen = examples.select("doc_id", "label").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= max_indexed)
    indexed = materialize(examples.join(F.broadcast(chosen.select("doc_id")), "doc_id"), max_examples, 512)
    tied, strengths = tied_features(examples, base) if sizes else (np.empty(0, U64), np.empty(0))
    own = Vocabulary(np.concatenate([words_of(indexed), tied]))
    strength = np.full(len(own.hashes), BASE_STRENGTH)
    strength[np.searchsorted(own.hashes, tied)] = np.maximum(strengths, BASE_STRENGTH)
    vocabulary = spark.sparkContext.broadcast(own)

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, n = np.zeros(len(vocabulary.value.hashes), np.int64), 0
        for batch in batches:
            n += batch.num_rows
            for piece in slices(batch, "text"):
                counts += np.bincount(vocabulary.value.count(piece.column("text"))[1], minlength=len(counts))
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(some, -1)), pa.array(np.append(counts[some], n))], ["feature", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "text"):
                row, feature, times = vocabulary.value.count(piece.column("text"))
                at = np.searchsorted(row, np.arange(piece.num_rows + 1)).astype(np.int32)
                lists = [pa.ListArray.from_arrays(pa.array(at), pa.array(x.astype(np.int32))) for x in (feature, times)]
                yield pa.RecordBatch.from_arrays([piece.column("doc_id"), piece.column("label"), *lists], ["doc_id", "label", "features", "times"])

    found = rows.select("text").mapInArrow(frequencies, "feature bigint, n bigint").groupBy("feature").agg(F.sum("n").alias("n")).toArrow()  # a row for each feature
    feature, times = found.column("feature").to_numpy().astype(np.int64), found.column("n").to_numpy().astype(np.int64)
    frequency = np.zeros(len(own.hashes), np.int64)
    frequency[feature[feature >= 0]] = times[feature >= 0]
    idf = (np.log((times[feature < 0].sum() + 1) / (frequency + 1)) + 1) * strength
    vectors = indexed.select("doc_id", "label", "text").mapInArrow(count, "doc_id bigint, label int, features array<int>, times array<int>").toArrow().to_pylist()  # two times max_indexed rows at most
    vectors.sort(key=lambda r: (r["label"], r["doc_id"]))
    has = {y: sum(r["label"] == y for r in vectors) for y in (0, 1)}
    stands = [sizes[r["label"]] / has[r["label"]] for r in vectors]
    full = [k for k, r in enumerate(vectors) if r["features"]]
    blank = [k for k, r in enumerate(vectors) if not r["features"]]
    scorer = Scorer(own, idf, [(np.array(vectors[k]["features"]), np.array(vectors[k]["times"])) for k in full], np.array([vectors[k]["label"] for k in full], float), [vectors[k]["doc_id"] for k in full], np.array([stands[k] for k in full], float), base, (sum(stands[k] for k in blank), sum(stands[k] * vectors[k]["label"] for k in blank)))
    shared = spark.sparkContext.broadcast(scorer)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        kind = pa.list_(pa.struct([("example", pa.int64()), ("cosine", pa.float64()), ("label", pa.int32())]))
        for batch in batches:
            for piece in slices(batch, "text"):
                row, feature, times = own.vocabulary.count(piece.column("text"))
                at = np.searchsorted(row, np.arange(piece.num_rows + 1))
                found = [own.score(feature[at[k] : at[k + 1]], times[at[k] : at[k + 1]], doc) for k, doc in enumerate(piece.column("doc_id").to_pylist())]
                evidence = pa.array([[{"example": a, "cosine": c, "label": y} for a, c, y in e] for _, e in found], kind)
                yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array([s for s, _ in found], pa.float64()), evidence], ["doc_id", "score", "evidence"])

    return rows.mapInArrow(score, "doc_id bigint, score double, evidence array<struct<example:bigint,cosine:double,label:int>>")
