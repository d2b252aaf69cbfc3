"""MinHash near-duplicate groups through a multi-index Hamming join.

A document's set has its distinct word shingles. Its signature has POSITIONS symbols of 16 bits, each the low bits of
the least value of the set under one hash function. Signatures are cut into CHUNKS chunks of WIDTH symbols. Two
signatures that differ in at most MOST symbols have, by the pigeonhole principle, a chunk with at most one difference
(MOST < 2 * CHUNKS); so each chunk is indexed once for each symbol that may differ, with that symbol left out, and
every pair within the signature distance shares an index key. At the similarity of 0.8 a pair's distance exceeds MOST
with a chance of 1 in 10,000; above it the chance falls fast. Candidates within the distance are compared by the SKETCH
least hashes of their sets, which are whole sets for shorter texts, and must come within DEVIATIONS standard deviations of
the similarity asked for (five lose one pair in three million just at it); what is left is confirmed on the full sets.

No group is expanded into its pairs. Equal sets become one class first. Within a key each class is tested against the
key's smallest class only, and what is linked becomes one component. A second pass looks only at keys that still hold
several components and compares, in blocks of bounded size, classes of different components; a pair that shares several
keys is looked at under the first of them only, pairs beyond the signature distance are left there, and the rest is
confirmed, so that no link between components is lost."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .storage import materialize
from .text_arrays import U64, Words, mix, shingle_sets, slices, string_buffers

POSITIONS, WIDTH = 32, 4
CHUNKS = POSITIONS // WIDTH
MOST = 2 * CHUNKS - 1
SKETCH, DEVIATIONS = 256, 5
#: Rows in a block of a comparison, and members in a group of a confirmation.
BLOCK, GROUP = 1024, 256
#: Rows (of three numbers) up to which the candidates' ids are broadcast to where the texts are; beyond, both sides are shuffled.
MOST_BROADCAST = 500_000

_generator = np.random.default_rng(20240229)
_FACTORS = _generator.integers(1, 1 << 63, POSITIONS, dtype=U64) * U64(2) + U64(1)
_TERMS = _generator.integers(0, 1 << 63, POSITIONS, dtype=U64)
_NONE = np.uint32(0xFFFFFFFF)


def signature(shingles: np.ndarray) -> np.ndarray:
    """The 16-bit symbols of a non-empty set."""
    least = np.empty(POSITIONS, U64)
    for k in range(0, POSITIONS, 8):
        least[k : k + 8] = (shingles[None, :] * _FACTORS[k : k + 8, None] + _TERMS[k : k + 8, None]).min(axis=1)
    return (mix(least) & U64(0xFFFF)).astype(np.uint16)


def sketch(shingles: np.ndarray) -> np.ndarray:
    """The high halves of the SKETCH least hashes of a sorted set."""
    return np.minimum((shingles[:SKETCH] >> U64(32)).astype(np.uint32), _NONE - np.uint32(1))


def sketch_rows(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Sketches as the rows of a matrix, filled up with _NONE."""
    out = np.full((len(column), SKETCH), _NONE)
    for row, value in zip(out, column.to_pylist(), strict=True):
        found = np.frombuffer(value, np.uint32)
        row[: len(found)] = found
    return out


def alike(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """Whether a sketch allows the similarity with each row of a matrix of sketches. Both are complete below the lesser of
    their last hashes; if neither is cut, one hash of difference is allowed for, else DEVIATIONS standard deviations."""
    whole = a[-1] == _NONE, b[:, -1] == _NONE
    upto = np.minimum(_NONE - np.uint32(1) if whole[0] else a[-1], np.where(whole[1], _NONE - np.uint32(1), b[:, -1]))
    inside = b <= upto[:, None]
    at = np.minimum(np.searchsorted(a, b), SKETCH - 1)
    common = ((a[at] == b) & inside).sum(axis=1)
    union = np.searchsorted(a, upto, "right") + inside.sum(axis=1) - common
    share = percent / 100
    slack = np.where(whole[0] & whole[1], 1.0, DEVIATIONS * np.sqrt(share * (1 - share) * union))
    return common >= share * union - slack


def index_keys(symbols: np.ndarray) -> np.ndarray:
    """The CHUNKS * WIDTH keys of a signature: each chunk with one of its symbols left out."""
    parts = symbols.reshape(CHUNKS, WIDTH).astype(U64)
    keys = np.empty((CHUNKS, WIDTH), U64)
    for out in range(WIDTH):
        key = np.arange(CHUNKS, dtype=U64) * U64(WIDTH) + U64(out)
        for k in range(WIDTH):
            if k != out:
                key = (key << U64(16)) | parts[:, k]
        keys[:, out] = key
    return keys.ravel().view(np.int64)


def signed(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """doc_id, n_shingles, set_key (128 bits of the whole set), sig, sketch; one row per row of docs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "text"):
                words = Words(*string_buffers(piece.column("text")), lower=True)
                sizes, keys, sigs, sketches = [], [], [], []
                for found in shingle_sets(words, piece.num_rows, shingle):
                    sizes.append(len(found))
                    if len(found):
                        both = np.array([np.bitwise_xor.reduce(mix(found + U64(1))), np.add.reduce(mix(found ^ U64(0x5851F42D4C957F2D)))], U64)
                        keys.append(both.tobytes())
                        sigs.append(signature(found).tobytes())
                        sketches.append(sketch(found).tobytes())
                    else:
                        keys.append(None)
                        sigs.append(None)
                        sketches.append(None)
                yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(sigs, pa.binary()), pa.array(sketches, pa.binary())], ["doc_id", "n_shingles", "set_key", "sig", "sketch"])

    chosen = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return chosen.mapInArrow(run, "doc_id bigint, n_shingles bigint, set_key binary, sig binary, sketch binary")


def _members(classes: DataFrame) -> DataFrame:
    """key, id: the index entries of every class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                piece = batch.slice(at, 4096)
                symbols = [np.frombuffer(x, np.uint16) for x in piece.column("sig").to_pylist()]
                keys = np.concatenate([index_keys(x) for x in symbols])
                take = pa.array(np.repeat(np.arange(piece.num_rows), POSITIONS))
                yield pa.RecordBatch.from_arrays([pa.array(keys), piece.column("id").take(take)], ["key", "id"])

    return classes.select("id", "sig").mapInArrow(run, "key bigint, id bigint")


def _rows(column: pa.ChunkedArray | pa.Array, kind: type) -> np.ndarray:
    """Binary values of one length as the rows of a matrix."""
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), -1)


def _within(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Those of pairs (a, b) whose signatures and sketches allow the similarity."""
    sides = [classes.select(F.col("id").alias(x), F.col("sig").alias(f"sig_{x}"), F.col("sketch").alias(f"sketch_{x}")) for x in ("a", "b")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                near = (_rows(part.column("sig_a"), np.uint16) != _rows(part.column("sig_b"), np.uint16)).sum(axis=1) <= MOST
                left, right = sketch_rows(part.column("sketch_a")), sketch_rows(part.column("sketch_b"))
                for k in np.flatnonzero(near):
                    near[k] = alike(left[k], right[k : k + 1], percent)[0]
                yield part.select(["a", "b"]).filter(pa.array(near))

    return pairs.join(sides[0], "a").join(sides[1], "b").mapInArrow(run, "a bigint, b bigint")


def _confirmed(pairs: DataFrame, docs: DataFrame, id_col: str, text_col: str, shingle: int, percent: int) -> DataFrame:
    """Those of pairs (a, b) whose full sets have 100 * intersection >= percent * union. Pairs are dealt by a, in
    groups of about GROUP members; each group holds a's text once."""
    sizes = pairs.groupBy("a").agg(F.ceil(F.count("*") / GROUP).alias("parts"))
    dealt = materialize(pairs.join(sizes, "a").select("a", "b", "parts", F.pmod(F.xxhash64("b"), "parts").alias("part")), pairs.count())
    wanted = dealt.select(F.col("b").alias("id"), "a", "part").unionByName(dealt.select("a", "parts").distinct().select(F.col("a").alias("id"), "a", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)).alias("part")))
    texts = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    needed = texts.join(F.broadcast(wanted) if wanted.count() <= MOST_BROADCAST else wanted, "id")

    def run(key: tuple, table: pa.Table) -> pa.Table:
        leader = key[0].as_py()
        kept = []
        batch = pa.RecordBatch.from_arrays([c.combine_chunks() if c.num_chunks != 1 else c.chunk(0) for c in table.select(["id", "text"]).columns], ["id", "text"])
        ids = batch.column("id").to_numpy()
        at = int(np.flatnonzero(ids == leader)[0])
        head = batch.slice(at, 1)
        base = next(shingle_sets(Words(*string_buffers(head.column("text")), lower=True), 1, shingle))
        for piece in slices(batch, "text"):
            words = Words(*string_buffers(piece.column("text")), lower=True)
            for other, found in zip(piece.column("id").to_pylist(), shingle_sets(words, piece.num_rows, shingle), strict=True):
                if other == leader:
                    continue
                if 100 * min(len(base), len(found)) < percent * max(len(base), len(found)):
                    continue
                common = len(np.intersect1d(base, found, assume_unique=True))
                if 100 * common >= percent * (len(base) + len(found) - common):
                    kept.append(other)
        return pa.table({"a": pa.array([leader] * len(kept), pa.int64()), "b": pa.array(kept, pa.int64())})

    return needed.groupBy("a", "part").applyInArrow(run, "a bigint, b bigint")


def first_shared_key(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The number of the first index key that a signature shares with each row of a matrix of signatures; -1 if none."""
    differ = (b != a).reshape(len(b), CHUNKS, WIDTH)
    errors = differ.sum(axis=2)
    shared = errors <= 1
    chunk = shared.argmax(axis=1)
    rows = np.arange(len(b))
    out = np.where(errors[rows, chunk] == 1, differ[rows, chunk].argmax(axis=1), 0)
    return np.where(shared.any(axis=1), chunk * WIDTH + out, -1)


def _across(shared: DataFrame, classes: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """Pairs of classes of different components that share a key and whose signatures and sketches allow the similarity.
    shared: the members of keys with several."""
    labelled = shared.join(labels, "id", "left").select("key", "id", F.coalesce("label", "id").alias("label"))
    open_keys = labelled.groupBy("key").agg(F.count("*").alias("n"), F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi and n > 2").select("key", F.ceil(F.col("n") / BLOCK).alias("parts"))
    rows = labelled.join(open_keys, "key").join(classes, "id").withColumn("part", F.pmod(F.xxhash64("id"), "parts"))
    other = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)).alias("other")
    rows = rows.select("key", "id", "sig", "sketch", "label", "part", other).select("key", "id", "sig", "sketch", "label", "part", F.least("part", "other").alias("x"), F.greatest("part", "other").alias("y"))

    def run(key: tuple, table: pa.Table) -> pa.Table:
        number, x, y = key[0].as_py() >> 48, key[1].as_py(), key[2].as_py()
        ids, labels_, parts = (table.column(c).to_numpy() for c in ("id", "label", "part"))
        sigs, sketches = _rows(table.column("sig"), np.uint16), sketch_rows(table.column("sketch"))
        left, right = np.flatnonzero(parts == x), np.flatnonzero(parts == y)
        out_a, out_b = [], []
        for i in left:
            near = right[(labels_[right] != labels_[i]) & (ids[right] > ids[i] if x == y else True)]
            near = near[(sigs[near] != sigs[i]).sum(axis=1) <= MOST]
            near = near[first_shared_key(sigs[i], sigs[near]) == number] if len(near) else near
            near = near[alike(sketches[i], sketches[near], percent)] if len(near) else near
            if len(near):
                out_a.append(np.minimum(ids[i], ids[near]))
                out_b.append(np.maximum(ids[i], ids[near]))
        none = np.empty(0, np.int64)
        return pa.table({"a": np.concatenate([none, *out_a]), "b": np.concatenate([none, *out_b])})

    return rows.groupBy("key", "x", "y").applyInArrow(run, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: the component of every document under the relation
    100 * intersection >= percent * union of word-shingle sets; component_id is the smallest doc_id reachable.

    Null, empty or wordless texts have an empty set and are linked with nothing: their component is their own id. A
    null id gives a null component and is not kept. Repeated rows with one id count as one document's copies: each row
    returns. An empty table gives an empty result; other columns of docs are ignored. percent must be at least 80,
    since the signature distance is set for it."""
    if percent < 80:
        raise ValueError("the signature distance is set for 80 per cent and above")
    table = materialize(signed(docs, id_col, text_col, shingle))
    n = table.count()
    usable = table.where("doc_id is not null and n_shingles > 0")
    groups = usable.groupBy("set_key").agg(F.min("doc_id").alias("id"), F.min(F.struct("sig", "sketch")).alias("s")).select("set_key", "id", "s.*")
    # one id may stand for several sets where ids repeat: one of its sets is enough, as equal ids are one component
    classes = materialize(groups.groupBy("id").agg(F.min(F.struct("set_key", "sig", "sketch")).alias("one")).select("id", "one.sig", "one.sketch"), n, 20_000)
    members = materialize(_members(classes))
    several = members.groupBy("key").agg(F.min("id").alias("a"), F.count("*").alias("n")).where("n > 1").select("key", "a")
    shared = materialize(members.join(several, "key"), n * POSITIONS, 1_000_000)
    star = materialize(_within(shared.where("id <> a").select("a", F.col("id").alias("b")).distinct(), classes, percent), n, 5_000)
    links = materialize(_confirmed(star, docs, id_col, text_col, shingle, percent), n, 5_000)
    labels = components(links)
    more = materialize(_across(shared.select("key", "id"), classes, labels, percent).join(star, ["a", "b"], "left_anti"), n, 5_000)
    if not more.isEmpty():
        links = materialize(links.unionByName(_confirmed(more, docs, id_col, text_col, shingle, percent)), n, 5_000)
        labels = components(links)
    reps = groups.select("set_key", "id").join(labels, "id", "left").select("set_key", F.coalesce("label", "id").alias("component"))
    out = table.join(reps, "set_key", "left").select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))
