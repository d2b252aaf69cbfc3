import hashlib
import math
import random
import re
import unicodedata
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from quern.llm import fingerprint, mixing, sharding, toxicity
from quern.llm.toxicity import BlockMaxIndex


def test_block_max_search_is_exact():
    rng = np.random.default_rng(3)
    width, rows = 40, []
    for _ in range(700):
        f = np.sort(rng.choice(width, rng.integers(1, 8), replace=False))
        w = rng.random(len(f))
        rows.append((f, w / np.sqrt((w * w).sum())))
    dense = np.zeros((len(rows), width))
    for k, (f, w) in enumerate(rows):
        dense[k, f] = w
    index = BlockMaxIndex(rows, width)
    for k, (f, w) in enumerate(rows[:200]):
        cosine = dense @ dense[k]
        order = np.lexsort((np.arange(len(rows)), -np.round(cosine, 12)))
        expected = [i for i in order if cosine[i] > 0 and i != k][:15]
        ids, values = index.nearest(f, w, 15, k)
        assert ids.tolist() == expected
        assert np.allclose(values, cosine[expected])


def test_isotonic_rises():
    raw, labels = np.array([0.1, 0.2, 0.3, 0.4, 0.9, 0.95, 0.95, 0.95]), np.array([0, 1, 0, 0, 1, 0, 1, 1])
    xs, ys = toxicity.isotonic(raw, labels.astype(float))
    assert (np.diff(xs) > 0).all() and (np.diff(ys) >= 0).all() and (0 <= ys).all() and (ys <= 1).all()


@pytest.fixture
def labelled(prose):
    rng = random.Random(2)
    bad = ["grumble", "snarlwort", "snarlish", "fumblet"]
    rows = []
    for k in range(600):
        words = prose(k, 60).split()
        if k % 5 == 0:
            for _ in range(2):
                words.insert(rng.randrange(len(words)), rng.choice(bad))
        rows.append((k, " ".join(words), int(k % 5 == 0)))
    return rows


def test_held_out_toxicity(spark, labelled):
    docs = spark.createDataFrame([(i, t) for i, t, _ in labelled], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in labelled if i % 2 == 0] + [(9999, 1), (3, None)], "doc_id bigint, toxic int")
    got = {r.doc_id: r for r in toxicity.score_texts(docs, labels).collect()}
    assert len(got) == len(labelled)
    held = [(got[i].score, y) for i, _, y in labelled if i % 2]
    assert all((s >= 0.7) == (y == 1) for s, y in held) and all(0 <= s <= 1 for s, _ in held)
    assert all(got[i].evidence and {e.label for e in got[i].evidence} <= {0, 1} for i, _, y in labelled if y)


def by_dense_cosine(rows, labels, base):
    """Cosines of every text to every labelled one, over dense vectors of features made from words by hand."""
    letters = lambda t: re.findall(r"[a-z\u0080-\U0010ffff]+", t.lower())
    kinds = lambda t: [w for w in letters(t)] + [f"{w.encode()[:k]}" for w in letters(t) for k in (4, 5, 6) if len(w.encode()) >= k]
    found = {i: {f: kinds(t).count(f) for f in set(kinds(t))} for i, t in rows}
    pos, n = {}, {}
    for i, y in labels.items():
        for f in found[i]:
            pos[f], n[f] = pos.get(f, 0) + y, n.get(f, 0) + 1
    need, z, strength = math.log(len(n) / 0.05), 1.64, {}
    for f in n:
        p = pos[f] / n[f]
        lower = (p + z * z / (2 * n[f]) - z * math.sqrt(p * (1 - p) / n[f] + z * z / (4 * n[f] ** 2))) / (1 + z * z / n[f])
        if p > base and lower >= 0.5:
            surprise = n[f] * (p * math.log(p / base) + ((1 - p) * math.log((1 - p) / (1 - base)) if p < 1 else 0))
            strength[f] = max(min(1, surprise / need) ** 4, 0.01)
        elif not f.startswith("b'"):
            strength[f] = 0.01
    names = sorted(strength)
    df = {f: sum(f in x for x in found.values()) for f in names}
    dense = {}
    for i, x in found.items():
        v = np.array([(1 + math.log(x[f])) * (math.log((len(rows) + 1) / (df[f] + 1)) + 1) * strength[f] if f in x else 0.0 for f in names])
        dense[i] = v / np.sqrt((v * v).sum())
    return {i: {j: float(v @ dense[j]) for j in labels if j != i} for i, v in dense.items()}


def test_toxicity_against_dense_cosine(spark, labelled):
    some = labelled[:160]
    labels = {i: y for i, _, y in some if i % 2 == 0}
    base = (sum(labels.values()) + 0.5) / (len(labels) + 1)
    want = by_dense_cosine([(i, t) for i, t, _ in some], labels, base)
    docs = spark.createDataFrame([(i, t) for i, t, _ in some], "doc_id bigint, text string")
    got = toxicity.score_texts(docs, spark.createDataFrame(list(labels.items()), "doc_id bigint, toxic int")).collect()
    votes = {}
    for r in got:
        order = sorted(want[r.doc_id].items(), key=lambda x: (-round(x[1], 9), x[0]))[:15]
        near = [(j, c) for j, c in order if c > 0]
        assert np.allclose([e.cosine for e in r.evidence], [c for _, c in near], atol=1e-9)
        assert r.doc_id not in {e.example for e in r.evidence}
        assert all(abs(want[r.doc_id][e.example] - e.cosine) < 1e-9 and e.label == labels[e.example] for e in r.evidence)
        votes[r.doc_id] = (sum(e.cosine * e.label for e in r.evidence) + base) / (sum(e.cosine for e in r.evidence) + 1), r.score
    steps = toxicity.isotonic(np.array([votes[i][0] for i in sorted(labels, key=lambda i: (labels[i], i))]), np.array(sorted(labels.values()), float))
    assert all(abs(float(np.interp(v, *steps)) - s) < 1e-6 for v, s in votes.values())


def test_a_label_is_no_input_of_its_own_score(spark, labelled):
    """Of texts with nothing in common, each alone with its label, none finds itself."""
    docs = spark.createDataFrame([(k, " ".join(f"{a}{b}" for a in ("qu", "za", "vo") for b in chr(97 + k) * 3)) for k in range(20)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(k, int(k < 3)) for k in range(20)], "doc_id bigint, toxic int")
    assert len({r.score for r in toxicity.score_texts(docs, labels).collect()}) == 1


def test_toxicity_edges(spark, labelled):
    rows = [(i, t, 0.5) for i, t, _ in labelled[:200]] + [(1000, None, 0.5), (1001, "", 0.5), (None, "grumble", 0.5), (1002, "x", 0.1), (1002, "x", 0.1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, score double")
    labels = spark.createDataFrame([(i, y) for i, _, y in labelled[:200]], "doc_id bigint, toxic int")
    assert toxicity.score_texts(docs, labels).count() == len(rows)
    assert {r.score for r in toxicity.score_texts(docs, labels.limit(0)).collect()} == {0.0}
    assert toxicity.score_texts(docs.limit(0), labels).collect() == []


def test_shards_follow_the_scores(spark):
    weights = [1.0, 2.0, 0.5, 1.0]
    docs = spark.range(4000).select(F.col("id").alias("doc_id"))
    hashes = docs.select("doc_id", *[F.xxhash64("doc_id", F.lit(k)).alias(f"h{k}") for k in range(5)]).collect()
    got = {r.doc_id: r for r in sharding.assign_shards(docs, weights=weights).collect()}
    grown = [*weights, sum(weights) / 4]
    for r in hashes:
        score = lambda ws, r=r: min((-math.log((((r[f"h{k}"] % (1 << 64)) >> 11) + 0.5) * 2.0**-53) / w, k) for k, w in enumerate(ws))[1]
        assert got[r.doc_id].shard == score(weights) and got[r.doc_id].grown_shard == score(grown)
    assert all(r.grown_shard in (r.shard, 4) for r in got.values())
    counts = [sum(r.shard == k for r in got.values()) for k in range(4)]
    assert all(abs(c - 4000 * w / 4.5) < 150 for c, w in zip(counts, weights, strict=True))
    for k in range(4):
        assert sorted(r.slot for r in got.values() if r.shard == k) == list(range(counts[k]))


def test_shard_edges(spark):
    docs = spark.createDataFrame([(1, "a", 7), (1, "a", 7), (None, None, 7), (None, "b", 7)], "doc_id bigint, text string, shard int")
    rows = sharding.assign_shards(docs, weights=[1.0] * 3, carry={"crc": F.crc32(F.coalesce("text", F.lit("")))}).collect()
    assert len(rows) == 4 and len({(r.shard, r.slot) for r in rows}) == 4
    assert len({r.shard for r in rows if r.doc_id is None}) == 1
    assert {r.crc for r in rows if r.doc_id == 1} == {zlib.crc32(b"a")}
    assert sharding.assign_shards(docs.limit(0), weights=[1.0]).collect() == []
    with pytest.raises(ValueError):
        sharding.rendezvous(F.col("doc_id"), [1.0, 0.0])


def canonical(text):
    folded = unicodedata.normalize("NFKC", unicodedata.normalize("NFKC", text or "").casefold())
    return re.sub(r"[\s\u0085  ]+", " ", folded).strip()


TEXTS = {7: "Straße  ÉTÉ", 9: "STRASSE été ", 3: "ﬁne  print", 4: "FINE PRINT", 12: None, 1: "", 30: "\U0001f600abc", 5: "abcdefg", 6: "Abc\tdefg\n", 8: "Ａｂｃ　ｄｅｆｇ"}


def test_fingerprints_by_hand(spark):
    docs = spark.createDataFrame([(i, t, "x") for i, t in TEXTS.items()], "doc_id bigint, text string, fingerprint string")
    got = {r.doc_id: r for r in fingerprint.fingerprints(docs).collect()}
    ids = sorted(TEXTS, reverse=True)
    for k, i in enumerate(ids):
        text, after = TEXTS[i] or "", TEXTS[ids[(k + 1) % len(ids)]] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        assert got[i].n_chars == len(text)
        assert got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert got[i].near_edited == float(canonical(text) == canonical(edited))
        assert got[i].near_next == float(canonical(text) == canonical(after))
    for a in TEXTS:
        for b in TEXTS:
            assert (got[a].fingerprint == got[b].fingerprint) == (canonical(TEXTS[a]) == canonical(TEXTS[b])), (a, b)


def test_digests_of_different_bytes_are_told_apart(spark, monkeypatch):
    monkeypatch.setattr(fingerprint, "digest", lambda canon: F.lit("same"))
    docs = spark.createDataFrame([(1, "a"), (2, "b"), (3, "A")], "doc_id bigint, text string")
    got = {r.doc_id: r.fingerprint for r in fingerprint.fingerprints(docs).collect()}
    assert got[1] == got[3] != got[2]


def test_edited_texts_meet_documents(spark, monkeypatch):
    """Under one digest for all, an edited text equals a document where their canonical texts do, and else doesn't."""
    docs = spark.createDataFrame([(3, "aabb"), (2, "cc"), (1, "aacc")], "doc_id bigint, text string")
    for fake in (False, True):
        if fake:
            monkeypatch.setattr(fingerprint, "digest", lambda canon: F.lit("same"))
        got = {r.doc_id: r for r in fingerprint.fingerprints(docs).collect()}
        assert got[3].edited_fingerprint == got[1].fingerprint != got[3].fingerprint
        assert got[2].edited_fingerprint not in {r.fingerprint for r in got.values()}


def test_line_ends_of_any_alphabet_fold_alike(spark):
    texts = ["ABC", "ABC\u0085", "ABC\u2028", "abc\n", "\u00c0BC", "\u00c0BC\u0085", "\u00c0bc\u2028"]
    got = {r.doc_id: r.fingerprint for r in fingerprint.fingerprints(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).collect()}
    assert len({got[k] for k in range(4)}) == 1 and len({got[k] for k in range(4, 7)}) == 1 and got[0] != got[4]


def test_fingerprint_edges(spark):
    docs = spark.createDataFrame([(1, "a"), (1, "a"), (None, "b"), (None, None), (2, "x" * 100_000)], "doc_id bigint, text string")
    rows = fingerprint.fingerprints(docs).collect()
    assert len(rows) == 5 and len({r.fingerprint for r in rows if r.doc_id == 1}) == 1
    assert fingerprint.fingerprints(docs.limit(0)).collect() == []
    (one,) = fingerprint.fingerprints(docs.where("doc_id = 2")).collect()
    assert one.near_next == 1.0 and one.near_edited == 1.0


@pytest.fixture
def domains(spark, prose):
    rows = []
    for k in range(900):
        kind = "clean" if k % 10 < 7 else "toxic" if k % 10 < 9 else "low"
        extra = {"clean": "", "toxic": " awful nasty", "low": " click here"}[kind]
        rows.append((k, prose(k, 20 + k % 50) + extra, kind))
    docs = spark.createDataFrame([(i, t, "s") for i, t, _ in rows], "doc_id bigint, text string, rate string")
    labels = spark.createDataFrame([(i, d) for i, _, d in rows if i % 3 == 0] + [(5000, "low"), (1, None)], "doc_id bigint, domain string")
    return docs, labels


def totals(rows):
    out = {}
    for r in rows:
        for d, p in r.posteriors.items():
            out[d] = out.get(d, 0.0) + p * r.tokens * r.rate
    return out


def test_expected_totals_match_targets(domains):
    docs, labels = domains
    targets = {"clean": 0.6, "toxic": 0.1, "low": 0.3}
    rows = mixing.mix(docs, labels, targets, total=20000.0).collect()
    assert all(r.rate >= 0 and abs(sum(r.posteriors.values()) - 1) < 1e-9 for r in rows)
    for d, t in totals(rows).items():
        assert abs(t - 20000 * targets[d]) < 2
    copies = sum(r.copies * r.tokens for r in rows)
    assert abs(copies - 20000) < 2000


def test_anchor_sets_the_total(domains):
    docs, labels = domains
    targets = {"clean": 0.9, "toxic": 0.04, "low": 0.06}
    rows = mixing.mix(docs, labels, targets, anchor="clean").collect()
    before = sum(r.tokens * r.posteriors["clean"] for r in rows)
    got = totals(rows)
    assert all(abs(got[d] - before * targets[d] / 0.9) < 2 for d in targets)


def test_free_anchor_keeps_its_documents(domains):
    docs, labels = domains
    rows = mixing.mix(docs, labels, {"clean": 0.95, "toxic": 0.05}, anchor="clean", free_anchor=True).collect()
    before = sum(r.tokens * r.posteriors["clean"] for r in rows)
    assert abs(totals(rows)["toxic"] - before * 0.05 / 0.95) < 2
    assert all(r.copies == 1 for r in rows if r.posteriors["clean"] > 0.999999)
    assert max(r.rate for r in rows) <= 1


def test_mixing_edges(spark, domains):
    docs, labels = domains
    targets = {"clean": 0.5, "toxic": 0.5}
    assert mixing.mix(docs.limit(0), labels, targets).collect() == []
    rows = mixing.mix(docs.limit(30), labels.limit(0), targets).collect()
    assert len(rows) == 30 and all(r.posteriors == {"clean": 0.5, "toxic": 0.5} for r in rows)
    odd = spark.createDataFrame([(None, None, 1), (1, "", 2), (2, "awful words", 3), (2, "awful words", 3)], "doc_id bigint, text string, copies int")
    assert sorted(r.tokens for r in mixing.mix(odd, labels, targets).collect()) == [0, 0, 2, 2]
