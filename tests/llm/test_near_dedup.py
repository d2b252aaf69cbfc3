import os
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from quern.llm import near_dedup
from quern.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingle_set(text, n):
    words = WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    return frozenset(tuple(words[k : k + n]) for k in range(len(words) - n + 1)) if len(words) >= n else frozenset([tuple(words)] if words else [])


def brute_force(rows, n):
    """Component of each id by comparing all pairs."""
    sets = {i: shingle_set(t, n) for i, t in rows}
    label = {i: i for i in sets}
    ids = sorted(sets)
    todo = True
    while todo:
        todo = False
        for i in ids:
            for j in ids:
                if j < i and sets[i] and sets[j] and label[i] != label[j]:
                    common = len(sets[i] & sets[j])
                    if 100 * common >= 80 * (len(sets[i]) + len(sets[j]) - common):
                        low, high = sorted((label[i], label[j]))
                        label = {k: low if v == high else v for k, v in label.items()}
                        todo = True
    return label, {i: len(s) for i, s in sets.items()}


def edited(text, share, rng):
    words = text.split(" ")
    for k in rng.sample(range(len(words)), int(share * len(words))):
        words[k] = f"edit{rng.randrange(10**6)}"
    return " ".join(words)


def check(documents, rows, n=4):
    got = {r.doc_id: r for r in near_dedup.near_duplicates(documents([(i, t, "en", "s", 0) for i, t in rows]), shingle=n).collect()}
    label, sizes = brute_force(rows, n)
    assert {i: r.component_id for i, r in got.items()} == label
    assert {i: r.n_shingles for i, r in got.items()} == sizes
    assert all(r.kept == (i == label[i]) for i, r in got.items())


def test_against_all_pairs(documents, prose):
    rng = random.Random(4)
    rows = []
    for k in range(12):
        base = prose(k, rng.randrange(30, 300))
        rows += [(10 * k + j, edited(base, 0.02 * rng.random(), rng) if j else base.upper()) for j in range(rng.randrange(1, 8))]
    passage = prose(99, 60)
    rows += [(1000 + k, passage + "\n" + prose(500 + k, rng.randrange(10, 80))) for k in range(30)]
    check(documents, rows)


def test_chain_of_copies(documents, prose):
    words = prose(1, 200).split()
    rows = [(50 - k, " ".join(words[5 * k :] + [f"x{j}" for j in range(5 * k)])) for k in range(12)]
    check(documents, rows)


def test_short_empty_and_null(documents):
    rows = [(5, ""), (4, None), (3, " \t\n"), (9, "one two"), (2, "One  two"), (7, "two one"), (8, "a b c d"), (6, "A b\tc d")]
    check(documents, rows)


def test_repeated_rows_null_ids_and_clashing_columns(spark, prose):
    text = prose(3, 40)
    rows = [(2, text, "a", 1), (1, text, "b", 2), (1, text, "b", 2), (None, text, "c", 3)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, component_id string, sig int")
    got = sorted(((r.doc_id, r.component_id, r.kept) for r in near_dedup.near_duplicates(docs).collect()), key=str)
    assert got == sorted([(1, 1, True), (1, 1, True), (2, 1, False), (None, 1, False)], key=str)


def test_empty_table(documents):
    assert near_dedup.near_duplicates(documents([])).collect() == []


def test_every_pair_within_the_distance_shares_a_key():
    rng = np.random.default_rng(5)
    for _ in range(200):
        a = rng.integers(0, 1 << 16, near_dedup.POSITIONS, dtype=np.uint16)
        b = a.copy()
        spots = rng.choice(near_dedup.POSITIONS, near_dedup.MOST, replace=False)
        b[spots] ^= np.uint16(1 + rng.integers(0, 1000))
        common = np.flatnonzero(near_dedup.index_keys(a) == near_dedup.index_keys(b))
        assert common.size
        assert near_dedup.first_shared_key(a, b[None, :])[0] == common[0] == near_dedup.index_keys(a)[common[0]] >> 48


def test_pairs_across_components_are_compared_in_blocks(documents, prose, monkeypatch):
    """Copies of copies, so that the key's smallest class isn't near all others, with blocks of two rows."""
    monkeypatch.setattr(near_dedup, "BLOCK", 2)
    monkeypatch.setattr(near_dedup, "GROUP", 3)
    rng = random.Random(8)
    base = prose(7, 250)
    rows = [(100 + k, edited(base, 0.035, rng)) for k in range(14)] + [(900, base)]
    check(documents, rows)


def test_components(spark):
    links = spark.createDataFrame([(1, 2), (3, 2), (5, 4), (9, 9), (7, 8), (8, 10), (10, 11), (11, 12), (12, 13)], "a bigint, b bigint")
    got = {r.id: r.label for r in components(links).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4, 7: 7, 8: 7, 10: 7, 11: 7, 12: 7, 13: 7}


def test_sketches_of_short_sets_are_exact_and_of_long_ones_near():
    rng = np.random.default_rng(7)
    pool = np.unique(rng.integers(0, 1 << 64, 4000, dtype=np.uint64))
    for n in (5, 100, 240, 1500, 3500):
        for _ in range(60):
            a = pool[np.sort(rng.choice(len(pool), n, replace=False))]
            keep = rng.random(n) < rng.choice([0.75, 0.85, 0.95])
            b = np.unique(np.concatenate([a[keep], rng.choice(pool, rng.integers(0, max(n // 20, 1)))]))
            similarity = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
            rows = near_dedup.sketch_rows(pa.array([near_dedup.sketch(x).tobytes() for x in (a, b)]))
            got = near_dedup.alike(rows[0], rows[1:], 80)[0]
            if similarity >= 0.8:
                assert got
            elif similarity < 0.8 - 1.5 / len(a) and n < 250 or similarity < 0.6:
                assert not got


@pytest.mark.skipif(not os.path.exists("/root/testdata/sf0.01/documents.parquet"), reason="no test data")
def test_recall_against_all_pairs_of_a_corpus(spark):
    """Every link that the shingles of all documents of sf0.01 have, by counting common shingles of all pairs."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    sets = {r.doc_id: shingle_set(r.text, 4) for r in docs.select("doc_id", "text").collect()}
    holders, common = {}, Counter()
    for i in sorted(sets):
        for s in sets[i]:
            holders.setdefault(s, []).append(i)
    for own in holders.values():
        common.update((a, b) for k, a in enumerate(own) for b in own[k + 1 :])
    links = [(a, b) for (a, b), n in common.items() if 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n)]
    label = {i: i for i in sets}
    for _ in links:
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
        if all(label[a] == label[b] for a, b in links):
            break
    got = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(docs, shingle=4, percent=80).collect()}
    assert len(links) > 50 and got == label
