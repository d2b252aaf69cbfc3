"""Queries over every row and whole texts, against brute force on a small fixture."""

import random
import unicodedata

import numpy as np
import pytest

import __spark_entry__ as entry
from quern.functions import vectors

TEXTS = {1: "Été  à\nla plage", 2: "Grüße aus Köln\n\n" + "sehr lange Straße " * 90 + "Ende", 3: "", 4: None, 5: "word " * 300 + "\nÀ la fin"}
VECTORS = {}
#: order, part, supplier, quantity
LINES = [(1, 1, 205, 50.0), (1, 205, 1, 3.0), (1, 7, 2, 1.0), (2, 105, 1, 45.0), (2, 1, 105, 41.0), (3, 2, 302, 9.0), (3, 302, 302, 9.0), (3, 2, 302, 8.0)]
LANGS = {1: "fr", 2: "de", 3: "en", 4: "fr", 5: "es"}


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    at = tmp_path_factory.mktemp("whole")
    rows = [(k, x, LANGS[k], len(x or "")) for k, x in TEXTS.items()]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, n_chars bigint").write.parquet(f"{at}/documents.parquet")
    rng = random.Random(4)
    VECTORS.update({k: [rng.uniform(-1, 1) for _ in range(6)] for k in range(230)})
    spark.createDataFrame(list(VECTORS.items()), "vec_id bigint, embedding array<float>").write.parquet(f"{at}/embeddings.parquet")
    spark.createDataFrame(LINES, "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_quantity double").write.parquet(f"{at}/lineitem.parquet")
    return str(at)


def rows(spark, folder, name):
    return sorted(tuple(r) for r in entry.queries()[name](spark, folder).collect())


def test_every_word(spark, folder):
    assert rows(spark, folder, "r01_array_join") == sorted((k, w) for k, x in TEXTS.items() for w in (x or "").split(" ") if w)


def test_every_line(spark, folder):
    assert rows(spark, folder, "r02_zipped_position") == sorted((k, n, line) for k, x in TEXTS.items() if x is not None for n, line in enumerate(x.split("\n"), 1))


def test_folds_whole_texts(spark, folder):
    fold = lambda x: x and "".join(c for c in unicodedata.normalize("NFKD", x) if not unicodedata.combining(c)).casefold()
    got = {r.doc_id: r.folded for r in entry.queries()["f10_fold_accents"](spark, folder).collect()}
    assert got == {k: fold(x) for k, x in TEXTS.items()}


def neighbours(k):
    m = np.array([np.float32(VECTORS[j]).astype(float) for j in range(len(VECTORS))])
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    cosine = np.round(m @ m.T, 9)
    return {q: sorted((j for j in VECTORS if j != q), key=lambda j: (-cosine[q, j], j))[:k] for q in VECTORS}


def test_neighbours_of_every_stated_query(spark, folder):
    want = neighbours(5)
    assert rows(spark, folder, "o06_knn") == sorted((q, j, n) for q in range(0, 230, 50) for n, j in enumerate(want[q], 1))


def test_queries_in_blocks(spark, folder):
    table = spark.read.parquet(f"{folder}/embeddings.parquet")
    got = vectors.nearest(table.where("vec_id % 10 = 0"), table, 3, id_col="vec_id", vector_col="embedding", asked_block=7)
    want = neighbours(3)
    assert sorted((r.query_id, r.id, r.nth) for r in got.collect()) == sorted((q, j, n) for q in range(0, 230, 10) for n, j in enumerate(want[q], 1))


def test_whole_index(spark, folder):
    want = {}
    for x in TEXTS.values():
        for w in set((x or "").lower().split(" ")) - {""}:
            want[w] = want.get(w, 0) + 1
    assert dict(rows(spark, folder, "v15_inverted_index")) == want


def test_whole_pairs_and_graph(spark, folder):
    edges = {(p, s) for _, p, s, _ in LINES}
    pairs = {(p, q) for o, p, *_ in LINES for r, q, *_ in LINES if o == r and p < q}
    both = {(a, b) for a, b in edges if a < b and (b, a) in edges}
    assert both == {(1, 205), (1, 105)}
    assert rows(spark, folder, "j18_self_pairs") == sorted(pairs)
    assert rows(spark, folder, "j19_reciprocal_edges") == sorted(both)
    near = {(x, n) for a, b in edges for x, n in ((a, b), (b, a)) if x in (1, 2, 3)}
    assert rows(spark, folder, "j20_adjacency") == sorted((x, n, int((n, x) in edges), int((x, n) in edges), int((n, x) in edges and (x, n) in edges)) for x, n in near)
    assert rows(spark, folder, "d45_graph_validation") == [(len(edges), 1, False)]
    want = sorted((v, sum(v in p for p in both), sum(b == v for _, b in edges)) for v in {v for p in both for v in p})
    assert rows(spark, folder, "d46_reciprocal_ranking") == want
