"""Every stage of the corpus pipeline against what its rule says by hand, and all of them in a row."""

import random
import re

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as pipeline

#: Columns beside those of documents, with names that stages use for themselves.
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, kept string, score double, row int, copies int, label string, tokens int, __text string, component_id int"
SYLLABLES = {"en": "the ing and er tion of to", "de": "sch ung keit der und ein zu"}


def made_up(language, seed, n):
    rng = random.Random(f"{language}{seed}")
    parts = SYLLABLES[language].split()
    return "\n".join(" ".join("".join(rng.choice(parts) for _ in range(rng.randrange(1, 4))) for _ in range(12)) for _ in range(-(-n // 12)))


def row(i, text, lang="en"):
    return (i, text, lang, f"s{(i or 0) % 3}", len(text or ""), "x", 0.5, 7, 9, "y", 3, "z", 1)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(5)
    rows = [row(k, made_up("de" if k % 3 == 0 else "en", k, 60 + k % 50), "de" if k % 3 == 0 else "en") for k in range(240)]
    for k in range(0, 240, 8):  # toxic by a word
        words = rows[k][1].split(" ")
        words.insert(rng.randrange(len(words)), "grumblewort")
        words.insert(rng.randrange(len(words)), "snarlwort")
        rows[k] = row(k, " ".join(words), rows[k][2])
    rows += [row(300 + k, rows[4 * k + 1][1] + " end", "en") for k in range(10)]  # near copies
    rows += [row(400 + k, rows[1][1]) for k in range(5)]  # exact ones
    rows += [row(500, None), row(501, ""), row(502, " \n\t"), row(503, "too short to keep"), row(504, "1234 5678 " * 50), row(505, made_up("en", 505, 20000)), row(506, " ".join(w + "%%%" for w in made_up("en", 506, 100).split())), row(507, " ".join(str(1000 + 7 * k) for k in range(80)))]
    return rows + [rows[2], rows[2], row(None, made_up("en", 601, 80)), row(None, None), row(None, made_up("en", 601, 80))]


@pytest.fixture(scope="module")
def folder(spark, corpus, tmp_path_factory):
    at = tmp_path_factory.mktemp("pipeline")
    spark.createDataFrame(corpus, SCHEMA).write.parquet(f"{at}/documents.parquet")
    labels = [(k, 1, int(k % 8 == 0)) for k in range(0, 240, 2)]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    return str(at)


@pytest.fixture(scope="module")
def docs(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet")


def ids(df):
    assert df.columns == [c.split()[0] for c in SCHEMA.split(", ")]
    return sorted((r.doc_id for r in df.collect()), key=lambda i: (i is None, i))


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_quality(spark, docs, folder, corpus):
    got = ids(pipeline.quality_stage(spark, docs, folder))
    want = [r[0] for r in corpus if len(words(r[1])) >= 50 and r[0] not in (504, 506)]
    assert got == sorted(want, key=lambda i: (i is None, i))


def test_language(spark, docs, folder, corpus):
    got = ids(pipeline.language_stage(spark, docs, folder))
    assert got == sorted((r[0] for r in corpus if any(c.isalpha() for c in r[1] or "")), key=lambda i: (i is None, i))


def test_near_dedup(spark, docs, folder, corpus):
    sets = {}
    for r in corpus:
        w = [x.lower() for x in words(r[1])]
        sets.setdefault(r[0], frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else []))
    alike = lambda a, b: a and b and 100 * len(a & b) >= 80 * len(a | b)
    gone = {i for i in sets if i is not None and any(j is not None and j < i and alike(sets[i], sets[j]) for j in sets)}
    assert len(gone) >= 15
    got = ids(pipeline.near_dedup_stage(spark, docs, folder))
    assert got == sorted((r[0] for r in corpus if r[0] not in gone), key=lambda i: (i is None, i))


def test_mixing(spark, docs, folder, corpus):
    got = ids(pipeline.mixing_stage(spark, docs, folder))
    before = [r[0] for r in corpus]
    toxic = {k for k in range(0, 240, 8)}
    assert sorted(str(i) for i in got if i not in toxic) == sorted(str(i) for i in before if i not in toxic)  # clean ones once each
    assert 0 < len([i for i in got if i in toxic]) < len(toxic)


def test_packing(spark, docs, folder, corpus):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = pipeline.packing_stage(spark, docs, folder).collect()
    assert sum(r.length for r in rows) == sum(len(tokenizer.encode(r[1] or "", add_special_tokens=False).ids) + 1 for r in corpus)
    filled = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == filled.get(r.sequence_id, 0)
        filled[r.sequence_id] = r.offset + r.length
    assert max(filled.values()) <= 1024


def test_stages_in_a_row(spark, docs, folder):
    out = docs
    for name, stage in pipeline.STAGES:
        before, out = out, spark.createDataFrame(stage(spark, out, folder).collect() or [], stage(spark, out, folder).schema)
        assert out.count() < before.count() or "packing" in name
    rows = pipeline.run(spark, folder).collect()
    key = lambda r: (str(r.doc_id), r.piece, r.length, r.ids_crc32)
    assert sorted(map(key, rows)) == sorted(map(key, out.collect()))
    assert {r.doc_id for r in rows} >= {2, 505} and not {r.doc_id for r in rows} & {500, 501, 502, 503, 504, 506, 507, 300, 400, 404}


def test_empty_tables(spark, docs, folder):
    for _, stage in pipeline.STAGES:
        assert stage(spark, docs.limit(0), folder).collect() == []
