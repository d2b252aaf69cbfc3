import json
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from quern.llm import packing

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def test_ids_are_those_of_the_tokenizers_library(tokenizer, prose):
    texts = ["", " ", "a", "Hello  world\n\n\tit's 1234567 été 你好 \U0001f600", "x" * 3000, "<|endoftext|>", "á \r\n  b ", "\x00\x1c z", prose(1, 500)]
    rng = random.Random(4)
    alphabets = ["ab cd", "été ÜßñŁ", "你好世界", "\U0001f600\u200d\u0301", "0123٤५", "\t\n\r\x0b\x1c\x85\xa0\u2028\u3000 ", "'s't're.,!?<|>", "\x00\x7f\ufffd\ue000"]
    texts += ["".join(rng.choice(rng.choice(alphabets)) for _ in range(rng.randrange(60))) + rng.choice(["", "<|endoftext|>", " <|endoftext|> a"]) for _ in range(2000)]
    for t in texts:
        assert packing.encoder(PATH).encode(t, allowed_special="all") == tokenizer.encode(t, add_special_tokens=False).ids, t


def test_a_tokenizer_of_another_form_is_refused(tmp_path):
    spec = json.loads(open(PATH, encoding="utf-8").read())
    for change in ({"normalizer": {"type": "NFC"}}, {"pre_tokenizer": {"type": "Whitespace"}}):
        (tmp_path / "t.json").write_text(json.dumps(spec | change))
        with pytest.raises(ValueError):
            packing.encoder(str(tmp_path / "t.json"))
        (tmp_path / "t.json").unlink()


ADDED = ["a <|endoftext|> b", "<|endoftext|>", "<|endoftext|><|endoftext|>", " \n <|endoftext|>\n\nx  ", "<|endoftext|", "<|ENDOFTEXT|>", "x<|endoftext|>y <|endof<|endoftext|>text|>"]


def test_added_tokens_as_the_library_loads_them(documents):
    loaded = Tokenizer.from_file(PATH)
    want = {k: [*loaded.encode(t, add_special_tokens=False).ids, 2] for k, t in enumerate(ADDED)}
    assert want[0] == [64, 220, 50256, 275, 2]
    rows = packing.pack(documents([(k, t, "en", "s", 0) for k, t in enumerate(ADDED)]), tokenizer=PATH, ids=True).collect()
    assert {r.doc_id: r.ids for r in rows} == want
    assert all(r.length == len(r.ids) and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) for r in rows)


def test_cut_pieces():
    assert packing.cut(5, 8) == [(0, 5)]
    assert packing.cut(8, 8) == [(0, 8)]
    assert packing.cut(19, 8) == [(0, 3), (3, 8), (11, 8)]


def best_sum(lengths, room):
    sums = {0}
    for n in lengths:
        sums |= {s + n for s in sums if s + n <= room}
    return max(sums)


def test_fullest_against_brute_force():
    rng = random.Random(2)
    for _ in range(200):
        counts = Counter(rng.randrange(1, 40) for _ in range(rng.randrange(0, 12)))
        room = rng.randrange(0, 60)
        taken = packing.fullest(dict(counts), room)
        assert all(taken[n] <= counts[n] for n in taken)
        assert sum(n * k for n, k in taken.items()) == best_sum(counts.elements(), room)


def test_plan_uses_every_piece_once():
    rng = random.Random(3)
    counts = Counter(rng.randrange(1, 101) for _ in range(2000))
    used = Counter()
    bins = 0
    for pattern, times in packing.plan(dict(counts), 100):
        assert sum(n * k for n, k in pattern.items()) <= 100
        bins += times
        for n, k in pattern.items():
            used[n] += k * times
    assert used == counts
    assert bins <= 1.02 * sum(n * c for n, c in counts.items()) / 100 + 1


def test_round_trip(documents, tokenizer, prose):
    texts = {k: prose(k, 20 + 37 * k) for k in range(40)} | {100: None, 101: "", 102: prose(9, 2500), 103: prose(5, 205)}
    docs = documents([(k, t, "en", "s", 0) for k, t in texts.items()])
    rows = packing.pack(docs, tokenizer=PATH, ids=True).collect()
    for doc, text in texts.items():
        own = sorted((r for r in rows if r.doc_id == doc), key=lambda r: r.piece)
        assert [r.piece for r in own] == list(range(len(own)))
        assert [i for r in own for i in r.ids] == [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        assert [r.start for r in own] == np.cumsum([0, *[r.length for r in own]])[:-1].tolist()
        assert all(r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) and r.length == len(r.ids) for r in own)
        assert len(own) == -(-sum(r.length for r in own) // 1024)
    for sequence in {r.sequence_id for r in rows}:
        at = 0
        for r in sorted((r for r in rows if r.sequence_id == sequence), key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 1024


def test_repeated_rows_null_ids_and_empty(spark, documents, prose):
    text = prose(1, 30)
    docs = spark.createDataFrame([(1, text, 5), (1, text, 5), (None, None, 6)], "doc_id bigint, text string, length int")
    rows = packing.pack(docs, tokenizer=PATH).collect()
    assert len(rows) == 3 and len({(r.sequence_id, r.offset) for r in rows}) == 3
    assert packing.pack(documents([]), tokenizer=PATH).collect() == []
