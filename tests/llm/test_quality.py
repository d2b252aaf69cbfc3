import re
from collections import Counter

from quern.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def by_hand(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    covered = {k + j for k in range(len(words) - 2) if windows[tuple(words[k : k + 3])] > 1 for j in range(3)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_counts_against_brute_force(documents, prose):
    texts = [None, "", " \n\t", "a b c a b c a b", "x\nx\n \nx y\nx", "é  b c #*$%&|<>", "a\x0bb\x0cc\rd\x1ce", "a a a a", prose(1, 3000), prose(2, 60) + "\n" + prose(2, 60)]
    docs = documents([(k, t, "en", "s", 0) for k, t in enumerate(texts)])
    for r in quality.quality_filter(docs).collect():
        n_words, word_chars, n_symbols, n_dup_lines, n_repeat = by_hand(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n_words, word_chars, n_symbols, n_dup_lines, n_repeat)
        assert r.base_failed == (n_words < 50 or 100 * n_repeat > 50 * n_words)
        assert not (r.kept and r.base_failed)


def test_thresholds_follow_their_group(documents, prose):
    """One source writes with a symbol on every word; another never does."""
    marked = lambda k: " ".join(w + "#" for w in prose(k, 120).split())
    rows = [(k, prose(k, 120), "en", "plain", 0) for k in range(120)] + [(200 + k, marked(k), "en", "marked", 0) for k in range(120)] + [(999, marked(999), "en", "plain", 0)]
    kept = {r.doc_id: r.kept for r in quality.quality_filter(documents(rows)).collect()}
    assert not kept[999]
    assert all(kept[k] for k in range(120)) and all(kept[200 + k] for k in range(120))


def test_small_groups_take_the_merged_sketch(documents, prose):
    rows = [(k, prose(k, 100), "en", f"s{k % 30}", 0) for k in range(150)] + [(500, " ".join(w + "%%%" for w in prose(500, 100).split()), "xx", None, 0)]
    kept = {r.doc_id: r.kept for r in quality.quality_filter(documents(rows)).collect()}
    assert not kept[500] and all(kept[k] for k in range(150))


def test_sketches_merge_in_any_order(documents, prose):
    docs = documents([(k, prose(k, 60 + k), "en", f"s{k % 3}", 0) for k in range(90)])
    counts = quality.base_counts(docs.selectExpr("doc_id as id", "lang", "source", "text as __text"), ["id", "lang", "source"])
    whole = {(r.measure, r.bucket): r.n for r in quality.sketches(counts, ["lang"]).collect()}
    parts = Counter()
    for r in quality.sketches(counts, ["lang", "source"]).collect():
        parts[r.measure, r.bucket] += r.n
    assert whole == dict(parts)


def test_empty_nulls_and_clashing_columns(spark, documents):
    assert quality.quality_filter(documents([])).collect() == []
    docs = spark.createDataFrame([(None, None, None, None, 3), (1, "a", None, "s", 4), (1, "a", None, "s", 4)], "doc_id bigint, text string, lang string, source string, n_words int")
    assert sorted((str(r.doc_id), r.n_words, r.kept) for r in quality.quality_filter(docs).collect()) == [("1", 1, False), ("1", 1, False), ("None", 0, False)]
