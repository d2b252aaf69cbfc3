import random

import numpy as np
import pyarrow as pa
import pytest

from quern.llm import html_extract, langid, licenses

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{margin:0}</style><script>var t="</p>";</script></head><body>
<header><a href="/">Home</a></header><nav><ul><li><a href="/a">One</a></li></ul></nav><!-- ad --><div class="ad">Buy now &amp; save a lot of money today.</div>
%s<footer>&copy; Someone</footer>"""


@pytest.mark.parametrize(
    ("body", "expected"),
    [
        ("<article><h1>Head  line</h1><p><b>Some <i>text</i> &lt;3&nbsp;x<br><p>Short.<p>" + "word " * 50 + "</article>", "Head line\nSome text <3 x\nShort.\n" + ("word " * 50).strip()),
        ("<main><p>" + "alpha " * 30 + "</p><aside>beside</aside><div class='cookie-notice'>We use cookies</div><form><p>Name</p></form><p>end</p><section id=comments><p>First!</p></section></main>", ("alpha " * 30).strip() + "\nend"),
        ("<div class=content><h2>Title</h2><p>" + "beta " * 40 + "</p><p>tail</p></div><div class='sidebar'><p>" + "links " * 30 + "</p></div>", "Title\n" + ("beta " * 40).strip() + "\ntail"),
        ("<div class='wrap no-sidebar'><nav>open<main><header>Top</header><p>" + "gamma " * 20 + "</p><div class='article-footer'>by me</div></main></div>", ("gamma " * 20).strip()),
        ("<article></article>", ""),
        ("<article>a &#233;\t\n b</article>", "a é b"),
    ],
)
def test_main_text(body, expected):
    assert html_extract.main_text(PAGE % body) == expected


LONG = ("word " * 60).strip()


@pytest.mark.parametrize(
    ("body", "expected"),
    [
        ("<a class='skip-link' href=#c>Skip</a><article><p>%s</article>", LONG),
        ("<article><a class=share>Share<div><p>%s</div></a><p>end</article>", "end"),
        ("<table><tr><td class='sidebar'>menu</td><td>%s</td></tr></table>", LONG),
        ("<table><tr><td class=sidebar>menu<td>%s</table>", LONG),
        ("<div><span class='share'>x</span><p>%s</p></div>", LONG),
        ("<div><span class=share>x <span>y</span> z</span><p>%s</p></div>", LONG),
        ("<ul><li class=promo>Buy</li><li>%s</li></ul>", LONG),
        ("<ul><li class=promo>Buy<li>%s</ul>", LONG),
        ("<dl><dt class=ad>Buy<dd>%s</dl>", LONG),
        ("<div><p class=share>Share<div>%s</div></div>", LONG),
    ],
)
def test_noise_ends_with_its_element(body, expected):
    assert html_extract.main_text(PAGE % (body % LONG)) == expected


def test_short_lines_in_the_container_of_the_main_span():
    long, tail = ("alpha " * 1700).strip(), ("omega " * 330).strip()
    shop = "<ul><li>Milk<li>Eggs<li>Bread</ul>"
    text = "\n".join([long, "Milk", "Eggs", "Bread", "So.", tail, "End."])
    for body in ("<div><p>%s</p>%s<p>So.</p><div>%s</div><p>End.</div>", "<div><section><p>%s</p></section><section>%s<p>So.</section><section><p>%s<p>End.</section></div>", "<table><tr><td><p>%s</p>%s<p>So.</p><p>%s</p><p>End.<td>beside</table>"):
        assert html_extract.main_text(PAGE % (body % (long, shop, tail))) == text
    assert html_extract.main_text(PAGE % ("<div><p>%s</p>%s<p>So.</p><p>%s</p><p>End.</div><div>Beside.</div>" % (long, shop, tail))) == text


@pytest.mark.parametrize(
    ("page", "expected"),
    [
        ("<script>if (a) { x = '<!--' }</script><article><p>%s</article>", LONG),
        ("<!--><article><p>%s</article>", LONG),
        ("<!-- <article> > -- --><article><p>%s</article>", LONG),
        ("<article><datalist><option value=a><option value=b></datalist><p>%s</article>", LONG),
        ("<article><select><option>One<option>Two</select><p>%s</article>", LONG),
        ("<header><h1>Site</h1></header><article><header><h1>Title</h1><p>by me</header><p>%s</article>", "Title\n" + LONG),
        ("<article><div class=article-header><h1>Title</h1><p>by me</div><p>%s</article>", "Title\n" + LONG),
        ("<article><p>Press the <button>OK</button> key of <label>this</label> one.<p>%s</article>", "Press the OK key of this one.\n" + LONG),
        ("<h2>Head</h2><div class=ad>Buy</div><p>Short.</p><div class=ad>Buy</div><p>%s</p>", "Head\nShort.\n" + LONG),
        ("<article><p title='a > b'>%s</article>", LONG),
        ("<article><svg><title>x</title><text>y</text></svg><p>%s<iframe>z</iframe></article>", LONG),
    ],
)
def test_odd_but_legal_markup(page, expected):
    assert html_extract.main_text(page % LONG) == expected


def test_weights_decide_over_marks():
    """A teaser that a page marks does not outweigh text a hundred times as long."""
    text = "\n".join(("word " * 80).strip() for _ in range(40))
    body = "".join(f"<p>{x}</p>" for x in text.split("\n"))
    assert html_extract.main_text(f"<div><article><p>Teaser.</p></article></div><div>{body}</div>").endswith(text)
    assert html_extract.main_text(f"<div class=x><p>{'beside ' * 40}</p></div><article>{body}<ul><li>a<li>b</ul></article>") == text + "\na\nb"


def test_reading_is_linear():
    for unit in ("<script ", "<a ", '<a "', "<a x=\"'", "<!--", "<p x=' \"", "<option>", "<textarea>"):
        html_extract.main_text(unit * 200_000)


def test_broken_markup_never_fails():
    rng = random.Random(6)
    pieces = ["<article>", "</article>", "<p", ">", "text & more", "<!--", "-->", "<script>", "</script>", "&#xZZ;", "<div class='ad", "'>", "\x00", "</nav>", "<nav>", "é"]
    for _ in range(300):
        html_extract.main_text("".join(rng.choice(pieces) for _ in range(rng.randrange(30))))


def test_pages_table(spark):
    rows = [(1, "u", "<article><p>x</p></article>", "t"), (1, "u", "<article><p>x</p></article>", "t"), (2, None, None, "t"), (None, "u", "", "t"), (3, "u", "<article>" + "<p>w" * 20000, "t")]
    docs = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string")
    got = sorted((str(r.page_id), r.text, r.n_chars) for r in html_extract.extract(docs).collect())
    assert got == sorted([("1", "x", 1), ("1", "x", 1), ("2", "", 0), ("None", "", 0), ("3", "\n".join(["w"] * 20000), 39999)])
    assert html_extract.extract(docs.limit(0)).collect() == []


SYLLABLES = {"en": "the ing and er tion of to", "de": "sch ung keit der und ein zu", "fr": "eau oi que ment ère les ou"}


def made_up(language, seed, n=60):
    rng = random.Random(f"{language}{seed}")
    parts = SYLLABLES[language].split()
    return " ".join("".join(rng.choice(parts) for _ in range(rng.randrange(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def model(spark):
    train = spark.createDataFrame([(made_up(x, k), x) for x in SYLLABLES for k in range(40)] + [(None, "en"), ("x", None)], "text string, lang string")
    return langid.fit(train)


def test_held_out_accuracy(spark, model):
    docs = spark.createDataFrame([(k, made_up(x, 1000 + k), x) for k, x in enumerate(list(SYLLABLES) * 30)], "doc_id bigint, text string, truth string")
    got = {r.doc_id: r for r in langid.predict(docs, model).collect()}
    assert sum(got[r.doc_id].lang_pred == r.truth for r in docs.collect()) >= 88
    assert all(0 <= r.score <= 1 for r in got.values())


def test_mixture_proportions(model):
    text = made_up("de", 5, 200) + "\n" + made_up("fr", 6, 100)
    share, _, _ = model.infer(pa.array([text, made_up("en", 9, 200)]))
    by = dict(zip(model.languages, share[0], strict=True))
    assert by["de"] > by["fr"] > 0.15 and by["en"] == 0
    assert dict(zip(model.languages, share[1], strict=True))["en"] == 1


def test_prediction_edges(spark, model):
    rows = [(1, None), (2, ""), (3, "123 ..."), (4, "x"), (4, "x"), (None, made_up("de", 1)), (5, "日本語のテキスト"), (6, made_up("fr", 2) * 2000)]
    docs = spark.createDataFrame([(*r, 1.0) for r in rows], "doc_id bigint, text string, score double")
    got = langid.predict(docs, model).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert [by[k].lang_pred for k in (1, 2, 3)] == ["und"] * 3 and [by[k].score for k in (1, 2, 3)] == [0.0] * 3
    assert by[5].lang_pred in SYLLABLES and by[6].lang_pred == "fr" and by[None].lang_pred == "de"
    assert langid.predict(docs.limit(0), model).collect() == []
    assert {r.lang_pred for r in langid.predict(docs, langid.fit(spark.createDataFrame([], "text string, lang string"))).collect()} == {"und"}


def longest_common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = row
        row = [0]
        for j, y in enumerate(b):
            row.append(before[j] + 1 if x == y else max(before[j + 1], row[-1]))
    return row[-1]


def test_patience_is_a_common_subsequence():
    rng = random.Random(1)
    for _ in range(300):
        a, b = ([rng.randrange(12) for _ in range(rng.randrange(15))] for _ in range(2))
        pairs = licenses.patience(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(i < k and j < m for (i, j), (k, m) in zip(pairs, pairs[1:], strict=False))
        assert len(pairs) <= longest_common(a, b)
        distinct = list(dict.fromkeys(a))
        assert len(licenses.patience(distinct, sorted(distinct))) == longest_common(distinct, sorted(distinct))


def test_ascending_is_longest():
    rng = random.Random(2)
    for _ in range(200):
        seconds = rng.sample(range(30), rng.randrange(12))
        found = licenses.ascending(list(enumerate(seconds)))
        assert [j for _, j in found] == sorted(j for _, j in found)
        assert len(found) == longest_common(seconds, sorted(seconds))


def test_planted_licenses(documents, prose):
    rows, truth = [], set()
    for k, (name, notice) in enumerate(licenses.TEMPLATES.items()):
        rows.append((k, prose(k, 80) + "\n" + notice + "\n" + prose(100 + k, 500), "en", "s", 0))
        truth.add((k, name))
    words = licenses.TEMPLATES["mit"].split()
    rows += [(50, prose(50, 300), "en", "s", 0), (51, None, "en", "s", 0), (52, "", "en", "s", 0), (53, (licenses.TEMPLATES["mit-line"] + "\n") * 3, "en", "s", 0), (54, "\n".join(" ".join(words[j : j + 7]).upper() for j in range(0, len(words), 7)), "en", "s", 0), (55, "the license is under the license of the mit, released by the people", "en", "s", 0)]
    got = {(r.doc_id, r.license): r for r in licenses.scan_licenses(documents(rows)).collect()}
    assert truth <= set(got)
    assert all(got[t].coverage == 1.0 for t in truth)
    assert {i for i, _ in got} == {*range(len(truth)), 53, 54}
    assert got[54, "mit"].coverage == 1.0 and got[54, "mit"].first_word == 0
    assert got[0, "apache-2.0-line"].first_word == 80


def test_licenses_with_inserted_words(documents, prose):
    rows, want = [], {}
    for name, notice in licenses.TEMPLATES.items():
        words = notice.split()
        n = len(licenses.Templates({name: notice}).lists[0])
        for k in (3, 5, 10, 20):
            for at in (len(words) // 3, len(words) // 2):
                if n / (n + k) >= licenses.DENSITY:
                    want[len(rows), name] = (1.0, n / (n + k), n + k)
                    inserted = [f"zq{j}" for j in range(k)]
                    rows.append((len(rows), prose(len(rows), 200) + "\n" + " ".join(words[:at] + inserted + words[at:]) + "\n" + prose(99, 200), "en", "s", 0))
    got = {(r.doc_id, r.license): (r.coverage, r.density, r.n_words) for r in licenses.scan_licenses(documents(rows)).collect()}
    assert len(want) > 40 and {x: got.get(x) for x in want} == want


def test_regions_hold_every_span_that_can_do():
    rng = random.Random(5)
    for _ in range(300):
        length = rng.randrange(3, 30)
        need = length - (1 - licenses.COVERAGE) * length
        mine = np.flatnonzero([rng.random() < rng.choice((0.3, 0.6, 0.9)) for _ in range(rng.randrange(150))])
        found = list(licenses.regions(mine, need, length))
        for i in range(len(mine)):
            for j in range(i, len(mine)):
                if j - i + 1 >= need and mine[j] - mine[i] + 1 <= length / licenses.DENSITY:
                    assert any(a <= mine[i] and mine[j] <= b for a, b in found)


def test_families_are_told_apart(documents, prose):
    names = ["bsd-2-clause", "bsd-3-clause", "gpl-2.0-notice", "gpl-3.0-notice", "lgpl-2.1-notice", "agpl-3.0-notice", "isc", "0bsd", "cc-by-4.0-line", "cc-by-sa-4.0-line", "apache-2.0-notice", "apache-2.0-line"]
    rows = [(k, prose(k, 60) + "\n" + licenses.TEMPLATES[n] + "\n" + prose(50 + k, 60), "en", "s", 0) for k, n in enumerate(names)]
    rows.append((99, licenses.TEMPLATES["mit"] + "\n" + prose(7, 40) + "\n" + licenses.TEMPLATES["bsd-3-clause"], "en", "s", 0))
    got = sorted((r.doc_id, r.license) for r in licenses.scan_licenses(documents(rows)).collect())
    assert got == sorted([*enumerate(names), (99, "mit"), (99, "bsd-3-clause")])


def test_scan_against_every_span():
    """Whatever span of a text aligns well enough with the template, the scan reports the license."""
    rng = random.Random(12)
    hits = 0
    for _ in range(60):
        template = [f"w{rng.randrange(14)}" for _ in range(rng.randrange(8, 13))]
        known = licenses.Templates({"x": " ".join(template)})
        copy = [w for w in template if rng.random() < 0.93]
        for _ in range(rng.randrange(4)):
            copy.insert(rng.randrange(len(copy) + 1), "foreign")
        noise = lambda n: [rng.choice(("foreign", "other", "w1", "w5")) for _ in range(n)]
        text = noise(rng.randrange(12)) + copy + noise(rng.randrange(12))
        words = licenses.word_hashes(pa.array([" ".join(text)]))
        hashes = [int(x) for x in words.hash]
        want = any(licenses.enough((len(m) / len(template), len(m) / (m[-1][0] - m[0][0] + 1), 0, 0)) for i in range(len(hashes)) for j in range(i + 6, len(hashes) + 1) if (m := licenses.patience(hashes[i:j], known.lists[0])))
        got = bool(list(known.scan(pa.array([" ".join(text)]))))
        hits += want
        assert got or not want, text
    assert hits > 20


def test_licenses_edges(spark):
    docs = spark.createDataFrame([(None, licenses.TEMPLATES["isc"], "x"), (1, "Released under the MIT License.", "y"), (1, "Released under the MIT License.", "y")], "doc_id bigint, text string, license string")
    assert len([r for r in licenses.scan_licenses(docs).collect() if r.doc_id == 1]) == 2
    assert licenses.scan_licenses(docs.limit(0)).collect() == []
    assert licenses.scan_licenses(docs, templates={}).collect() == []
