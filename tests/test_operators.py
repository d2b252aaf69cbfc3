"""Edge cases of operators on small fixtures, and plans that must hold at scale."""

import datetime as dt
import time

import pytest
from pyspark.sql import functions as F

from quern.functions import net, text, vectors, web
from quern.operators import checks, intervals, joins, latest, reshape, rollups, rules

D = dt.date


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_as_of_takes_the_last_value_at_or_before(spark):
    left = spark.createDataFrame([(1, "a", 5), (2, "a", 1), (3, "b", 9), (4, None, 9)], "id int, k string, t int")
    right = spark.createDataFrame([("a", 2, 20), ("a", 5, 50), ("a", 7, 70), ("b", 10, 1)], "k string, at int, v int")
    got = {r.id: (r.at, r.v) for r in joins.as_of(left, right, ["k"], "t", "at", ["v"]).collect()}
    assert got == {1: (5, 50), 2: (None, None), 3: (None, None), 4: (None, None)}


def test_as_of_makes_no_pairs(spark):
    a, b = spark.range(10).selectExpr("id % 2 as k", "id as t"), spark.range(10).selectExpr("id % 2 as k", "id as at", "id as v")
    assert "Join" not in plan(joins.as_of(a, b, ["k"], "t", "at", ["v"]))


def test_common_date_prefers_the_past(spark):
    facts = spark.createDataFrame([(D(2024, 1, 2), "USD"), (D(2024, 1, 2), "NOK"), (D(2024, 1, 3), "USD"), (D(2024, 1, 9), "USD"), (D(2024, 1, 9), "NOK")], "d date, ccy string")
    asked = spark.createDataFrame([(D(2024, 1, 1),), (D(2024, 1, 3),), (D(2024, 1, 9),), (D(2024, 2, 1),)], "q date")
    got = {r.q.day if r.q.month == 1 else 31: r.rate_date.day for r in joins.nearest_common_date(asked, facts, "q", "d", "ccy", 2).collect()}
    assert got == {1: 2, 3: 2, 9: 9, 31: 9}


def test_intervals_merge_split_and_suppress(spark):
    rows = [("mx", "google", D(2024, 1, 1), D(2024, 1, 20), False), ("mx", "google", D(2024, 2, 8), D(2024, 3, 1), False), ("mx", "google", D(2024, 7, 1), D(2024, 7, 2), False), ("mx", "self", D(2024, 1, 10), D(2024, 1, 12), True), ("mx", "self", D(2024, 5, 1), D(2024, 5, 9), True)]
    cur = spark.createDataFrame(rows, "service string, provider string, a date, b date, fallback boolean")
    kept = intervals.uncovered(cur, ["service"], "a", "b", "fallback")
    found = intervals.islands(kept, ["service", "provider"], "a", "b", F.expr("interval 45 days"), []).groupBy("provider", "island").agg(F.min("a").alias("f"), F.max("b").alias("l"))
    assert sorted((r.provider, r.f, r.l) for r in found.collect()) == [("google", D(2024, 1, 1), D(2024, 3, 1)), ("google", D(2024, 7, 1), D(2024, 7, 2)), ("self", D(2024, 5, 1), D(2024, 5, 9))]


def test_uncovered_against_brute_force(spark):
    import random

    rng = random.Random(3)
    rows = []
    for k in range(300):
        a = rng.randrange(400)
        rows.append((k, a, a + rng.randrange(12), rng.random() < 0.6))
    got = {r.id for r in intervals.uncovered(spark.createDataFrame(rows, "id int, a int, b int, fallback boolean").withColumn("k", F.lit(1)), ["k"], "a", "b", "fallback").collect()}
    assert got == {i for i, a, b, f in rows if not f or not any(not g and x <= b and y >= a for _, x, y, g in rows)}


def test_uncovered_holds_on_one_long_history(spark):
    """A frame that is worked out anew for each row takes minutes here."""
    rows = spark.range(80_000).selectExpr("1 as k", "id as a", "id + 3 as b", "id % 5 <> 0 as fallback")
    began = time.time()
    assert intervals.uncovered(rows, ["k"], "a", "b", "fallback").count() == 16_001  # the last one reaches past all primaries
    assert time.time() - began < 20


def test_nearest_date_in_a_long_calendar(spark):
    facts = spark.range(40_000).selectExpr("date_add(date'1950-01-01', cast(id as int)) as d", "'x' as ccy")
    asked = spark.range(40_000).selectExpr("date_add(date'1949-12-01', cast(id as int)) as q")
    began = time.time()
    assert joins.nearest_common_date(asked, facts, "q", "d", "ccy", 1).where("rate_date <> greatest(q, date'1950-01-01')").count() == 0
    assert time.time() - began < 20


def test_a_tie_goes_to_the_lesser_source(spark):
    facts = spark.createDataFrame([(1, s, "w", 5.0, D(2024, 1, 1)) for s in ("abc", "ab", "b")] + [(2, "z", "w", None, None)], "c int, source string, winner string, amount double, day date")
    got = {r.c: (r.source, r.amount) for r in rollups.per_source_then_best(facts, "c", "source", [], "winner", "amount", "day").collect()}
    assert got == {1: ("ab", 5.0), 2: ("z", None)}


RULES = [("exact", "a.example.com"), ("prefix", "mail."), ("prefix", "m"), ("suffix", ".example.com"), ("suffix", "com"), ("contains", "xyz"), ("glob", "*.cdn*.net"), ("regex", "^w{3}[0-9]"), ("exists", ""), ("prefix", "A.Example.Com."), ("suffix", "net")]


def test_best_rule_against_every_pair(spark):
    table = spark.createDataFrame([(k, kind, p, (k * 7) % 5, 0.5 + 0.1 * (k % 2)) for k, (kind, p) in enumerate(RULES)], "rule_id int, kind string, pattern string, priority int, confidence double")
    values = ["a.example.com", "A.EXAMPLE.COM.", "b.example.com", "example.com", "mail.xyz.org", "x.cdn7.net", "www1.org", "", None, "m", "com", "notexample.com", "net."]
    df = spark.createDataFrame([(k, v) for k, v in enumerate(values)], "id int, host string")
    pairs = df.crossJoin(table).where(rules.matches(F.col("host"), F.col("kind"), F.col("pattern"))).collect()
    want = {}
    for r in sorted(pairs, key=lambda r: (-r.priority, -r.confidence, r.rule_id)):
        want.setdefault(r.id, r.rule_id)
    got = rules.best_rule(df, table, "host", ["id"])
    assert {r.id: r.rule_id for r in got.collect()} == {k: want.get(k) for k in range(len(values))}


def test_records_are_routed_by_type_and_place(spark):
    rows = [
        ("x.org", "A", "", "ip"), ("www.x.org", "AAAA", "", "ip"), ("mail.x.org", "A", "", None), ("x.org", "NS", "", "ns"), ("a.x.org", "NS", "", None), ("x.org", "SOA", "", "soa"), ("x.org", "MX", "", "mx"),
        ("www.x.org", "CNAME", "", "cname"), ("k._domainkey.x.org", "CNAME", "", "dkim"), ("k._domainkey.x.org", "TXT", "v=spf1 -all", "dkim"), ("_dmarc.x.org", "TXT", "v=DMARC1", "dmarc"), ("_dmarc.x.org", "CNAME", "", None),
        ("x.org", "TXT", '"v=spf1 -all"', "spf"), ("a.x.org", "TXT", "v=SPF1", "spf"), ("a.x.org", "TXT", "v=spf10", None), ("www.x.org", "TXT", "hello", None), ("x.org", "TXT", "hello", "txt"), ("_site.x.org", "TXT", "hello", "txt"),
        ("_site.a.x.org", "TXT", "v=spf1 a", "spf"), ("notx.org", "TXT", "v=spf1", None), ("_dmarc.a.x.org", "TXT", "v=DMARC1", None), ("x.org", "TXT", None, "txt"),
    ]
    df = spark.createDataFrame([(k, n, t, v) for k, (n, t, v, _) in enumerate(rows)], "id int, name string, kind string, value string")
    got = {r.id: r.a for r in df.select("id", rules.analyzer(F.col("name"), F.col("kind"), F.lit("x.org"), F.col("value")).alias("a")).collect()}
    assert got == {k: r[3] for k, r in enumerate(rows)}


def test_registrable_domains_by_a_list(spark):
    rules_ = spark.createDataFrame([(x,) for x in ("com", "kr", "co.kr", "github.io", "*.ck", "!www.ck", "*.kawasaki.jp", "!city.kawasaki.jp", "jp")], "suffix string")
    want = {"a.b.co.kr": "b.co.kr", "x.kr": "x.kr", "me.github.io": "me.github.io", "a.me.github.io.": "me.github.io", "github.io": "", "b.ck": "", "a.b.ck": "a.b.ck", "www.ck": "www.ck", "x.www.ck": "www.ck", "x.city.kawasaki.jp": "city.kawasaki.jp", "a.b.kawasaki.jp": "a.b.kawasaki.jp", "x.unknown": "x.unknown", "com": "", "A.COM": "a.com", "10.0.0.1": "", "": "", None: ""}
    hosts = spark.createDataFrame(list(enumerate(want)), "id int, host string")
    assert {r.host: r.registrable for r in net.registrable_by(hosts, "host", rules_, "suffix").collect()} == want


def test_identifiers():
    assert net.identifier("a_1") == "a_1"
    for bad in ("", "1a", "a b", "a;drop", "a" * 200, "é"):
        with pytest.raises(ValueError):
            net.identifier(bad)


def test_longest_prefix_has_no_nested_loop(spark):
    a = spark.range(100).selectExpr("id", "id + 167772160 as address")
    r = spark.createDataFrame([(167772160, 8, "x"), (167772160, 25, "y")], "network bigint, bits int, name string")
    found = joins.longest_prefix(a, r, "address", "network", "bits", [8, 25])
    assert "NestedLoop" not in plan(found) and "Cartesian" not in plan(found)
    assert {x.name for x in found.collect()} == {"y"}


def test_latest_and_latest_non_null(spark):
    rows = spark.createDataFrame([(1, 1, "a", None), (1, 2, None, 5), (2, 1, "z", None)], "k int, v int, x string, y int")
    assert {(r.k, r.v, r.x, r.y) for r in latest.latest(rows, ["k"], "v", []).collect()} == {(1, 2, None, 5), (2, 1, "z", None)}
    assert {(r.k, r.x, r.y) for r in latest.latest_non_null(rows, ["k"], ["x", "y"], F.col("v")).collect()} == {(1, "a", 5), (2, "z", None)}


def test_first_per_key_limits_before_the_shuffle(spark):
    df = latest.first_per_key(spark.range(100).selectExpr("id % 7 as k", "id as v"), ["k"], [F.col("v").desc()], 2)
    assert "WindowGroupLimit" in plan(df)


def test_json_scalars():
    assert reshape.scalars('{"a/b":{"~":[1,"x",null]},"t":true}') == [("/a~1b/~0/0", "number", "1"), ("/a~1b/~0/1", "string", "x"), ("/a~1b/~0/2", "null", "null"), ("/t", "boolean", "true")]
    assert reshape.scalars("{") == [] and reshape.scalars(None) == []


def test_rollup_tells_no_amount_from_zero(spark):
    rows = [("c1", "s1", "W2", None, 1), ("c1", "s2", "W1", 0.0, 2), ("c2", "s1", "W1", None, 3)]
    facts = spark.createDataFrame(rows, "ref string, source string, winner string, amount double, d int")
    got = {r.ref: (r.source, r.first_winner, r.amount) for r in rollups.per_source_then_best(facts, "ref", "source", [], "winner", "amount", "d").collect()}
    assert got == {"c1": ("s2", "W1", 0.0), "c2": ("s1", "W1", None)}


def test_centroids_ignore_an_outlier(spark):
    pts = spark.createDataFrame([("a", 59.0, 18.0), ("a", 59.1, 18.1), ("a", 59.05, 18.05), ("a", 0.0, 0.0), ("b", 1.0, 1.0), ("b", 1.0, 1.0)], "k string, latitude double, longitude double")
    (row,) = rollups.robust_centroids(pts, "k", 3).collect()
    assert row.k == "a" and abs(row.lat - 59.025) < 1e-9 and row.spread > 6_000_000


def test_fold_needs_a_register_name(spark):
    t = dt.datetime(2024, 1, 1)
    rows = [(1, "register", t, "u1", "Firm", ""), (1, "web", t, "u2", "Other", "x.com"), (2, "web", t, "u3", "Web only", "y.com")]
    s = spark.createDataFrame(rows, "k int, source string, observed_at timestamp, uid string, name string, site string")
    ranks = spark.createDataFrame([("name", "register", 10), ("name", "web", 90), ("site", "web", 5)], "field string, source string, rank int")
    (row,) = rollups.fold(s, "k", ["name", "site"], ranks, ["register"], "name").collect()
    assert (row.k, row["name"], row.name_source, row.site) == (1, "Other", "web", "x.com")


def test_lifecycle_and_rules(spark):
    before = spark.createDataFrame([("a", "active", "1"), ("b", "missing", "1"), ("c", "removed", "1"), ("d", "active", "1"), ("e", "active", "1")], "k string, status string, content string")
    after = spark.createDataFrame([("a", "missing", "1"), ("b", "active", "1"), ("c", "active", "1"), ("d", "active", "2"), ("f", "active", "1"), ("g", "removed", "1")], "k string, status string, content string")
    got = {r.k: r.change for r in rules.lifecycle(before, after, "k").collect()}
    assert got == {"a": "missing", "b": "reappeared", "c": "restored", "d": "updated", "e": "purged", "f": "added", "g": "removed"}


@pytest.mark.parametrize(
    ("value", "kind", "pattern", "expected"),
    [("MX1.One.com.", "suffix", "one.com", True), ("bone.com", "suffix", "one.com", False), ("one.com", "suffix", ".one.com", True), ("a.b.c", "glob", "a.*.c", True), ("a.b.d", "glob", "a.*.c", False), ("axbxc", "glob", "a.b.c", False), ("x", "exists", "", True), ("", "contains", "", False), ("Foo.bar", "regex", "^foo[.]", True), ("abc", "prefix", "AB", True), ("abc.", "exact", "abc", True)],
)
def test_rule_kinds(spark, value, kind, pattern, expected):
    (row,) = spark.createDataFrame([(value, kind, pattern)], "v string, k string, p string").select(rules.matches(F.col("v"), F.col("k"), F.col("p")).alias("m")).collect()
    assert row.m == expected


def one(spark, column, **values):
    (row,) = spark.createDataFrame([tuple(values.values())], list(values)).select(column.alias("x")).collect()
    return row.x


def test_identifiers(spark):
    assert one(spark, text.valid_lei(F.col("a")), a="5493001KJTIIGC8Y1R12") and not one(spark, text.valid_lei(F.col("a")), a="5493001KJTIIGC8Y1R13")
    assert one(spark, text.valid_vat(F.col("a")), a="DE136695976") and not one(spark, text.valid_vat(F.col("a")), a="DE136695975")
    assert one(spark, text.valid_vat(F.col("a")), a="IT00743110157") and one(spark, text.valid_vat(F.col("a")), a="NL123456789B01") and not one(spark, text.valid_vat(F.col("a")), a="XX123")
    assert one(spark, text.damerau_levenshtein("a", "b"), a="abc", b="acb") == 1
    assert one(spark, text.fold_accents("a"), a="Göteborg ÉTÉ") == "goteborg ete"
    assert one(spark, text.person_tokens("a"), a="Dr. Anna-Lena von Öst") == ["anna", "lena", "ost"]


@pytest.mark.parametrize(
    ("raw", "domain", "url"),
    [(" WWW.Example.com./a#b ", "example.com", "https://www.example.com/a"), ("//x.org", "x.org", "https://x.org"), ("HTTP://x.org:8080?q", "x.org", "http://x.org:8080?q"), ("ftp://x.org", None, None), ("x.org:99999", None, None), ("a b.org", None, None), ("localhost", None, None), ("", None, None)],
)
def test_canonical_url(spark, raw, domain, url):
    c = net.canonical_url(F.col("a"))
    assert (one(spark, c["domain"], a=raw), one(spark, c["url"], a=raw)) == (domain, url)


def test_addresses_and_domains(spark):
    assert one(spark, net.canonical_url(F.col("a"), ascii_only=False)["domain"], a="münchen.de") == "xn--mnchen-3ya.de"
    assert one(spark, net.registrable(F.col("a")), a="a.b.co.uk") == "b.co.uk" and one(spark, net.registrable(F.col("a")), a="10.0.0.1") == ""
    assert one(spark, net.cidr_last(F.col("a")), a="10.1.2.3/24") == 167838463
    assert one(spark, net.ipv6_range("a"), a="2001:db8::/32").last == "20010db8ffffffffffffffffffffffff"
    assert one(spark, net.ipv4_number(F.col("a")), a="10.0.0.256") is None and one(spark, net.ipv4_text(F.lit(167772161)), a=1) == "10.0.0.1"


def test_page_signals(spark):
    html = '<a href="https://www.linkedin.com/company/x">in</a><a href="http://netflix.com">n</a><a href="https://x.com/y">x</a><script>fbq(\'init\', \'1234567890\')</script>mail a@b.com or logo@2x.png'
    assert one(spark, web.socials(F.col("a")), a=html) == ["linkedin", "twitter"]
    assert one(spark, web.emails(F.col("a")), a=html) == ["a@b.com"]
    assert [(x.kind, x.value) for x in one(spark, web.trackers(F.col("a")), a=html)] == [("fb_pixel", "1234567890")]
    assert one(spark, web.visible_text("a"), a="<p> a <b>b</b><script>x</script>") == "a b"
    assert one(spark, web.content_text("a"), a="<nav>n</nav><p>a</p>") == "a" and one(spark, web.content_text("a"), a="<nav>n</nav>") == "n"
    head = one(spark, web.head_metadata("a"), a='<title> T </title><meta name=Description content=d><link rel=canonical href=/c><link rel=alternate hreflang=DE>')
    assert (head.title, head.description, head.canonical, head.hreflang) == ("T", "d", "/c", ["de"])


def test_knn_against_brute_force(spark):
    import numpy as np

    m = np.random.default_rng(1).normal(size=(200, 8))
    rows = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(m)], "vec_id bigint, embedding array<double>")
    unit = m / np.linalg.norm(m, axis=1, keepdims=True)
    got = {}
    for r in vectors.nearest(rows.where("vec_id < 20"), rows, 5, id_col="vec_id", vector_col="embedding").collect():
        got.setdefault(r.query_id, []).append((r.nth, r.id))
    for q in range(20):
        cosine = unit @ unit[q]
        cosine[q] = -2
        assert [i for _, i in sorted(got[q])] == np.argsort(-cosine)[:5].tolist()


def test_checks(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (2, "b")], "k int, v string")
    got = {r.check: r.failures for r in checks.all_of(checks.unique(df, ["k"]), checks.not_null(df, "v"), checks.not_empty(df), checks.at_least(df, 9), checks.accepted(df, "v", ["a"])).collect()}
    assert got == {"unique": 1, "not_null_v": 1, "not_empty": 0, "at_least": 1, "accepted_v": 1}
    with pytest.raises(Exception, match="no v"):
        checks.require(df, F.col("v").isNotNull(), "no v").collect()
