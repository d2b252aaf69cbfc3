"""Domain algorithms and further queries over the evaluation tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geo, net, text, vectors
from ..operators import intervals, joins, latest, rollups, rules
from .catalog import Tables, query
from .relational import _LINKS, links, total

# Scalars


@query("f02_haversine", "SELECT a.n_nationkey AS a, b.n_nationkey AS b, round(2 * 6371000 * asin(sqrt(pow(sin(radians(a.n_nationkey - b.n_nationkey) / 2), 2) + cos(radians(a.n_nationkey)) * cos(radians(b.n_nationkey)) * pow(sin(radians(a.n_regionkey - b.n_regionkey) / 2), 2))), 3) AS metres FROM nation a JOIN nation b ON a.n_regionkey = b.n_regionkey AND a.n_nationkey < b.n_nationkey")
def _(t: Tables) -> DataFrame:
    a, b = t.nation.alias("a"), t.nation.alias("b")
    pairs = a.join(b, (F.col("a.n_regionkey") == F.col("b.n_regionkey")) & (F.col("a.n_nationkey") < F.col("b.n_nationkey")))
    return pairs.select(F.col("a.n_nationkey").alias("a"), F.col("b.n_nationkey").alias("b"), F.round(geo.haversine(F.col("a.n_nationkey"), F.col("a.n_regionkey"), F.col("b.n_nationkey"), F.col("b.n_regionkey")), 3).alias("metres"))


@query("f03_damerau", "SELECT p_partkey, CAST(damerau_levenshtein(p_name, p_brand) AS BIGINT) AS d FROM part")
def _(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", text.damerau_levenshtein("p_name", "p_brand").alias("d"))


@query("f04_cidr_bounds", "SELECT n_nationkey, (n_nationkey * 16777216 + 65536) // (1 << (32 - (8 + n_regionkey * 4))) * (1 << (32 - (8 + n_regionkey * 4))) AS first, (n_nationkey * 16777216 + 65536) // (1 << (32 - (8 + n_regionkey * 4))) * (1 << (32 - (8 + n_regionkey * 4))) + (1 << (32 - (8 + n_regionkey * 4))) - 1 AS last FROM (SELECT CAST(n_nationkey AS BIGINT) AS n_nationkey, CAST(n_regionkey AS BIGINT) AS n_regionkey FROM nation)")
def _(t: Tables) -> DataFrame:
    cidr = F.concat(F.col("n_nationkey").cast("string"), F.lit(".1.0.0/"), (8 + F.col("n_regionkey") * 4).cast("string"))
    return t.nation.select(F.col("n_nationkey").cast("bigint").alias("n_nationkey"), net.cidr_first(cidr).alias("first"), net.cidr_last(cidr).alias("last"))


@query("f06_registrable_domain", "SELECT page_id, regexp_extract(lower(url), '^[a-z]+://[^/?#:]*?([a-z0-9-]+\\.[a-z]+)(?:[/?#:]|$)', 1) AS domain FROM pages")
def _(t: Tables) -> DataFrame:
    return t.pages.select("page_id", net.registrable(net.host_of(F.col("url"))).alias("domain"))


SUFFIXES = ["org", "com", "net", "example.com", "*.example.net", "!blog.ththan.example.net"]
_NAMED = "lower(regexp_extract(url, '^[a-z]+://([^/?#:]*)', 1))"


@query(
    "f07_registrable_by_list",
    f"""WITH h AS (SELECT DISTINCT {_NAMED} AS host, string_split({_NAMED}, '.') AS part FROM pages), r AS (SELECT unnest({SUFFIXES}) AS rule),
    w AS (SELECT host, n, array_to_string(part[-n:], '.') AS own, '*.' || array_to_string(part[-n + 1:], '.') AS star FROM (SELECT host, part, unnest(range(1, len(part) + 1)) AS n FROM h)),
    f AS (SELECT host, max(CASE WHEN rule = '!' || own THEN n - 1 END) AS exempt, max(CASE WHEN rule = own OR (n > 1 AND rule = star) THEN n END) AS longest FROM w JOIN r ON rule IN (own, '!' || own) OR (n > 1 AND rule = star) GROUP BY 1),
    g AS (SELECT h.host AS host, part, coalesce(exempt, longest, 1) AS n FROM h LEFT JOIN f ON f.host = h.host)
    SELECT page_id, CASE WHEN len(part) > n THEN array_to_string(part[-n - 1:], '.') ELSE '' END AS registrable FROM pages JOIN g ON g.host = {_NAMED}""",
)
def _(t: Tables) -> DataFrame:
    suffixes = t.spark.createDataFrame([(x,) for x in SUFFIXES], "suffix string")
    return net.registrable_by(t.pages.select("page_id", net.host_of(F.col("url")).alias("host")), "host", suffixes, "suffix").select("page_id", "registrable")


@query("f08_squash_key", "SELECT p_partkey, lower(regexp_replace(p_brand, '[^\\p{L}\\p{N}]', '', 'g')) AS k, regexp_replace(p_brand, '[^0-9]', '', 'g') AS digits, upper(trim(p_name)) AS city FROM part")
def _(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", text.squash_key(F.col("p_brand")).alias("k"), text.digits(F.col("p_brand")).alias("digits"), text.city_key(F.col("p_name")).alias("city"))


@query("f10_fold_accents", "SELECT doc_id, replace(lower(strip_accents(text)), 'ß', 'ss') AS folded FROM documents")
def _(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", text.fold_accents("text").alias("folded"))


@query("f11_md5_identity", "SELECT c_custkey, CAST('0x' || substr(md5(c_name), 1, 15) AS BIGINT) AS id FROM customer")
def _(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey", text.md5_number(F.col("c_name")).alias("id"))


@query("f12_rounded_months", "SELECT o_orderkey, CAST(round((date_diff('day', CAST(o_orderdate AS DATE), DATE '2000-01-01') + 1) / 30.4375) AS BIGINT) AS months FROM orders")
def _(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", text.rounded_months(F.to_date("o_orderdate"), F.lit("2000-01-01").cast("date")).alias("months"))


@query("f13_money_scale", "SELECT l_orderkey, l_linenumber, CAST(CAST(l_quantity * CASE l_returnflag WHEN 'A' THEN 1000 WHEN 'N' THEN 1 ELSE 1000000 END AS DECIMAL(18,2)) AS DOUBLE) AS amount FROM lineitem")
def _(t: Tables) -> DataFrame:
    scale = F.element_at(F.create_map(F.lit("A"), F.lit(1000), F.lit("N"), F.lit(1), F.lit("R"), F.lit(1_000_000)), F.col("l_returnflag"))
    return t.lineitem.select("l_orderkey", "l_linenumber", (F.col("l_quantity") * scale).cast("decimal(18,2)").cast("double").alias("amount"))


# Vectors

_DOT = "list_dot_product(CAST({0} AS DOUBLE[]), CAST({1} AS DOUBLE[]))"


@query("d15_normalised_dot", "SELECT vec_id, round(list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[])), 6) AS square FROM embeddings")
def _(t: Tables) -> DataFrame:
    e = F.col("embedding")
    return t.embeddings.select("vec_id", F.round(vectors.dot(e, e), 6).alias("square"))


@query(
    "o06_knn",
    "SELECT query_id, id, nth FROM (SELECT q.vec_id AS query_id, r.vec_id AS id, row_number() OVER (PARTITION BY q.vec_id ORDER BY round(list_cosine_similarity(CAST(q.embedding AS DOUBLE[]), CAST(r.embedding AS DOUBLE[])), 9) DESC, r.vec_id) AS nth FROM embeddings q JOIN embeddings r ON q.vec_id <> r.vec_id WHERE q.vec_id % 50 = 0) WHERE nth <= 5",
)
def _(t: Tables) -> DataFrame:
    return vectors.nearest(t.embeddings.where("vec_id % 50 = 0"), t.embeddings, 5, id_col="vec_id", vector_col="embedding").select("query_id", "id", "nth")


def prototypes(t: Tables) -> DataFrame:
    """The mean unit vector of each label, renormalised."""
    unit = t.embeddings.select("label", F.posexplode(vectors.normalised(F.col("embedding"))).alias("i", "x"))
    mean = unit.groupBy("label", "i").agg(F.avg("x").alias("x"))
    return mean.groupBy("label").agg(F.array_sort(F.collect_list(F.struct("i", "x"))).alias("v")).select("label", vectors.normalised(F.transform("v", lambda p: p["x"])).alias("v"))


def classified(t: Tables) -> DataFrame:
    return vectors.classify(t.embeddings, prototypes(t), id_col="vec_id", vector_col="embedding", code_col="label", reference_col="v")


_RANKED = """u AS (SELECT vec_id, label, list_transform(e, lambda x: x / sqrt(list_dot_product(e, e))) AS v FROM (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings)),
    p AS (SELECT label, list(x ORDER BY i) AS m FROM (SELECT label, i, avg(v[i]) AS x FROM (SELECT label, v, unnest(range(1, len(v) + 1)) AS i FROM u) GROUP BY 1, 2) GROUP BY 1),
    r AS (SELECT label AS code, list_transform(m, lambda x: x / sqrt(list_dot_product(m, m))) AS w FROM p),
    s AS (SELECT vec_id, code, round(list_dot_product(v, w), 9) AS score FROM u, r),
    k AS (SELECT vec_id, list(code ORDER BY score DESC, code) AS codes, list(score ORDER BY score DESC, code) AS scores FROM s GROUP BY 1)"""


@query("d13_vector_classification", f"WITH {_RANKED} SELECT vec_id, codes[1] AS code, round(scores[1] - scores[2], 6) AS margin, scores[1] - scores[2] >= 0.03 OR len(list_distinct(list_transform(codes[1:3], lambda x: x // 10))) = 1 AS confident, array_to_string(codes[1:3], ',') AS top3 FROM k")
def _(t: Tables) -> DataFrame:
    consensus = F.size(F.array_distinct(F.transform("top", lambda x: F.floor(x["code"] / 10)))) == 1
    return classified(t).select("vec_id", F.col("top")[0]["code"].alias("code"), F.round("margin", 6).alias("margin"), ((F.col("margin") >= 0.03) | consensus).alias("confident"), F.array_join(F.transform("top", lambda x: x["code"].cast("string")), ",").alias("top3"))


@query(
    "d14_robust_confidence",
    f"""WITH {_RANKED}, a AS (SELECT vec_id, scores, list_median(scores) AS middle FROM k), b AS (SELECT *, greatest(list_median(list_transform(scores, lambda x: abs(x - middle))), 0.000001) AS spread FROM a)
    SELECT vec_id, round(1 / list_sum(list_transform(scores[1:10], lambda x: exp((x - scores[1]) / spread))), 6) AS confidence FROM b""",
)
def _(t: Tables) -> DataFrame:
    return classified(t).select("vec_id", F.round("confidence", 6).alias("confidence"))


@query("d17_quantisation", "WITH q AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e, list_max(list_transform(CAST(embedding AS DOUBLE[]), lambda x: abs(x))) / 127 AS s FROM embeddings) SELECT vec_id, round(list_cosine_similarity(e, list_transform(e, lambda x: round(x / s) * s)), 6) AS agreement FROM q")
def _(t: Tables) -> DataFrame:
    q = t.embeddings.withColumn("q", vectors.quantised(F.col("embedding")))
    return q.select("vec_id", F.round(vectors.dot(vectors.normalised(F.col("embedding")), vectors.normalised(vectors.restored(F.col("q")))), 6).alias("agreement"))


# Versions, pages, rules


@query("d19_version_choice", "WITH v AS (SELECT user_id, CAST(event_id % 7 AS VARCHAR) || '.' || CAST(event_id % 13 AS VARCHAR) || CASE WHEN event_id % 3 = 0 THEN '.' || CAST(event_id % 5 AS VARCHAR) ELSE '' END AS version FROM events) SELECT user_id, version FROM (SELECT DISTINCT user_id, version FROM v) QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY len(string_split(version, '.')) DESC, list_transform(string_split(version, '.'), lambda x: CAST(x AS INTEGER)) DESC, version) = 1")
def _(t: Tables) -> DataFrame:
    e = F.col("event_id")
    version = F.concat((e % 7).cast("string"), F.lit("."), (e % 13).cast("string"), F.when(e % 3 == 0, F.concat(F.lit("."), (e % 5).cast("string"))).otherwise(""))
    return latest.first_per_key(t.events.select("user_id", version.alias("version")).distinct(), ["user_id"], [text.version_rank(F.col("version")).desc(), F.col("version")])


@query(
    "d20_page_selection",
    """WITH p AS (SELECT page_id, url, regexp_extract(url, '^[a-z]+://([^/?#:]*)', 1) AS host, coalesce(nullif(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), ''), '/') AS path FROM pages),
    r AS (SELECT *, array_to_string(list_slice(string_split(host, '.'), -2, -1), '.') AS root FROM p)
    SELECT root, page_id, nth FROM (SELECT root, page_id, row_number() OVER (PARTITION BY root ORDER BY CASE WHEN host = root OR host = 'www.' || root THEN 0 ELSE 1 END, CASE WHEN path = '/' THEN 0 ELSE 1 END, CASE WHEN regexp_matches(path, '/(en|about|contact)') THEN 0 ELSE 1 END,
      length(path) - length(replace(path, '/', '')), length(path), url, page_id) AS nth FROM r) WHERE nth <= 3""",
)
def _(t: Tables) -> DataFrame:
    host = net.host_of(F.col("url"))
    path = F.regexp_extract("url", r"^[A-Za-z]+://[^/?#]*([^?#]*)", 1)
    pages = t.pages.select("page_id", "url", host.alias("host"), F.when(path == "", "/").otherwise(path).alias("path")).withColumn("root", net.registrable(F.col("host")))
    main = (F.col("host") == F.col("root")) | (F.col("host") == F.concat(F.lit("www."), F.col("root")))
    order = [(~main).cast("int"), (F.col("path") != "/").cast("int"), (~F.col("path").rlike("/(en|about|contact)")).cast("int"), F.length("path") - F.length(F.replace("path", F.lit("/"), F.lit(""))), F.length("path"), F.col("url"), F.col("page_id")]
    w = Window.partitionBy("root").orderBy(*order)
    return pages.withColumn("nth", F.row_number().over(w).cast("bigint")).where("nth <= 3").select("root", "page_id", "nth")


@query("d21_url_canonical", "SELECT page_id, regexp_replace(regexp_extract(url, '^[a-z]+://([^/?#:]*)', 1), '^www\\.', '') AS domain, regexp_replace(url, '#.*$', '') AS url FROM pages")
def _(t: Tables) -> DataFrame:
    c = net.canonical_url(F.col("url"))
    return t.pages.select("page_id", c["domain"].alias("domain"), c["url"].alias("url"))


_RULES = [("r1", "suffix", "example.com", 10, 0.9), ("r2", "prefix", "blog.", 10, 0.8), ("r3", "contains", "th", 1, 0.5), ("r4", "glob", "m.*.example.net", 20, 0.7), ("r5", "exact", "thther.example.org", 30, 1.0), ("r6", "exists", "", 0, 0.1), ("r7", "regex", "^[a-z]+\\.example\\.org$", 5, 0.6)]


@query(
    "d22_d23_best_rule",
    """WITH h AS (SELECT page_id, lower(regexp_extract(url, '^[a-z]+://([^/?#:]*)', 1)) AS host FROM pages),
    m AS (SELECT page_id, CASE WHEN host = 'thther.example.org' THEN 'r5' WHEN regexp_matches(host, '^m\\..*\\.example\\.net$') THEN 'r4' WHEN host = 'example.com' OR ends_with(host, '.example.com') THEN 'r1' WHEN starts_with(host, 'blog.') THEN 'r2' WHEN regexp_matches(host, '^[a-z]+\\.example\\.org$') THEN 'r7' WHEN contains(host, 'th') THEN 'r3' ELSE 'r6' END AS rule_id FROM h)
    SELECT page_id, rule_id FROM m""",
)
def _(t: Tables) -> DataFrame:
    table = t.spark.createDataFrame(_RULES, "rule_id string, kind string, pattern string, priority int, confidence double")
    hosts = t.pages.select("page_id", net.host_of(F.col("url")).alias("host"))
    return rules.best_rule(hosts, table, "host", ["page_id"]).select("page_id", "rule_id")


def dns_records(t: Tables) -> DataFrame:
    """DNS records made from events: names, types and values by the event's number."""
    e, root = F.col("event_id"), F.concat(F.lit("d"), (F.col("user_id") % 50).cast("string"), F.lit(".example"))
    kinds = ["NS", "SOA", "MX", "CNAME", "TXT", "A", "AAAA", "TXT"]
    places = ["", "www.", "_dmarc.", "k1._domainkey.", "_spf.", "mail."]
    values = ['"v=spf1 include:spf.mailhost.net include:x.d1.example ip4:10.0.0.0/8 a mx -all"', "v=DMARC1; p=none; rua=mailto:agg@reports.net!10m,mailto:own@d1.example", "hello", "v=spf1 exists:%{i}.spf.host.org redirect=_spf.other.org"]
    pick = lambda options, by: F.element_at(F.array(*[F.lit(o) for o in options]), (by % len(options) + 1).cast("int"))
    return t.events.select(e.alias("record_id"), root.alias("root"), F.concat(pick(places, e), root).alias("name"), pick(kinds, F.floor(e / 6)).alias("kind"), pick(values, F.floor(e / 48)).alias("value"))


_DNS = """(SELECT event_id AS record_id, 'd' || (user_id % 50) || '.example' AS root, ['', 'www.', '_dmarc.', 'k1._domainkey.', '_spf.', 'mail.'][event_id % 6 + 1] || 'd' || (user_id % 50) || '.example' AS name,
    ['NS', 'SOA', 'MX', 'CNAME', 'TXT', 'A', 'AAAA', 'TXT'][(event_id // 6) % 8 + 1] AS kind, event_id % 6 AS place, (event_id // 48) % 4 AS v FROM events)"""


@query(
    "d24_record_routing",
    f"""SELECT record_id, CASE WHEN kind = 'NS' AND place = 0 THEN 'ns' WHEN kind = 'SOA' AND place = 0 THEN 'soa' WHEN kind = 'MX' AND place = 0 THEN 'mx' WHEN kind IN ('CNAME', 'TXT') AND place = 3 THEN 'dkim' WHEN kind = 'CNAME' AND place IN (0, 1) THEN 'cname'
    WHEN kind IN ('A', 'AAAA') AND place IN (0, 1) THEN 'ip' WHEN kind = 'TXT' AND place = 2 THEN 'dmarc' WHEN kind = 'TXT' AND v IN (0, 3) THEN 'spf' WHEN kind = 'TXT' AND place = 0 THEN 'txt' WHEN kind = 'TXT' AND place = 4 THEN 'txt' END AS analyzer FROM {_DNS}""",
)
def _(t: Tables) -> DataFrame:
    r = dns_records(t)
    return r.select("record_id", rules.analyzer(F.col("name"), F.col("kind"), F.col("root"), F.col("value")).alias("analyzer"))


@query(
    "d25_host_labels",
    """WITH h AS (SELECT page_id, lower(regexp_extract(url, '^[a-z]+://([^/?#:]*)', 1)) AS host FROM pages), k AS (SELECT *, array_to_string(list_slice(string_split(host, '.'), -2, -1), '.') AS key FROM h)
    SELECT page_id, CASE WHEN starts_with(host, 'blog.') THEN 'blogger' WHEN key = 'example.net' THEN 'self' WHEN key = 'example.com' THEN 'comhost' ELSE key END AS provider, CASE WHEN starts_with(host, 'blog.') THEN 0.95 WHEN key = 'example.net' THEN 0.8 WHEN key = 'example.com' THEN 0.7 ELSE 0.3 END AS confidence FROM k""",
)
def _(t: Tables) -> DataFrame:
    """Rule, then the site's own domain, then a known provider key, then the bare key."""
    hosts = t.pages.select("page_id", net.host_of(F.col("url")).alias("host")).withColumn("key", net.registrable(F.col("host")))
    table = t.spark.createDataFrame([("b", "prefix", "blog.", 1, 0.95, "blogger")], "rule_id string, kind string, pattern string, priority int, confidence double, provider string")
    known = t.spark.createDataFrame([("example.com", "comhost")], "key string, slug string")
    ruled = rules.best_rule(hosts, table, "host", ["page_id"]).join(F.broadcast(known), "key", "left")
    own = F.col("key") == "example.net"
    return ruled.select("page_id", F.coalesce("provider", F.when(own, "self"), "slug", "key").alias("provider"), F.coalesce("confidence", F.when(own, 0.8), F.when(F.col("slug").isNotNull(), 0.7), F.lit(0.3)).alias("confidence"))


@query(
    "d26_spf_dmarc",
    f"SELECT record_id, CASE v WHEN 0 THEN 4 WHEN 3 THEN 2 ELSE 0 END AS lookups, CASE WHEN v = 3 THEN 'spf_macro' WHEN v = 0 AND root = 'd1.example' THEN 'spf_include_within_domain' ELSE '' END AS findings, CASE WHEN v <> 1 THEN NULL WHEN root = 'd1.example' THEN 'reports.net' ELSE 'reports.net,d1.example' END AS reports FROM {_DNS}",
)
def _(t: Tables) -> DataFrame:
    r, v, root = dns_records(t), F.col("value"), F.col("root")
    spf = F.regexp_like(v, F.lit("(?i)v=spf1"))
    return r.select("record_id", F.when(spf, rules.spf_lookups(v)).otherwise(0).alias("lookups"), F.when(spf, F.array_join(rules.spf_findings(v, root), ",")).otherwise("").alias("findings"), F.array_join(rules.dmarc_hosts(v, root), ",").alias("reports"))


@query("d27_validity_windows", "WITH s AS (SELECT user_id % 20 AS feed, event_type AS item, min(CAST(ts AS DATE)) AS first, max(CAST(ts AS DATE)) AS last FROM events GROUP BY 1, 2), f AS (SELECT *, min(first) OVER (PARTITION BY feed) AS f0, max(last) OVER (PARTITION BY feed) AS l0 FROM s) SELECT feed, item, CASE WHEN first > f0 THEN CAST(first AS VARCHAR) END AS valid_from, CASE WHEN last < l0 THEN CAST(last AS VARCHAR) END AS valid_to FROM f")
def _(t: Tables) -> DataFrame:
    seen = t.events.groupBy((F.col("user_id") % 20).alias("feed"), F.col("event_type").alias("item")).agg(F.min(F.to_date("ts")).alias("first"), F.max(F.to_date("ts")).alias("last"))
    w = Window.partitionBy("feed")
    bounds = seen.withColumn("f0", F.min("first").over(w)).withColumn("l0", F.max("last").over(w))
    return bounds.select("feed", "item", F.when(F.col("first") > F.col("f0"), F.col("first").cast("string")).alias("valid_from"), F.when(F.col("last") < F.col("l0"), F.col("last").cast("string")).alias("valid_to"))


@query(
    "d28_lifecycle_diff",
    """WITH b AS (SELECT o_orderkey AS k, CASE o_orderkey % 3 WHEN 0 THEN 'active' WHEN 1 THEN 'missing' ELSE 'removed' END AS status, o_custkey % 2 AS c FROM orders WHERE o_orderkey % 5 <> 0),
    a AS (SELECT o_orderkey AS k, CASE o_orderkey % 4 WHEN 0 THEN 'missing' WHEN 1 THEN 'removed' ELSE 'active' END AS status, o_custkey % 3 AS c FROM orders WHERE o_orderkey % 7 <> 0)
    SELECT coalesce(a.k, b.k) AS k, CASE WHEN a.k IS NULL THEN 'purged' WHEN b.k IS NULL AND a.status = 'removed' THEN 'removed' WHEN b.k IS NULL THEN 'added' WHEN b.status <> 'missing' AND a.status = 'missing' THEN 'missing' WHEN b.status = 'missing' AND a.status = 'active' THEN 'reappeared'
      WHEN b.status = 'removed' AND a.status = 'active' THEN 'restored' WHEN b.status <> 'removed' AND a.status = 'removed' THEN 'removed' WHEN a.c <> b.c THEN 'updated' END AS change FROM a FULL JOIN b ON a.k = b.k WHERE change IS NOT NULL""",
)
def _(t: Tables) -> DataFrame:
    k = F.col("o_orderkey")
    b = t.orders.where(k % 5 != 0).select(k.alias("k"), F.when(k % 3 == 0, "active").when(k % 3 == 1, "missing").otherwise("removed").alias("status"), (F.col("o_custkey") % 2).alias("content"))
    a = t.orders.where(k % 7 != 0).select(k.alias("k"), F.when(k % 4 == 0, "missing").when(k % 4 == 1, "removed").otherwise("active").alias("status"), (F.col("o_custkey") % 3).alias("content"))
    return rules.lifecycle(b, a, "k")


def suggestions(t: Tables) -> DataFrame:
    """Several sources' opinions on a customer, made from its orders."""
    source = F.element_at(F.array(*[F.lit(s) for s in ("register", "web", "reviewer", "other")]), (F.col("o_orderkey") % 4 + 1).cast("int"))
    return t.orders.select(F.col("o_custkey").alias("company"), source.alias("source"), F.col("o_orderdate").alias("observed_at"), F.col("o_orderkey").alias("uid"), F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderpriority")).alias("name"), F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderstatus")).otherwise("").alias("status"))


_RANKS = [("name", "register", 100), ("name", "reviewer", 200), ("name", "web", 10), ("status", "web", 50), ("status", "register", 20), ("status", "other", 50)]


@query(
    "d29_source_fold",
    """WITH s AS (SELECT o_custkey AS company, ['register', 'web', 'reviewer', 'other'][o_orderkey % 4 + 1] AS source, o_orderdate AS tm, o_orderkey AS uid, CASE WHEN o_orderkey % 5 <> 0 THEN o_orderpriority END AS name, CASE WHEN o_orderkey % 3 <> 0 THEN o_orderstatus END AS status FROM orders),
    l AS (SELECT company, source, tm, uid, 'name' AS field, name AS value FROM s UNION ALL SELECT company, source, tm, uid, 'status', status FROM s),
    r(field, source, rank) AS (VALUES ('name', 'register', 100), ('name', 'reviewer', 200), ('name', 'web', 10), ('status', 'web', 50), ('status', 'register', 20), ('status', 'other', 50)),
    b AS (SELECT company, l.field, value, l.source FROM l JOIN r ON l.field = r.field AND l.source = r.source WHERE value IS NOT NULL QUALIFY row_number() OVER (PARTITION BY company, l.field ORDER BY rank DESC, tm DESC, uid) = 1)
    SELECT company, max(value) FILTER (field = 'name') AS name, coalesce(max(source) FILTER (field = 'name'), '') AS name_source, max(value) FILTER (field = 'status') AS status, coalesce(max(source) FILTER (field = 'status'), '') AS status_source
    FROM b WHERE company IN (SELECT company FROM s WHERE source = 'register' AND name IS NOT NULL) GROUP BY company""",
)
def _(t: Tables) -> DataFrame:
    ranks = t.spark.createDataFrame(_RANKS, "field string, source string, rank int")
    return rollups.fold(suggestions(t), "company", ["name", "status"], ranks, ["register"], "name")


@query(
    "d30_primary_choice",
    """WITH c AS (SELECT o_custkey AS company, o_orderpriority AS site, count(DISTINCT o_orderstatus) AS supporting, bool_or(o_orderstatus = 'P') AS claimed, max(o_totalprice) AS confidence FROM orders GROUP BY 1, 2)
    SELECT company, site, row_number() OVER (PARTITION BY company ORDER BY supporting DESC, claimed DESC, confidence DESC, site) = 1 AS is_primary FROM c""",
)
def _(t: Tables) -> DataFrame:
    per = t.orders.groupBy(F.col("o_custkey").alias("company"), F.col("o_orderpriority").alias("site")).agg(F.countDistinct("o_orderstatus").alias("supporting"), F.bool_or(F.col("o_orderstatus") == "P").alias("claimed"), F.max("o_totalprice").alias("confidence"))
    w = Window.partitionBy("company").orderBy(F.col("supporting").desc(), F.col("claimed").desc(), F.col("confidence").desc(), "site")
    return per.select("company", "site", (F.row_number().over(w) == 1).alias("is_primary"))


@query(
    "d31_changed_fields",
    "SELECT coalesce(a.c_custkey, b.c_custkey) AS c_custkey, CASE WHEN b.c_custkey IS NULL THEN 'created' WHEN a.c_custkey IS NULL THEN 'removed' ELSE 'updated' END AS change_kind, concat_ws(',', CASE WHEN a.n IS DISTINCT FROM b.n THEN 'n' END, CASE WHEN a.s IS DISTINCT FROM b.s THEN 's' END) AS changed FROM (SELECT c_custkey, c_nationkey % 5 AS n, c_mktsegment AS s FROM customer WHERE c_custkey % 9 <> 0) a FULL JOIN (SELECT c_custkey, c_nationkey % 4 AS n, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment ELSE 'X' END AS s FROM customer WHERE c_custkey % 11 <> 0) b ON a.c_custkey = b.c_custkey WHERE changed <> ''",
)
def _(t: Tables) -> DataFrame:
    k = F.col("c_custkey")
    after = t.customer.where(k % 9 != 0).select(k, (F.col("c_nationkey") % 5).alias("n"), F.col("c_mktsegment").alias("s"))
    before = t.customer.where(k % 11 != 0).select(k, (F.col("c_nationkey") % 4).alias("n"), F.when(k % 2 == 0, F.col("c_mktsegment")).otherwise("X").alias("s"))
    return rollups.changed_fields(before, after, "c_custkey", ["n", "s"]).withColumn("changed", F.array_join("changed", ","))


@query(
    "d32_state_changes",
    "WITH b AS (SELECT l_orderkey AS k, string_agg(CAST(l_partkey AS VARCHAR), ',' ORDER BY l_partkey) AS s FROM lineitem WHERE l_orderkey % 7 <> 0 GROUP BY 1), a AS (SELECT l_orderkey AS k, string_agg(CAST(l_partkey AS VARCHAR), ',' ORDER BY l_partkey) AS s FROM lineitem WHERE l_orderkey % 11 <> 0 AND l_linenumber < 6 GROUP BY 1) SELECT coalesce(a.k, b.k) AS k, CASE WHEN b.k IS NULL THEN 'new' WHEN a.k IS NULL THEN 'tombstone' ELSE 'changed' END AS change FROM a FULL JOIN b ON a.k = b.k WHERE a.s IS DISTINCT FROM b.s",
)
def _(t: Tables) -> DataFrame:
    rows = t.lineitem.withColumnRenamed("l_orderkey", "k")
    before = rollups.state_hash(rows.where("k % 7 <> 0"), "k", ["l_partkey"])
    after = rollups.state_hash(rows.where("k % 11 <> 0 and l_linenumber < 6"), "k", ["l_partkey"])
    return rollups.state_changes(before, after, "k")


@query(
    "d33_d34_person_groups",
    """WITH p AS (SELECT 'supplier' AS source, 'Dr. ' || s_name AS name FROM supplier UNION ALL SELECT 'customer', c_name FROM customer),
    n AS (SELECT *, list_sort(list_distinct(list_filter(string_split(lower(regexp_replace(name, '[^A-Za-z]', ' ', 'g')), ' '), lambda x: x NOT IN ('', 'dr')))) AS tokens FROM p),
    g AS (SELECT source, tokens, arg_max(name, (length(name), name)) AS name, count(*) AS rows FROM n GROUP BY 1, 2) SELECT source, array_to_string(tokens, ' ') AS tokens, name, rows, count(*) OVER (PARTITION BY tokens) >= 2 AS in_scope FROM g""",
)
def _(t: Tables) -> DataFrame:
    people = t.supplier.select(F.col("s_suppkey").alias("id"), F.lit("supplier").alias("source"), F.concat(F.lit("Dr. "), "s_name").alias("name")).unionByName(t.customer.select(F.col("c_custkey").alias("id"), F.lit("customer").alias("source"), F.col("c_name").alias("name")))
    tokens = people.withColumn("tokens", text.person_tokens("name"))
    groups = tokens.groupBy("source", "tokens").agg(F.max_by("name", F.struct(F.length("name"), "name")).alias("name"), F.count("*").alias("rows"))
    return groups.withColumn("in_scope", F.count("*").over(Window.partitionBy("tokens")) >= 2).withColumn("tokens", F.array_join("tokens", " "))


@query("d35_match_gap", "SELECT DISTINCT least(a.c_custkey, b.c_custkey) AS a, greatest(a.c_custkey, b.c_custkey) AS b FROM customer a JOIN customer b ON a.c_nationkey = b.c_nationkey AND a.c_mktsegment = b.c_mktsegment AND a.c_custkey < b.c_custkey WHERE NOT EXISTS (SELECT 1 FROM orders o JOIN orders p ON o.o_orderpriority = p.o_orderpriority AND o.o_orderdate = p.o_orderdate WHERE o.o_custkey = a.c_custkey AND p.o_custkey = b.c_custkey)")
def _(t: Tables) -> DataFrame:
    return joins.pairs_apart(t.customer, t.orders, ["c_nationkey", "c_mktsegment"], "c_custkey", ["o_orderpriority", "o_orderdate"], "o_custkey")


@query(
    "d36_robust_centroids",
    """WITH p AS (SELECT CAST(c_nationkey AS VARCHAR) AS k, 50 + (c_custkey % 100) / 100.0 AS latitude, 10 + (c_custkey % 37) / 37.0 AS longitude FROM customer), c AS (SELECT k, median(latitude) AS lat, median(longitude) AS lon, count(*) AS points FROM p GROUP BY 1 HAVING count(*) >= 3)
    SELECT p.k AS k, points, round(lat, 6) AS lat, round(lon, 6) AS lon, round(max(2 * 6371000 * asin(sqrt(pow(sin(radians(latitude - lat) / 2), 2) + cos(radians(latitude)) * cos(radians(lat)) * pow(sin(radians(longitude - lon) / 2), 2)))), 2) AS spread FROM p JOIN c ON p.k = c.k GROUP BY p.k, points, lat, lon""",
)
def _(t: Tables) -> DataFrame:
    points = t.customer.select(F.col("c_nationkey").cast("string").alias("k"), (50 + (F.col("c_custkey") % 100) / F.lit(100.0)).alias("latitude"), (10 + (F.col("c_custkey") % 37) / F.lit(37.0)).alias("longitude"))
    return rollups.robust_centroids(points, "k", 3).select("k", "points", F.round("lat", 6).alias("lat"), F.round("lon", 6).alias("lon"), F.round("spread", 2).alias("spread"))


@query("d37_mismatch_reasons", "SELECT o_orderkey, CASE WHEN c_custkey IS NULL THEN 'no_customer' WHEN c_acctbal < 0 THEN 'blocked' WHEN o_totalprice > 300000 THEN 'large' WHEN o_orderstatus = 'P' THEN 'partial' ELSE 'ok' END AS reason FROM orders LEFT JOIN customer ON o_custkey = c_custkey")
def _(t: Tables) -> DataFrame:
    joined = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"), "left")
    return joined.select("o_orderkey", F.when(F.col("c_custkey").isNull(), "no_customer").when(F.col("c_acctbal") < 0, "blocked").when(F.col("o_totalprice") > 300000, "large").when(F.col("o_orderstatus") == "P", "partial").otherwise("ok").alias("reason"))


_FX = "(SELECT CAST(o_orderdate AS DATE) AS d, o_orderpriority AS ccy, CAST(CAST(sum(CAST(o_totalprice AS DECIMAL(18,4))) AS DOUBLE) / count(*) AS DOUBLE) AS rate FROM orders GROUP BY 1, 2)"


def fx(t: Tables) -> DataFrame:
    return t.orders.groupBy(F.to_date("o_orderdate").alias("d"), F.col("o_orderpriority").alias("ccy")).agg((total(F.col("o_totalprice")) / F.count("*")).alias("rate"))


@query("d38_cross_rates", f"WITH r AS {_FX} SELECT CAST(r.d AS VARCHAR) AS d, r.ccy AS ccy, round(u.rate / r.rate, 9) AS factor FROM r JOIN r u ON u.d = r.d AND u.ccy = '1-URGENT'")
def _(t: Tables) -> DataFrame:
    return rollups.cross_rates(fx(t), "d", "ccy", "rate", "1-URGENT").select(F.col("d").cast("string").alias("d"), "ccy", F.round("factor", 9).alias("factor"))


@query(
    "d39_fx_enrichment",
    f"WITH r AS {_FX}, f AS (SELECT r.d, r.ccy, u.rate / r.rate AS factor FROM r JOIN r u ON u.d = r.d AND u.ccy = '1-URGENT') SELECT l_orderkey, l_linenumber, round(l_extendedprice * factor, 4) AS usd FROM (SELECT l_orderkey, l_linenumber, l_extendedprice, CAST(l_shipdate AS DATE) AS d, '2-HIGH' AS ccy FROM lineitem) l ASOF LEFT JOIN f ON f.ccy = l.ccy AND l.d >= f.d",
)
def _(t: Tables) -> DataFrame:
    factors = rollups.cross_rates(fx(t), "d", "ccy", "rate", "1-URGENT").withColumnRenamed("d", "rate_day")
    days = t.lineitem.select(F.to_date("l_shipdate").alias("d"), F.lit("2-HIGH").alias("ccy")).distinct()
    known = joins.as_of(days, factors, ["ccy"], "d", "rate_day", ["factor"])
    return t.lineitem.withColumn("d", F.to_date("l_shipdate")).join(known, "d", "left").select("l_orderkey", "l_linenumber", F.round(F.col("l_extendedprice") * F.col("factor"), 4).alias("usd"))


@query(
    "d40_turnover_guard",
    """WITH p AS (SELECT l_suppkey AS symbol, CAST(l_shipdate AS DATE) AS day, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,4))) AS DOUBLE) AS traded FROM lineitem GROUP BY 1, 2), m AS (SELECT symbol, median(traded) AS med FROM p GROUP BY 1 HAVING count(*) >= 30 AND med > 0),
    g AS (SELECT p.*, med IS NOT NULL AND traded > med * 2 AS bad FROM p LEFT JOIN m ON p.symbol = m.symbol)
    SELECT CAST(date_trunc('month', day) AS VARCHAR)[1:10] AS month, count(DISTINCT symbol) FILTER (NOT bad) AS symbols, CAST(sum(CAST(CASE WHEN NOT bad THEN traded END AS DECIMAL(18,4))) AS DOUBLE) AS traded, count(*) FILTER (bad) AS excluded_days, CAST(sum(CAST(CASE WHEN bad THEN traded END AS DECIMAL(18,4))) AS DOUBLE) AS excluded FROM g GROUP BY 1""",
)
def _(t: Tables) -> DataFrame:
    daily = t.lineitem.groupBy(F.col("l_suppkey").alias("symbol"), F.to_date("l_shipdate").alias("day")).agg(total(F.col("l_extendedprice")).alias("traded"))
    g = rollups.flag_outliers(daily, "symbol", "traded", 2.0, 30)
    bad = F.col("implausible")
    return g.groupBy(F.trunc("day", "month").cast("string").alias("month")).agg(F.countDistinct(F.when(~bad, F.col("symbol"))).alias("symbols"), total(F.when(~bad, F.col("traded"))).alias("traded"), F.count_if(bad).alias("excluded_days"), total(F.when(bad, F.col("traded"))).alias("excluded"))


@query(
    "d41_latest_summary",
    "SELECT o_custkey, CAST(year AS BIGINT) AS year, years, amount FROM (SELECT o_custkey, extract(year FROM o_orderdate) AS year, count(DISTINCT extract(year FROM o_orderdate)) OVER (PARTITION BY o_custkey) AS years, coalesce(CASE WHEN o_orderkey % 2 = 0 THEN o_totalprice END, o_totalprice * 2) AS amount, row_number() OVER (PARTITION BY o_custkey ORDER BY extract(year FROM o_orderdate) DESC, o_orderdate DESC, o_orderkey DESC) AS n FROM orders WHERE o_orderstatus <> 'P') WHERE n = 1",
)
def _(t: Tables) -> DataFrame:
    facts = t.orders.where("o_orderstatus <> 'P'").withColumn("year", F.year("o_orderdate").cast("bigint"))
    found = rollups.latest_summary(facts, "o_custkey", "year", [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()], F.when(F.col("o_orderkey") % 2 == 0, F.col("o_totalprice")), F.col("o_totalprice") * 2)
    return found.select("o_custkey", "year", "years", "amount")


query("d42_contract_rollup_by_supplier", "SELECT l_suppkey, CAST(sum(v) AS DOUBLE) AS total, count(*) AS contracts, count(*) FILTER (n > 1) AS shared FROM (SELECT l_orderkey, l_suppkey, max(v) AS v, count(*) AS n FROM (SELECT l_orderkey, l_returnflag, l_suppkey, sum(CAST(l_extendedprice AS DECIMAL(18,4))) AS v FROM lineitem GROUP BY 1, 2, 3) GROUP BY 1, 2) GROUP BY 1")(
    lambda t: rollups.counted_once(t.lineitem, "l_orderkey", "l_returnflag", "l_suppkey", "l_extendedprice")
)


def observations(t: Tables) -> DataFrame:
    day = F.to_date("l_shipdate")
    return t.lineitem.select((F.col("l_suppkey") % 10).alias("domain"), F.col("l_returnflag").alias("service"), F.col("l_linestatus").alias("provider"), day.alias("valid_from"), F.date_add(day, F.col("l_quantity").cast("int")).alias("valid_to"), (F.col("l_linenumber") % 3 == 0).alias("fallback"), "l_orderkey", "l_linenumber")


@query(
    "d43_interval_history",
    """WITH cur AS (SELECT l_suppkey % 10 AS domain, l_returnflag AS service, l_linestatus AS provider, CAST(l_shipdate AS DATE) AS valid_from, CAST(l_shipdate AS DATE) + CAST(l_quantity AS INTEGER) AS valid_to, l_linenumber % 3 = 0 AS fallback, l_orderkey, l_linenumber FROM lineitem),
    kept AS (SELECT * FROM cur c WHERE NOT fallback OR NOT EXISTS (SELECT 1 FROM cur p WHERE NOT p.fallback AND p.domain = c.domain AND p.service = c.service AND p.valid_from <= c.valid_to AND p.valid_to >= c.valid_from)),
    m AS (SELECT *, coalesce(valid_from >= max(valid_to) OVER (PARTITION BY domain, service, provider ORDER BY valid_from, valid_to, l_orderkey, l_linenumber ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 45, false) AS fresh FROM kept),
    i AS (SELECT *, sum(CAST(fresh AS INTEGER)) OVER (PARTITION BY domain, service, provider ORDER BY valid_from, valid_to, l_orderkey, l_linenumber ROWS UNBOUNDED PRECEDING) AS island FROM m),
    h AS (SELECT domain, service, provider, min(valid_from) AS f, max(valid_to) AS l, count(*) AS evidence FROM i GROUP BY domain, service, provider, island), s AS (SELECT domain, service, max(valid_to) AS scan FROM cur GROUP BY 1, 2)
    SELECT h.domain AS domain, h.service AS service, provider, CAST(f AS VARCHAR) AS first_seen, CAST(l AS VARCHAR) AS last_seen, evidence, l >= scan AS is_current FROM h JOIN s ON h.domain = s.domain AND h.service = s.service""",
)
def _(t: Tables) -> DataFrame:
    rows = observations(t)
    kept = intervals.uncovered(rows, ["domain", "service"], "valid_from", "valid_to", "fallback")
    found = intervals.islands(kept, ["domain", "service", "provider"], "valid_from", "valid_to", F.expr("interval 45 days"), ["l_orderkey", "l_linenumber"])
    history = found.groupBy("domain", "service", "provider", "island").agg(F.min("valid_from").alias("f"), F.max("valid_to").alias("l"), F.count("*").alias("evidence"))
    scans = rows.groupBy("domain", "service").agg(F.max("valid_to").alias("scan"))
    return history.join(scans, ["domain", "service"]).select("domain", "service", "provider", F.col("f").cast("string").alias("first_seen"), F.col("l").cast("string").alias("last_seen"), "evidence", (F.col("l") >= F.col("scan")).alias("is_current"))


@query("d44_feature_index", "SELECT DISTINCT kind, key, id FROM (SELECT 'name' AS kind, lower(regexp_replace(s_name, '[^\\p{L}\\p{N}]', '', 'g')) AS key, s_suppkey AS id FROM supplier UNION ALL SELECT 'nation', lower(n_name), s_suppkey FROM supplier JOIN nation ON s_nationkey = n_nationkey UNION ALL SELECT 'number', CAST(s_suppkey AS VARCHAR), s_suppkey FROM supplier) WHERE length(key) >= 3")
def _(t: Tables) -> DataFrame:
    named = t.supplier.join(F.broadcast(t.nation), F.col("s_nationkey") == F.col("n_nationkey"), "left")
    features = F.array(*[F.struct(F.lit(k).alias("kind"), v.alias("key")) for k, v in (("name", text.squash_key(F.col("s_name"))), ("nation", F.lower("n_name")), ("number", F.col("s_suppkey").cast("string")))])
    return named.select(F.explode(features).alias("x"), F.col("s_suppkey").alias("id")).select("x.kind", "x.key", "id").where("length(key) >= 3").distinct()


@query("d45_graph_validation", f"WITH e AS {_LINKS}, n AS (SELECT source AS v FROM e UNION SELECT target FROM e) SELECT (SELECT count(*) FROM e) AS edges, (SELECT count(*) FROM e WHERE source = target) AS loops, (SELECT max(v) - min(v) + 1 = count(*) FROM n) AS contiguous")
def _(t: Tables) -> DataFrame:
    e = links(t)
    nodes = e.select(F.explode(F.array("source", "target")).alias("v")).distinct().agg((F.max("v") - F.min("v") + 1 == F.count("*")).alias("contiguous"))
    return e.agg(F.count("*").alias("edges"), F.count_if(F.col("source") == F.col("target")).alias("loops")).crossJoin(nodes)


@query("d46_reciprocal_ranking", f"WITH e AS {_LINKS}, r AS (SELECT x.source AS a, x.target AS b FROM e x JOIN e y ON x.source = y.target AND x.target = y.source WHERE x.source <> x.target), p AS (SELECT target, count(*) AS popularity FROM e GROUP BY 1) SELECT a AS node, count(*) AS partners, any_value(popularity) AS popularity FROM r JOIN p ON a = p.target GROUP BY a")
def _(t: Tables) -> DataFrame:
    pairs = joins.reciprocal(links(t), "source", "target")
    ends = pairs.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count("*").alias("partners"))
    popular = links(t).groupBy(F.col("target").alias("node")).agg(F.count("*").alias("popularity"))
    return ends.join(popular, "node")


@query("d47_unique_ownership", "SELECT l_orderkey, min(l_suppkey) AS owner FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_suppkey) = 1")
def _(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_orderkey").agg(F.min("l_suppkey").alias("owner"), F.max("l_suppkey").alias("m")).where("owner = m").drop("m")


@query("d48_pending_texts", "SELECT sha256(text) AS h, min(doc_id) AS first_doc FROM documents WHERE lang <> 'en' AND trim(text) <> '' AND strlen(text) <= 8000 AND sha256(text) NOT IN (SELECT sha256(text) FROM documents WHERE source = 'src0') GROUP BY 1")
def _(t: Tables) -> DataFrame:
    hashed = t.documents.where((F.col("lang") != "en") & (F.trim("text") != "") & (F.octet_length("text") <= 8000)).select(F.sha2("text", 256).alias("h"), "doc_id")
    done = t.documents.where("source = 'src0'").select(F.sha2("text", 256).alias("h")).distinct()
    return hashed.join(done, "h", "left_anti").groupBy("h").agg(F.min("doc_id").alias("first_doc"))


@query("d49_fact_parity", "WITH a AS (SELECT o_orderkey AS k, CAST(o_totalprice AS DECIMAL(18,2)) AS v FROM orders WHERE o_orderkey % 13 <> 0), b AS (SELECT o_orderkey AS k, CAST(o_totalprice + CASE WHEN o_orderkey % 17 = 0 THEN 1 ELSE 0 END AS DECIMAL(18,6)) AS v FROM orders WHERE o_orderkey % 19 <> 0) SELECT coalesce(a.k, b.k) AS k, CASE WHEN a.k IS NULL THEN 'only_right' WHEN b.k IS NULL THEN 'only_left' ELSE 'differs' END AS problem FROM a FULL JOIN b ON a.k = b.k WHERE a.v IS DISTINCT FROM b.v")
def _(t: Tables) -> DataFrame:
    k, price = F.col("o_orderkey"), F.col("o_totalprice")
    a = t.orders.where(k % 13 != 0).select(k.alias("k"), price.cast("decimal(18,2)").alias("a"))
    b = t.orders.where(k % 19 != 0).select(k.alias("k"), (price + F.when(k % 17 == 0, 1).otherwise(0)).cast("decimal(18,6)").alias("b"))
    joined = a.join(b, "k", "full").where(~F.col("a").eqNullSafe(F.col("b")))
    return joined.select("k", F.when(F.col("a").isNull(), "only_right").when(F.col("b").isNull(), "only_left").otherwise("differs").alias("problem"))


@query("d50_code_cleanup", "SELECT p_partkey, position, code, position = min(position) OVER (PARTITION BY p_partkey) AS is_primary FROM (SELECT p_partkey, u.position, regexp_extract(u.raw, '([0-9]{1,4})', 1) AS code FROM part, LATERAL (VALUES (0::BIGINT, p_name), (1::BIGINT, p_brand), (2::BIGINT, p_type)) AS u(position, raw)) WHERE code <> ''")
def _(t: Tables) -> DataFrame:
    rows = t.part.select("p_partkey", F.posexplode(F.array("p_name", "p_brand", "p_type")).alias("position", "raw"))
    codes = rows.select("p_partkey", F.col("position").cast("bigint").alias("position"), F.regexp_extract("raw", "([0-9]{1,4})", 1).alias("code")).where("code <> ''")
    return codes.withColumn("is_primary", F.col("position") == F.min("position").over(Window.partitionBy("p_partkey")))


# Further queries


@query("v01_fuzzy_name_search", "SELECT c_custkey, round(1 - levenshtein(k, 'customer000000012') / greatest(length(k), 17), 9) AS similarity FROM (SELECT c_custkey, lower(regexp_replace(c_name, '[^\\p{L}\\p{N}]', '', 'g')) AS k FROM customer) WHERE length(k) BETWEEN 8 AND 34 AND levenshtein(k, 'customer000000012') <= 3 ORDER BY k = 'customer000000012' DESC, similarity DESC, c_custkey LIMIT 10")
def _(t: Tables) -> DataFrame:
    wanted = "customer000000012"
    named = t.customer.select("c_custkey", text.squash_key(F.col("c_name")).alias("k")).where(F.length("k").between(len(wanted) // 2, 2 * len(wanted)))
    near = named.where((F.contains("k", F.lit(wanted)) | (text.ngram_distance(F.col("k"), F.lit(wanted)) < 0.6)) & (F.levenshtein("k", F.lit(wanted)) <= 3))
    ranked = near.withColumn("similarity", F.round(text.name_similarity(F.col("k"), F.lit(wanted)), 9))
    return ranked.orderBy((F.col("k") == wanted).desc(), F.col("similarity").desc(), "c_custkey").limit(10).select("c_custkey", "similarity")


query("v02_counted_once", "SELECT l_partkey, CAST(sum(v) AS DOUBLE) AS total, count(*) AS contracts, count(*) FILTER (n > 1) AS shared FROM (SELECT l_orderkey, l_partkey, max(v) AS v, count(*) AS n FROM (SELECT l_orderkey, l_linestatus, l_partkey, sum(CAST(l_extendedprice AS DECIMAL(18,4))) AS v FROM lineitem GROUP BY 1, 2, 3) GROUP BY 1, 2) GROUP BY 1")(
    lambda t: rollups.counted_once(t.lineitem, "l_orderkey", "l_linestatus", "l_partkey", "l_extendedprice")
)


@query("v03_two_ranks", "SELECT o_custkey, o_orderpriority, o_orderkey, is_primary FROM (SELECT o_custkey, o_orderpriority, o_orderkey, row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_orderdate DESC, o_orderkey) AS d, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) = 1 AS is_primary FROM orders) WHERE d = 1")
def _(t: Tables) -> DataFrame:
    order = [F.col("o_orderdate").desc(), F.col("o_orderkey")]
    w = Window.partitionBy("o_custkey")
    return t.orders.select("o_custkey", "o_orderpriority", "o_orderkey", F.row_number().over(Window.partitionBy("o_custkey", "o_orderpriority").orderBy(*order)).alias("d"), (F.row_number().over(w.orderBy(*order)) == 1).alias("is_primary")).where("d = 1").drop("d")


@query("v04_latest_non_null", "SELECT o_custkey, arg_max(p, o_orderkey) FILTER (p IS NOT NULL) AS p, arg_max(s, o_orderkey) FILTER (s IS NOT NULL) AS s FROM (SELECT o_custkey, o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN o_totalprice END AS p, CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus END AS s FROM orders) GROUP BY 1")
def _(t: Tables) -> DataFrame:
    k = F.col("o_orderkey")
    versions = t.orders.select("o_custkey", k, F.when(k % 3 == 0, F.col("o_totalprice")).alias("p"), F.when(k % 2 == 0, F.col("o_orderstatus")).alias("s"))
    return latest.latest_non_null(versions, ["o_custkey"], ["p", "s"], k)


@query("v05_hostname_inventory", "SELECT host, count(*) AS pages, bool_or(starts_with(url, 'https')) AS secure, min(page_id) AS first_page, max(page_id) AS last_page FROM (SELECT *, lower(regexp_extract(url, '^[a-z]+://([^/?#:]*)', 1)) AS host FROM pages) GROUP BY 1")
def _(t: Tables) -> DataFrame:
    return t.pages.groupBy(net.host_of(F.col("url")).alias("host")).agg(F.count("*").alias("pages"), F.bool_or(F.col("url").startswith("https")).alias("secure"), F.min("page_id").alias("first_page"), F.max("page_id").alias("last_page"))


@query("v06_listings_without_fanout", "SELECT p_brand, count(DISTINCT l_suppkey) AS suppliers, count(DISTINCT p_partkey) AS parts FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1")
def _(t: Tables) -> DataFrame:
    return t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).groupBy("p_brand").agg(F.countDistinct("l_suppkey").alias("suppliers"), F.countDistinct("p_partkey").alias("parts"))


@query("v07_mapping_quality", "SELECT count(*) AS suppliers, count(*) FILTER (s_acctbal < 0) AS negative, (SELECT count(*) FROM (SELECT s_nationkey FROM supplier GROUP BY 1 HAVING count(*) > 1)) AS ambiguous FROM supplier")
def _(t: Tables) -> DataFrame:
    ambiguous = t.supplier.groupBy("s_nationkey").agg(F.count("*").alias("n")).where("n > 1").agg(F.count("*").alias("ambiguous"))
    return t.supplier.agg(F.count("*").alias("suppliers"), F.count_if(F.col("s_acctbal") < 0).alias("negative")).crossJoin(ambiguous)


@query("v08_latest_then_filter", "SELECT o_custkey, o_orderkey FROM (SELECT * FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1) WHERE o_orderstatus = 'O'")
def _(t: Tables) -> DataFrame:
    rows = t.orders.select("o_custkey", "o_orderdate", "o_orderkey", "o_orderstatus")
    return latest.prefer(rows, ["o_custkey"], "o_orderdate", ["o_orderkey"], F.col("o_orderstatus") == "O").select("o_custkey", "o_orderkey")


@query("v09_ranked_candidates", "SELECT o_custkey, o_orderkey, nth, nth = 1 AS is_primary FROM (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS nth FROM orders) WHERE nth <= 3")
def _(t: Tables) -> DataFrame:
    top = F.slice(F.array_sort(F.collect_list(F.struct((-F.col("o_totalprice")).alias("p"), "o_orderkey"))), 1, 3)
    ranked = t.orders.groupBy("o_custkey").agg(top.alias("top")).select("o_custkey", F.posexplode("top").alias("nth", "x"))
    return ranked.select("o_custkey", "x.o_orderkey", (F.col("nth") + 1).cast("bigint").alias("nth"), (F.col("nth") == 0).alias("is_primary"))


@query("v10_taxonomy_state", "SELECT r_name, count(n_nationkey) AS nations, count(n_nationkey) FILTER (n_nationkey % 2 = 0) AS even, count(c_custkey) AS customers FROM region LEFT JOIN nation ON r_regionkey = n_regionkey LEFT JOIN customer ON c_nationkey = n_nationkey AND c_acctbal < 0 GROUP BY 1")
def _(t: Tables) -> DataFrame:
    joined = t.region.join(t.nation, F.col("r_regionkey") == F.col("n_regionkey"), "left").join(t.customer.where("c_acctbal < 0"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return joined.groupBy("r_name").agg(F.count("n_nationkey").alias("nations"), F.count_if(F.col("n_nationkey") % 2 == 0).alias("even"), F.count("c_custkey").alias("customers"))


@query(
    "v11_definitive_changes",
    "WITH v AS (SELECT user_id, ts, event_id, CASE event_type WHEN 'purchase' THEN 'yes' WHEN 'click' THEN 'no' END AS verdict FROM events), c AS (SELECT *, lag(verdict) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS before FROM v WHERE verdict IS NOT NULL) SELECT user_id, event_id, verdict FROM c WHERE verdict IS DISTINCT FROM before",
)
def _(t: Tables) -> DataFrame:
    kind = F.col("event_type")
    verdicts = t.events.select("user_id", "ts", "event_id", F.when(kind == "purchase", "yes").when(kind == "click", "no").alias("verdict"))
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    carried = verdicts.withColumn("before", F.last("verdict", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1)))
    return carried.where("verdict is not null and not (verdict <=> before)").select("user_id", "event_id", "verdict")


@query("v15_inverted_index", "SELECT word, count(DISTINCT doc_id) AS docs FROM (SELECT doc_id, unnest(string_split(lower(text), ' ')) AS word FROM documents) WHERE word <> '' GROUP BY 1")
def _(t: Tables) -> DataFrame:
    words = t.documents.select("doc_id", F.explode(F.array_distinct(F.split(F.lower("text"), " "))).alias("word")).where("word <> ''")
    return words.groupBy("word").agg(F.count("*").alias("docs"))


@query("v16_shared_key_set", "SELECT 'orders' AS reader, count(*) AS n FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_name LIKE 'Customer#00000000%') UNION ALL SELECT 'customers', count(*) FROM customer WHERE c_name LIKE 'Customer#00000000%'")
def _(t: Tables) -> DataFrame:
    keys = t.customer.where(F.col("c_name").startswith("Customer#00000000")).select("c_custkey")
    found = t.orders.join(keys, F.col("o_custkey") == F.col("c_custkey"), "left_semi").agg(F.lit("orders").alias("reader"), F.count("*").alias("n"))
    return found.unionByName(keys.agg(F.lit("customers").alias("reader"), F.count("*").alias("n")))
