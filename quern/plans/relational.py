"""Filters, joins, windows, ordering, set operations and reshaping over the evaluation tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import net, text
from ..operators import filters, intervals, joins, latest, reshape
from .catalog import Tables, query

MONEY = "decimal(18,4)"


def total(column: F.Column) -> F.Column:
    """An exact sum as a double, the same in whatever order."""
    return F.sum(column.cast(MONEY)).cast("double")


# Scans


@query("s03_json_each", "SELECT event_id, k AS key, CAST(json_extract(props, '$.' || k) AS BIGINT) AS value FROM (SELECT event_id, props, unnest(json_keys(props)) AS k FROM events)")
def _(t: Tables) -> DataFrame:
    return t.events.select("event_id", F.explode(F.from_json("props", "map<string,bigint>")).alias("key", "value"))


@query("s04_parquet_scan_pruned", "SELECT l_orderkey, l_quantity FROM lineitem WHERE l_shipdate >= TIMESTAMP '1997-01-01' AND l_quantity > 45")
def _(t: Tables) -> DataFrame:
    return t.lineitem.where("l_shipdate >= timestamp'1997-01-01' and l_quantity > 45").select("l_orderkey", "l_quantity")


@query("s16_inline_relation", "SELECT n.n_name, v.code FROM nation n JOIN (VALUES (0, 'AF'), (1, 'AM'), (2, 'AS'), (3, 'EU')) AS v(k, code) ON n.n_regionkey = v.k")
def _(t: Tables) -> DataFrame:
    given = t.spark.createDataFrame([(0, "AF"), (1, "AM"), (2, "AS"), (3, "EU")], "k int, code string")
    return t.nation.join(F.broadcast(given), F.col("n_regionkey") == F.col("k")).select("n_name", "code")


@query("s17_keyset_page", "SELECT DISTINCT o_custkey FROM orders WHERE o_custkey > 40 ORDER BY o_custkey LIMIT 25")
def _(t: Tables) -> DataFrame:
    return filters.keyset_page(t.orders, "o_custkey", 40, 25)


@query("s18_bucket_scan", "SELECT o_orderkey FROM orders WHERE o_orderkey % 128 = 5")
def _(t: Tables) -> DataFrame:
    return t.orders.where(F.pmod("o_orderkey", F.lit(128)) == 5).select("o_orderkey")


# Projections and predicates


@query("p01_computed_projection", "SELECT l_orderkey, l_linenumber, 'lineitem' AS source, CAST(CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(18,4)) AS DOUBLE) AS net FROM lineitem")
def _(t: Tables) -> DataFrame:
    return t.lineitem.select("l_orderkey", "l_linenumber", F.lit("lineitem").alias("source"), (F.col("l_extendedprice") * (1 - F.col("l_discount"))).cast(MONEY).cast("double").alias("net"))


@query("p02_all_but", "SELECT * EXCLUDE (s_acctbal) FROM supplier")
def _(t: Tables) -> DataFrame:
    return t.supplier.drop("s_acctbal")


@query("p03_replace_column", "SELECT * REPLACE (upper(c_mktsegment) AS c_mktsegment) FROM customer")
def _(t: Tables) -> DataFrame:
    return t.customer.withColumn("c_mktsegment", F.upper("c_mktsegment"))


@query("p04_conditional", "SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'debt' WHEN c_acctbal < 1000 THEN 'low' WHEN c_acctbal < 5000 THEN 'mid' ELSE 'high' END AS band FROM customer")
def _(t: Tables) -> DataFrame:
    b = F.col("c_acctbal")
    return t.customer.select("c_custkey", F.when(b < 0, "debt").when(b < 1000, "low").when(b < 5000, "mid").otherwise("high").alias("band"))


@query("p05_null_logic", "SELECT event_id, coalesce(nullif(event_type, 'view'), 'none') AS kind, nullif(event_type, 'view') IS NULL AS blank FROM events")
def _(t: Tables) -> DataFrame:
    kind = F.nullif("event_type", F.lit("view"))
    return t.events.select("event_id", F.coalesce(kind, F.lit("none")).alias("kind"), kind.isNull().alias("blank"))


@query("p06_distinct_from", "SELECT o_orderkey, nullif(o_orderstatus, 'P') IS DISTINCT FROM nullif(o_orderstatus, 'O') AS differs FROM orders")
def _(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", (~F.nullif("o_orderstatus", F.lit("P")).eqNullSafe(F.nullif("o_orderstatus", F.lit("O")))).alias("differs"))


@query("p07_between", "SELECT count(*) AS n FROM lineitem WHERE l_discount BETWEEN 0.05 AND 0.07 AND l_quantity < 24")
def _(t: Tables) -> DataFrame:
    return t.lineitem.where(F.col("l_discount").between(0.05, 0.07) & (F.col("l_quantity") < 24)).agg(F.count("*").alias("n"))


@query("p08_like", "SELECT p_partkey FROM part WHERE p_name LIKE '%1%' OR p_type ILIKE '%a%'")
def _(t: Tables) -> DataFrame:
    return t.part.where(F.col("p_name").like("%1%") | F.col("p_type").ilike("%a%")).select("p_partkey")


@query("p09_regex", "SELECT page_id FROM pages WHERE regexp_matches(url, '^https://[a-z.]+/en/')")
def _(t: Tables) -> DataFrame:
    return t.pages.where(F.col("url").rlike("^https://[a-z.]+/en/")).select("page_id")


@query("p10_prefix_suffix", "SELECT page_id, starts_with(url, 'https') AS secure, ends_with(url, '#top') AS anchored, contains(url, 'page=') AS paged, CAST(instr(url, '?') AS BIGINT) AS query_at FROM pages")
def _(t: Tables) -> DataFrame:
    u = F.col("url")
    return t.pages.select("page_id", u.startswith("https").alias("secure"), u.endswith("#top").alias("anchored"), u.contains("page=").alias("paged"), F.instr(u, "?").cast("bigint").alias("query_at"))


@query("p11_caseless_contains", "SELECT c_custkey FROM customer WHERE contains(lower(c_mktsegment), lower('BUILD'))")
def _(t: Tables) -> DataFrame:
    return t.customer.where(F.contains(F.lower("c_mktsegment"), F.lower(F.lit("BUILD")))).select("c_custkey")


@query("p12_in_lists", "SELECT o_orderkey FROM orders WHERE o_orderstatus IN ('F', 'P') AND o_orderpriority NOT IN ('1-URGENT', '2-HIGH')")
def _(t: Tables) -> DataFrame:
    return t.orders.where(F.col("o_orderstatus").isin("F", "P") & ~F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")).select("o_orderkey")


@query("p13_optional_filters", "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'O'")
def _(t: Tables) -> DataFrame:
    return t.orders.where(filters.optional({"o_orderstatus": "O", "o_orderpriority": ""})).select("o_orderkey")


@query(
    "p14_array_membership",
    """WITH a AS (SELECT user_id, list_sort(list(DISTINCT event_type)) AS kinds FROM events GROUP BY user_id)
    SELECT user_id, list_contains(kinds, 'click') AS clicked, list_has_any(kinds, ['purchase', 'signup']) AS any_of, list_has_all(kinds, ['click', 'view']) AS all_of, len(list_filter(kinds, lambda x: starts_with(x, 'p'))) > 0 AS p_kind FROM a""",
)
def _(t: Tables) -> DataFrame:
    kinds = F.col("kinds")
    any_of, all_of = F.array(F.lit("purchase"), F.lit("signup")), F.array(F.lit("click"), F.lit("view"))
    sets = t.events.groupBy("user_id").agg(F.collect_set("event_type").alias("kinds"))
    return sets.select("user_id", F.array_contains(kinds, "click").alias("clicked"), F.arrays_overlap(kinds, any_of).alias("any_of"), (F.size(F.array_except(all_of, kinds)) == 0).alias("all_of"), F.exists(kinds, lambda x: x.startswith("p")).alias("p_kind"))


@query("p15_filter_builder", "SELECT o_orderkey FROM orders WHERE o_orderstatus IN ('F', 'O') AND o_orderpriority LIKE '1%' AND o_totalprice BETWEEN 1000 AND 200000 AND o_orderdate >= TIMESTAMP '1995-01-01' AND o_orderdate < TIMESTAMP '1997-01-01'")
def _(t: Tables) -> DataFrame:
    chosen = filters.Facets(values={"o_orderstatus": ["F", "O"]}, prefixes={"o_orderpriority": "1"}, amounts={"o_totalprice": (200000, 1000)}, dates={"o_orderdate": ("1995", "1996")})
    return t.orders.where(chosen.condition()).select("o_orderkey")


@query("p16_scalar_subquery", "SELECT o_orderkey FROM orders WHERE o_totalprice > (SELECT max(o_totalprice) * 0.9 FROM orders)")
def _(t: Tables) -> DataFrame:
    top = t.orders.agg((F.max("o_totalprice") * 0.9).alias("floor"))
    return t.orders.join(F.broadcast(top), F.col("o_totalprice") > F.col("floor")).select("o_orderkey")


@query("p17_correlated_first", "SELECT c_custkey, (SELECT o_orderkey FROM orders WHERE o_custkey = c_custkey ORDER BY o_totalprice DESC, o_orderkey LIMIT 1) AS top_order FROM customer")
def _(t: Tables) -> DataFrame:
    best = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max_by("o_orderkey", F.struct("o_totalprice", -F.col("o_orderkey"))).alias("top_order"))
    return t.customer.join(best, "c_custkey", "left").select("c_custkey", "top_order")


# Joins


@query("j01_inner_equi", "SELECT o_orderkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_acctbal > 5000")
def _(t: Tables) -> DataFrame:
    return t.orders.join(t.customer.where("c_acctbal > 5000"), F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_name")


@query("j02_left_enrich", "SELECT s_suppkey, n_name, r_name FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey")
def _(t: Tables) -> DataFrame:
    places = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
    return t.supplier.join(places, F.col("s_nationkey") == F.col("n_nationkey"), "left").select("s_suppkey", "n_name", "r_name")


@query("j03_left_any", "SELECT c_custkey, first_order FROM customer LEFT JOIN (SELECT o_custkey, min(o_orderkey) AS first_order FROM orders GROUP BY 1) ON c_custkey = o_custkey")
def _(t: Tables) -> DataFrame:
    right = t.orders.select(F.col("o_custkey").alias("c_custkey"), F.col("o_orderkey").alias("first_order"))
    return joins.any_left(t.customer.select("c_custkey"), right, ["c_custkey"], [F.col("first_order")])


@query("j04_left_anti", "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')")
def _(t: Tables) -> DataFrame:
    return t.customer.join(t.orders.where("o_orderstatus = 'F'"), F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey")


@query("j05_anti_derived_keys", "SELECT DISTINCT l.l_suppkey, CAST(CAST(l.l_shipdate AS DATE) AS VARCHAR) AS day FROM lineitem l WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE CAST(o.o_orderdate AS DATE) = CAST(l.l_shipdate AS DATE))")
def _(t: Tables) -> DataFrame:
    done = t.orders.select(F.to_date("o_orderdate").alias("d")).distinct()
    return t.lineitem.select("l_suppkey", F.to_date("l_shipdate").alias("d")).distinct().join(done, "d", "left_anti").select("l_suppkey", F.col("d").cast("string").alias("day"))


@query("j06_membership_flag", "SELECT p_partkey, p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_quantity = 50) AS bulk FROM part")
def _(t: Tables) -> DataFrame:
    bulk = t.lineitem.where("l_quantity = 50").select(F.col("l_partkey").alias("p_partkey"))
    return joins.member_flag(t.part.select("p_partkey"), bulk, ["p_partkey"], "bulk")


@query("j07_tuple_in", "SELECT l_orderkey, l_linenumber FROM lineitem WHERE (l_partkey, l_suppkey) IN (SELECT l_partkey, l_suppkey FROM lineitem WHERE l_discount = 0.1)")
def _(t: Tables) -> DataFrame:
    return t.lineitem.join(t.lineitem.where("l_discount = 0.1").select("l_partkey", "l_suppkey"), ["l_partkey", "l_suppkey"], "left_semi").select("l_orderkey", "l_linenumber")


@query("j08_exists", "SELECT o_orderkey FROM orders o WHERE EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey AND l.l_returnflag = 'R') AND NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey AND l.l_quantity > 40)")
def _(t: Tables) -> DataFrame:
    on = F.col("l_orderkey") == F.col("o_orderkey")
    return t.orders.join(t.lineitem.where("l_returnflag = 'R'"), on, "left_semi").join(t.lineitem.where("l_quantity > 40"), on, "left_anti").select("o_orderkey")


@query("j09_run_constants", "SELECT r_name, (SELECT count(*) FROM nation) AS nations FROM region")
def _(t: Tables) -> DataFrame:
    return t.region.crossJoin(F.broadcast(t.nation.agg(F.count("*").alias("nations")))).select("r_name", "nations")


def price_bands(t: Tables) -> DataFrame:
    return t.spark.createDataFrame([(1, 900, 1099), (2, 1100, 1499), (3, 1500, 1999), (4, 1000, 1600)], "band int, low int, high int")


_BANDS = "(VALUES (1, 900, 1099), (2, 1100, 1499), (3, 1500, 1999), (4, 1000, 1600)) AS b(band, low, high)"


@query("j10_range_containment", f"SELECT p_partkey, band FROM part JOIN {_BANDS} ON CAST(floor(p_retailprice) AS BIGINT) BETWEEN low AND high")
def _(t: Tables) -> DataFrame:
    points = t.part.select("p_partkey", F.floor("p_retailprice").alias("price"))
    return joins.within_ranges(points, price_bands(t), "price", "low", "high", 256).select("p_partkey", "band")


@query("j11_range_counts", f"SELECT band, count(p_partkey) AS parts FROM {_BANDS} LEFT JOIN part ON CAST(floor(p_retailprice) AS BIGINT) BETWEEN low AND high GROUP BY band")
def _(t: Tables) -> DataFrame:
    points = t.part.select("p_partkey", F.floor("p_retailprice").alias("price"))
    hits = joins.within_ranges(points, price_bands(t), "price", "low", "high", 256).groupBy("band").agg(F.count("*").alias("n"))
    return price_bands(t).join(hits, "band", "left").select("band", F.coalesce("n", F.lit(0)).alias("parts"))


_NETWORKS = [(167772160, 8, "ten"), (167837696, 16, "ten-one"), (167838208, 24, "ten-one-two"), (3232235520, 16, "home"), (0, 0, "all")]
_NETWORK_SQL = "(VALUES " + ", ".join(f"({a}::BIGINT, {b}, '{c}')" for a, b, c in _NETWORKS) + ") AS r(network, bits, name)"
_ADDRESSES_SQL = "(SELECT event_id, CASE event_id % 4 WHEN 0 THEN 167772160 + event_id % 256 WHEN 1 THEN 167837696 + event_id WHEN 2 THEN 3232235520 + event_id ELSE 167838208 + event_id % 256 END AS address FROM events)"


def addresses(t: Tables) -> DataFrame:
    e = F.col("event_id")
    return t.events.select(e, F.when(e % 4 == 0, 167772160 + e % 256).when(e % 4 == 1, 167837696 + e).when(e % 4 == 2, F.lit(3232235520) + e).otherwise(167838208 + e % 256).alias("address"))


@query("j12_longest_prefix", f"SELECT event_id, name FROM (SELECT event_id, name, row_number() OVER (PARTITION BY event_id ORDER BY bits DESC) AS n FROM {_ADDRESSES_SQL} JOIN {_NETWORK_SQL} ON (address >> (32 - bits)) = (network >> (32 - bits))) WHERE n = 1")
def _(t: Tables) -> DataFrame:
    rules = F.broadcast(t.spark.createDataFrame(_NETWORKS, "network bigint, bits int, name string"))
    return joins.longest_prefix(addresses(t), rules, "address", "network", "bits", [0, 8, 16, 24]).select("event_id", "name")


@query("j13_covering_prefixes", f"SELECT event_id, name, row_number() OVER (PARTITION BY event_id ORDER BY bits DESC) AS nth FROM {_ADDRESSES_SQL} JOIN {_NETWORK_SQL} ON (address >> (32 - bits)) = (network >> (32 - bits))")
def _(t: Tables) -> DataFrame:
    rules = F.broadcast(t.spark.createDataFrame(_NETWORKS, "network bigint, bits int, name string"))
    return joins.longest_prefix(addresses(t), rules, "address", "network", "bits", [0, 8, 16, 24], all_matches=True).select("event_id", "name", F.col("nth").cast("bigint").alias("nth"))


@query("j14_as_of", "SELECT e.event_id, p.event_id AS last_purchase FROM (SELECT event_id, user_id, ts FROM events WHERE event_type <> 'purchase') e ASOF LEFT JOIN (SELECT user_id, ts, max(event_id) AS event_id FROM events WHERE event_type = 'purchase' GROUP BY user_id, ts) p ON e.user_id = p.user_id AND e.ts >= p.ts")
def _(t: Tables) -> DataFrame:
    bought = t.events.where("event_type = 'purchase'").groupBy("user_id", F.col("ts").alias("bought_at")).agg(F.max("event_id").alias("last_purchase"))
    others = t.events.where("event_type <> 'purchase'").select("event_id", "user_id", "ts")
    return joins.as_of(others, bought, ["user_id"], "ts", "bought_at", ["last_purchase"]).select("event_id", "last_purchase")


@query(
    "j15_nearest_common_date",
    """WITH f AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d, o_orderpriority AS p FROM orders), c AS (SELECT d FROM f GROUP BY d HAVING count(DISTINCT p) >= 2),
    r AS (SELECT DISTINCT CAST(l_shipdate AS DATE) AS q FROM lineitem)
    SELECT CAST(q AS VARCHAR) AS requested, CAST(coalesce((SELECT max(d) FROM c WHERE d <= q), (SELECT min(d) FROM c WHERE d > q)) AS VARCHAR) AS rate_date FROM r""",
)
def _(t: Tables) -> DataFrame:
    facts = t.orders.select(F.to_date("o_orderdate").alias("d"), "o_orderpriority")
    asked = t.lineitem.select(F.to_date("l_shipdate").alias("q"))
    return joins.nearest_common_date(asked, facts, "q", "d", "o_orderpriority", 2).select(F.col("q").cast("string").alias("requested"), F.col("rate_date").cast("string").alias("rate_date"))


@query("j16_interval_overlap", "WITH u AS (SELECT user_id, min(ts) AS a, max(ts) AS b FROM events GROUP BY 1) SELECT x.user_id AS user_id, count(*) AS overlaps FROM u x JOIN u y ON x.user_id <> y.user_id AND x.user_id // 10 = y.user_id // 10 AND x.a <= y.b AND x.b >= y.a GROUP BY 1")
def _(t: Tables) -> DataFrame:
    u = t.events.groupBy("user_id").agg(F.min("ts").alias("a"), F.max("ts").alias("b")).withColumn("g", F.floor(F.col("user_id") / 10))
    windows = u.groupBy("g").agg(F.collect_list(F.struct("user_id", "a", "b")).alias("all"))
    hits = F.size(F.filter("all", lambda w: (w["user_id"] != F.col("user_id")) & (w["a"] <= F.col("b")) & (w["b"] >= F.col("a"))))
    return u.join(windows, "g").select("user_id", hits.cast("bigint").alias("overlaps")).where("overlaps > 0")


@query("j17_or_keys", "SELECT DISTINCT c_custkey, s_suppkey FROM customer JOIN supplier ON (c_custkey = s_suppkey OR c_nationkey * 1000 + c_custkey % 10 = s_nationkey * 1000 + s_suppkey % 10)")
def _(t: Tables) -> DataFrame:
    pairs = [(F.col("c_custkey"), F.col("s_suppkey")), (F.col("c_nationkey") * 1000 + F.col("c_custkey") % 10, F.col("s_nationkey") * 1000 + F.col("s_suppkey") % 10)]
    return joins.any_of_keys(t.customer, t.supplier, pairs, ["c_custkey", "s_suppkey"]).select("c_custkey", "s_suppkey")


@query("j18_self_pairs", "SELECT DISTINCT least(a.l_partkey, b.l_partkey) AS a, greatest(a.l_partkey, b.l_partkey) AS b FROM lineitem a JOIN lineitem b ON a.l_orderkey = b.l_orderkey AND a.l_partkey < b.l_partkey")
def _(t: Tables) -> DataFrame:
    return joins.pairs_within(t.lineitem, "l_orderkey", "l_partkey")


def links(t: Tables) -> DataFrame:
    return t.lineitem.select(F.col("l_partkey").alias("source"), F.col("l_suppkey").alias("target")).distinct()


_LINKS = "(SELECT DISTINCT l_partkey AS source, l_suppkey AS target FROM lineitem)"


@query("j19_reciprocal_edges", f"WITH e AS {_LINKS} SELECT x.source AS a, x.target AS b FROM e x JOIN e y ON x.source = y.target AND x.target = y.source WHERE x.source < x.target")
def _(t: Tables) -> DataFrame:
    return joins.reciprocal(links(t), "source", "target")


@query("j20_adjacency", f"WITH e AS {_LINKS}, n AS (SELECT source AS seed, target AS node, 0 AS i, 1 AS o FROM e WHERE source IN (1, 2, 3) UNION ALL SELECT target, source, 1, 0 FROM e WHERE target IN (1, 2, 3)) SELECT seed, node, max(i) AS inbound, max(o) AS outbound, max(i) * max(o) AS reciprocal FROM n GROUP BY 1, 2")
def _(t: Tables) -> DataFrame:
    return joins.neighbours(links(t), t.spark.createDataFrame([(1,), (2,), (3,)], "seed bigint"), "source", "target")


@query("j21_block_fuzzy", "SELECT a.c_custkey AS a, b.c_custkey AS b, CAST(damerau_levenshtein(a.c_name, b.c_name) AS BIGINT) AS distance FROM customer a JOIN customer b ON a.c_nationkey = b.c_nationkey AND a.c_mktsegment = b.c_mktsegment AND a.c_custkey < b.c_custkey WHERE damerau_levenshtein(a.c_name, b.c_name) <= 1")
def _(t: Tables) -> DataFrame:
    block = ["c_nationkey", "c_mktsegment"]
    rows = t.customer.select(*block, "c_custkey", "c_name").dropna()
    names = rows.select(*block, "c_name").distinct()
    near = joins.one_edit_apart(names, block, "c_name").withColumn("distance", F.lit(1)).unionByName(names.select(*block, F.col("c_name").alias("x"), F.col("c_name").alias("y"), F.lit(0).alias("distance")))
    side = lambda s, name: rows.select(*block, F.col("c_name").alias(name), F.col("c_custkey").alias(s))
    pairs = near.join(side("a", "x").hint("merge"), [*block, "x"]).join(side("b", "y").hint("merge"), [*block, "y"]).where("a < b or distance = 1 and a > b")
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), F.col("distance").cast("bigint").alias("distance"))


@query("j22_lateral_top", "SELECT c_custkey, o_orderkey FROM customer, LATERAL (SELECT o_orderkey FROM orders WHERE o_custkey = c_custkey ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 1) x")
def _(t: Tables) -> DataFrame:
    top = latest.first_per_key(t.orders, ["o_custkey"], [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()])
    return t.customer.join(top, F.col("c_custkey") == F.col("o_custkey")).select("c_custkey", "o_orderkey")


@query("j23_lateral_values", "SELECT p_partkey, v.kind, v.value FROM part, LATERAL (VALUES ('brand', p_brand), ('type', p_type)) AS v(kind, value)")
def _(t: Tables) -> DataFrame:
    return reshape.candidates(t.part, ["p_partkey"], [("brand", F.col("p_brand")), ("type", F.col("p_type"))]).drop("position")


@query("j24_universe", "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0)")
def _(t: Tables) -> DataFrame:
    return t.lineitem.join(t.supplier.where("s_acctbal > 0"), F.col("l_suppkey") == F.col("s_suppkey"), "left_semi").select("l_orderkey", "l_linenumber")


@query("j25_normalised_identity", "SELECT c_custkey, s_suppkey FROM customer JOIN supplier ON regexp_replace(c_name, '[^0-9]', '', 'g') = regexp_replace(s_name, '[^0-9]', '', 'g') AND length(regexp_replace(c_name, '[^0-9]', '', 'g')) >= 3")
def _(t: Tables) -> DataFrame:
    left = t.customer.select("c_custkey", text.digits(F.col("c_name")).alias("k")).where("length(k) >= 3")
    return left.join(t.supplier.select("s_suppkey", text.digits(F.col("s_name")).alias("k")), "k").select("c_custkey", "s_suppkey")


@query("j26_join_update", "SELECT c_custkey, coalesce(s.s_acctbal, c_acctbal) AS balance FROM customer LEFT JOIN supplier s ON s.s_suppkey = c_custkey")
def _(t: Tables) -> DataFrame:
    return t.customer.join(t.supplier, F.col("s_suppkey") == F.col("c_custkey"), "left").select("c_custkey", F.coalesce("s_acctbal", "c_acctbal").alias("balance"))


@query("j27_cross_source_keys", "SELECT d.doc_id FROM documents d WHERE d.text IN (SELECT text FROM documents GROUP BY text HAVING count(DISTINCT source) > 1)")
def _(t: Tables) -> DataFrame:
    key = F.sha2("text", 256).alias("k")
    shared = t.documents.select(key, "source").distinct().groupBy("k").agg(F.count("*").alias("n")).where("n > 1")
    return t.documents.select("doc_id", key).join(shared, "k", "left_semi").select("doc_id")


# Windows


@query("w01_row_number", "SELECT l_orderkey, l_linenumber FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC NULLS LAST, l_linenumber) AS n FROM lineitem) WHERE n = 1")
def _(t: Tables) -> DataFrame:
    return latest.first_per_key(t.lineitem, ["l_orderkey"], [F.col("l_extendedprice").desc_nulls_last(), F.col("l_linenumber")]).select("l_orderkey", "l_linenumber")


@query("w02_qualify", "SELECT o_orderkey FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 2")
def _(t: Tables) -> DataFrame:
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    return t.orders.withColumn("n", F.row_number().over(w)).where("n = 2").select("o_orderkey")


@query("w03_partition_aggregates", "SELECT o_orderkey, max(o_totalprice) OVER (PARTITION BY o_custkey) AS top, count(*) OVER (PARTITION BY o_custkey) AS n FROM orders")
def _(t: Tables) -> DataFrame:
    w = Window.partitionBy("o_custkey")
    return t.orders.select("o_orderkey", F.max("o_totalprice").over(w).alias("top"), F.count("*").over(w).alias("n"))


@query("w04_distinct_over", "SELECT o_orderkey, count(DISTINCT o_orderpriority) OVER (PARTITION BY o_custkey) AS kinds FROM orders")
def _(t: Tables) -> DataFrame:
    w = Window.partitionBy("o_custkey")
    return t.orders.select("o_orderkey", F.size(F.collect_set("o_orderpriority").over(w)).cast("bigint").alias("kinds"))


@query("w05_running_max", "SELECT event_id, max(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM events")
def _(t: Tables) -> DataFrame:
    w = Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, -1)
    return t.events.select("event_id", F.max("value").over(w).alias("before"))


@query("w06_running_flags", "SELECT event_id, CAST(sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS purchases FROM events")
def _(t: Tables) -> DataFrame:
    w = Window.partitionBy("user_id").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, 0)
    return t.events.select("event_id", F.sum((F.col("event_type") == "purchase").cast("int")).over(w).cast("bigint").alias("purchases"))


_SPANS = "SELECT l_suppkey AS k, l_orderkey AS o, l_linenumber AS n, CAST(l_shipdate AS DATE) AS a, CAST(l_shipdate AS DATE) + CAST(l_quantity AS INTEGER) AS b FROM lineitem"


def spans(t: Tables) -> DataFrame:
    day = F.to_date("l_shipdate")
    return t.lineitem.select(F.col("l_suppkey").alias("k"), F.col("l_orderkey").alias("o"), F.col("l_linenumber").alias("n"), day.alias("a"), F.date_add(day, F.col("l_quantity").cast("int")).alias("b"))


@query(
    "w07_gaps_and_islands",
    f"""WITH s AS ({_SPANS}), m AS (SELECT *, coalesce(a >= max(b) OVER (PARTITION BY k ORDER BY a, b, o, n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 5, false) AS fresh FROM s),
    i AS (SELECT *, sum(CAST(fresh AS INTEGER)) OVER (PARTITION BY k ORDER BY a, b, o, n ROWS UNBOUNDED PRECEDING) AS island FROM m)
    SELECT k, CAST(min(a) AS VARCHAR) AS first_day, CAST(max(b) AS VARCHAR) AS last_day, count(*) AS evidence FROM i GROUP BY k, island""",
)
def _(t: Tables) -> DataFrame:
    found = intervals.islands(spans(t), ["k"], "a", "b", F.expr("interval 5 days"), ["o", "n"])
    return found.groupBy("k", "island").agg(F.min("a").cast("string").alias("first_day"), F.max("b").cast("string").alias("last_day"), F.count("*").alias("evidence")).drop("island")


@query("w09_two_phase_top", "SELECT l_suppkey, l_orderkey, l_linenumber FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber) <= 3")
def _(t: Tables) -> DataFrame:
    return latest.first_per_key(t.lineitem, ["l_suppkey"], [F.col("l_extendedprice").desc(), F.col("l_orderkey"), F.col("l_linenumber")], 3).select("l_suppkey", "l_orderkey", "l_linenumber")


@query(
    "w10_change_compression",
    """WITH d AS (SELECT user_id, CAST(ts AS DATE) AS d, string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS s FROM events GROUP BY 1, 2),
    f AS (SELECT *, CASE WHEN s IS DISTINCT FROM lag(s) OVER (PARTITION BY user_id ORDER BY d) THEN 1 ELSE 0 END AS fresh FROM d),
    r AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY d ROWS UNBOUNDED PRECEDING) AS run FROM f)
    SELECT user_id, CAST(min(d) AS VARCHAR) AS from_day, CAST(max(d) AS VARCHAR) AS to_day, any_value(s) AS kinds, count(*) AS days FROM r GROUP BY user_id, run""",
)
def _(t: Tables) -> DataFrame:
    daily = t.events.groupBy("user_id", F.to_date("ts").alias("d")).agg(F.array_join(F.array_sort(F.collect_set("event_type")), ",").alias("kinds"))
    return intervals.changes(daily, ["user_id"], "d", "kinds").select("user_id", F.col("from").cast("string").alias("from_day"), F.col("to").cast("string").alias("to_day"), "kinds", F.col("rows").alias("days"))


# Ordering and limits


@query("o01_boolean_order", "SELECT c_custkey FROM customer ORDER BY (c_mktsegment = 'BUILDING') DESC, c_acctbal DESC, c_custkey LIMIT 20")
def _(t: Tables) -> DataFrame:
    return t.customer.orderBy((F.col("c_mktsegment") == "BUILDING").desc(), F.col("c_acctbal").desc(), "c_custkey").limit(20).select("c_custkey")


@query("o02_limit_by", "SELECT c_nationkey, c_custkey FROM customer QUALIFY row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) <= 2")
def _(t: Tables) -> DataFrame:
    return latest.first_per_key(t.customer, ["c_nationkey"], [F.col("c_acctbal").desc(), F.col("c_custkey")], 2).select("c_nationkey", "c_custkey")


@query("o03_page", "SELECT p_partkey FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 10 OFFSET 20")
def _(t: Tables) -> DataFrame:
    return filters.page(t.part, [F.col("p_retailprice").desc(), F.col("p_partkey")], page=3, size=10).select("p_partkey")


@query("o04_facets", "SELECT p_brand AS facet, count(*) AS n FROM part WHERE contains(lower(p_brand), 'brand#1') GROUP BY 1 ORDER BY starts_with(lower(p_brand), 'brand#1') DESC, n DESC, facet LIMIT 5")
def _(t: Tables) -> DataFrame:
    return filters.facets(t.part, "p_brand", "brand#1", 5)


@query("o05_key_boundaries", "SELECT o_orderkey AS boundary FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS n FROM orders) WHERE n % 250 = 0")
def _(t: Tables) -> DataFrame:
    return filters.key_boundaries(t.orders, "o_orderkey", 250)


@query("o07_recent_then_presented", "SELECT user_id, string_agg(event_type, ',' ORDER BY event_type, event_id) AS kinds FROM (SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) <= 3) GROUP BY 1")
def _(t: Tables) -> DataFrame:
    last = latest.first_per_key(t.events, ["user_id"], [F.col("ts").desc(), F.col("event_id").desc()], 3)
    ordered = F.array_sort(F.collect_list(F.struct("event_type", "event_id")))
    return last.groupBy("user_id").agg(F.array_join(F.transform(ordered, lambda x: x["event_type"]), ",").alias("kinds"))


# Set operations

_LOW, _HIGH = "SELECT c_nationkey AS k FROM customer WHERE c_acctbal < 500", "SELECT s_nationkey AS k FROM supplier WHERE s_acctbal > 5000"


def low_high(t: Tables) -> tuple[DataFrame, DataFrame]:
    return t.customer.where("c_acctbal < 500").select(F.col("c_nationkey").alias("k")), t.supplier.where("s_acctbal > 5000").select(F.col("s_nationkey").alias("k"))


@query("u01_union_all", f"{_LOW} UNION ALL {_HIGH}")
def _(t: Tables) -> DataFrame:
    a, b = low_high(t)
    return a.union(b)


@query("u02_union_distinct", f"{_LOW} UNION {_HIGH}")
def _(t: Tables) -> DataFrame:
    a, b = low_high(t)
    return a.union(b).distinct()


@query("u03_union_by_name", "SELECT c_custkey AS id, c_name AS name, NULL::VARCHAR AS kind FROM customer UNION ALL BY NAME SELECT 's' AS kind, s_suppkey AS id FROM supplier")
def _(t: Tables) -> DataFrame:
    a = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    b = t.supplier.select(F.lit("s").alias("kind"), F.col("s_suppkey").alias("id"))
    return a.unionByName(b, allowMissingColumns=True)


@query("u04_except", f"{_LOW} EXCEPT {_HIGH}")
def _(t: Tables) -> DataFrame:
    a, b = low_high(t)
    return a.subtract(b)


@query("u05_intersect", f"{_LOW} INTERSECT {_HIGH}")
def _(t: Tables) -> DataFrame:
    a, b = low_high(t)
    return a.intersect(b)


@query("u06_bag_reconcile", f"SELECT count(*) AS missing FROM ({_LOW} EXCEPT ALL {_HIGH})")
def _(t: Tables) -> DataFrame:
    a, b = low_high(t)
    return a.exceptAll(b).agg(F.count("*").alias("missing"))


# Reshaping


@query("r01_array_join", "SELECT doc_id, word FROM (SELECT doc_id, unnest(string_split(text, ' ')) AS word FROM documents) WHERE word <> ''")
def _(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", F.explode(F.split("text", " ")).alias("word")).where("word <> ''")


@query("r02_zipped_position", "SELECT doc_id, generate_subscripts(w, 1) AS pos, unnest(w) AS line FROM (SELECT doc_id, string_split(text, chr(10)) AS w FROM documents)")
def _(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line")).withColumn("pos", (F.col("pos") + 1).cast("bigint"))


@query("r03_nested_arrays", "SELECT doc_id, count(*) AS words FROM (SELECT doc_id, unnest(string_split(line, ' ')) AS w FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)) GROUP BY 1")
def _(t: Tables) -> DataFrame:
    lines = t.documents.select("doc_id", F.explode(F.split("text", "\n")).alias("line"))
    return lines.select("doc_id", F.explode(F.split("line", " ")).alias("w")).groupBy("doc_id").agg(F.count("*").alias("words"))


@query("r04_explode_in_select", "SELECT DISTINCT unnest(string_split(o_orderpriority, '-')) AS part FROM orders")
def _(t: Tables) -> DataFrame:
    return t.orders.select(F.explode(F.split("o_orderpriority", "-")).alias("part")).distinct()


@query("r05_candidate_features", "SELECT s_suppkey, kind, value FROM (SELECT s_suppkey, 'name' AS kind, lower(s_name) AS value FROM supplier UNION ALL SELECT s_suppkey, 'nation', CAST(s_nationkey AS VARCHAR) FROM supplier)")
def _(t: Tables) -> DataFrame:
    return reshape.candidates(t.supplier, ["s_suppkey"], [("name", F.lower("s_name")), ("nation", F.col("s_nationkey"))]).drop("position")


@query("r06_unpivot_position", "SELECT p_partkey, u.position, u.value FROM part, LATERAL (VALUES (0::BIGINT, p_name), (1::BIGINT, p_brand), (2::BIGINT, nullif(p_type, ''))) AS u(position, value) WHERE u.value IS NOT NULL")
def _(t: Tables) -> DataFrame:
    return reshape.candidates(t.part, ["p_partkey"], [("n", F.col("p_name")), ("b", F.col("p_brand")), ("t", F.nullif("p_type", F.lit("")))]).select("p_partkey", "position", "value")


@query("r07_list_parameter", "SELECT x AS id, c_name FROM (SELECT unnest([3, 5, 8, 999999]) AS x) LEFT JOIN customer ON c_custkey = x")
def _(t: Tables) -> DataFrame:
    given = t.spark.createDataFrame([(3,), (5,), (8,), (999999,)], "id int")
    return given.join(t.customer, F.col("id") == F.col("c_custkey"), "left").select("id", "c_name")


@query("r08_pivot", "SELECT user_id, count(*) FILTER (event_type = 'click') AS click, count(*) FILTER (event_type = 'view') AS view, count(*) FILTER (event_type = 'purchase') AS purchase FROM events GROUP BY 1")
def _(t: Tables) -> DataFrame:
    wide = t.events.groupBy("user_id").pivot("event_type", ["click", "view", "purchase"]).agg(F.count("event_id"))
    return wide.na.fill(0)


@query(
    "r09_star_assembly",
    "SELECT s_suppkey, s_name, n_name, r_name, sha256(concat_ws('|', s_name, n_name, r_name)) AS payload_hash FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey",
)
def _(t: Tables) -> DataFrame:
    star = t.supplier.join(F.broadcast(t.nation), F.col("s_nationkey") == F.col("n_nationkey")).join(F.broadcast(t.region), F.col("n_regionkey") == F.col("r_regionkey"))
    return star.select("s_suppkey", "s_name", "n_name", "r_name", F.sha2(F.concat_ws("|", "s_name", "n_name", "r_name"), 256).alias("payload_hash"))


@query("r10_json_scalars", "SELECT event_id, '/' || k AS path, 'number' AS type, CAST(json_extract(props, '$.' || k) AS VARCHAR) AS value FROM (SELECT event_id, props, unnest(json_keys(props)) AS k FROM events)")
def _(t: Tables) -> DataFrame:
    return reshape.json_scalars(t.events, "event_id", "props")


@query("r11_latest_map", "SELECT user_id, string_agg(event_type || '=' || CAST(last AS VARCHAR), ';' ORDER BY event_type) AS latest FROM (SELECT user_id, event_type, max(event_id) AS last FROM events GROUP BY 1, 2) GROUP BY 1")
def _(t: Tables) -> DataFrame:
    last = t.events.groupBy("user_id", "event_type").agg(F.max("event_id").alias("last"))
    entries = F.map_entries(F.map_from_entries(F.collect_list(F.struct("event_type", "last"))))
    return last.groupBy("user_id").agg(entries.alias("m")).select("user_id", F.array_join(F.transform(F.array_sort("m"), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string"))), ";").alias("latest"))


@query("r12_rows_to_json", """SELECT n_regionkey, '[' || string_agg('{"k":' || n_nationkey || ',"n":"' || n_name || '"}', ',' ORDER BY n_nationkey) || ']' AS nations FROM nation GROUP BY 1""")
def _(t: Tables) -> DataFrame:
    return t.nation.groupBy("n_regionkey").agg(F.to_json(F.array_sort(F.collect_list(F.struct(F.col("n_nationkey").alias("k"), F.col("n_name").alias("n"))))).alias("nations"))


@query("r13_reversed_host", "SELECT page_id, array_to_string(list_reverse(string_split(lower(regexp_extract(url, '^[a-z]+://([^/?#:]*)', 1)), '.')), '.') AS host FROM pages")
def _(t: Tables) -> DataFrame:
    return t.pages.select("page_id", net.reversed_labels(net.host_of(F.col("url"))).alias("host"))
