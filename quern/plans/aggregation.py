"""Aggregations, quality checks and publication over the evaluation tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import checks, reshape, rollups
from ..functions import vectors
from .catalog import Tables, query
from .relational import total


@query("a01_group_by", "SELECT l_returnflag, l_linestatus, count(*) AS n, min(l_quantity) AS least, max(l_quantity) AS most, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,4))) AS DOUBLE) AS price FROM lineitem GROUP BY 1, 2")
def _(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), F.min("l_quantity").alias("least"), F.max("l_quantity").alias("most"), total(F.col("l_extendedprice")).alias("price"))


@query("a02_distinct_tuples", "SELECT l_returnflag, count(DISTINCT (l_partkey, l_suppkey)) AS pairs FROM lineitem GROUP BY 1")
def _(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_returnflag").agg(F.countDistinct("l_partkey", "l_suppkey").alias("pairs"))


@query(
    "a03_conditional",
    """SELECT o_orderpriority, count(*) FILTER (o_orderstatus = 'F') AS closed, min(o_totalprice) FILTER (o_orderstatus = 'O') AS least_open, max(o_orderkey) FILTER (o_totalprice > 1000) AS last_big,
    count(DISTINCT o_custkey) FILTER (o_orderstatus = 'O') AS customers, CAST(sum(CAST(CASE WHEN o_orderstatus = 'F' THEN o_totalprice END AS DECIMAL(18,4))) AS DOUBLE) AS closed_total FROM orders GROUP BY 1""",
)
def _(t: Tables) -> DataFrame:
    opened, closed = F.col("o_orderstatus") == "O", F.col("o_orderstatus") == "F"
    return t.orders.groupBy("o_orderpriority").agg(
        F.count_if(closed).alias("closed"), F.min(F.when(opened, F.col("o_totalprice"))).alias("least_open"), F.max(F.when(F.col("o_totalprice") > 1000, F.col("o_orderkey"))).alias("last_big"),
        F.countDistinct(F.when(opened, F.col("o_custkey"))).alias("customers"), total(F.when(closed, F.col("o_totalprice"))).alias("closed_total"),
    )


@query("a04_filter_clause", "SELECT c_nationkey, count(*) FILTER (WHERE c_acctbal < 0) AS debtors, string_agg(c_mktsegment, ',' ORDER BY c_mktsegment, c_custkey) FILTER (WHERE c_acctbal < 0) AS segments FROM customer GROUP BY 1")
def _(t: Tables) -> DataFrame:
    t.customer.createOrReplaceTempView("customer_filter_clause")
    return t.spark.sql("SELECT c_nationkey, count(*) FILTER (WHERE c_acctbal < 0) AS debtors, listagg(c_mktsegment, ',') WITHIN GROUP (ORDER BY c_mktsegment) FILTER (WHERE c_acctbal < 0) AS segments FROM customer_filter_clause GROUP BY 1")


@query("a05_arg_max", "SELECT o_custkey, arg_max(o_orderkey, (o_totalprice, -o_orderkey)) AS largest, arg_min(o_orderpriority, (o_orderdate, o_orderkey)) AS first_priority FROM orders GROUP BY 1")
def _(t: Tables) -> DataFrame:
    return t.orders.groupBy("o_custkey").agg(F.max_by("o_orderkey", F.struct("o_totalprice", -F.col("o_orderkey"))).alias("largest"), F.min_by("o_orderpriority", F.struct("o_orderdate", "o_orderkey")).alias("first_priority"))


@query("a06_arg_max_if", "SELECT o_custkey, arg_max(o_orderkey, (o_orderdate, o_orderkey)) FILTER (o_orderstatus = 'F') AS last_closed FROM orders GROUP BY 1")
def _(t: Tables) -> DataFrame:
    return t.orders.groupBy("o_custkey").agg(F.max_by("o_orderkey", F.when(F.col("o_orderstatus") == "F", F.struct("o_orderdate", "o_orderkey"))).alias("last_closed"))


@query("a07_any_value", "SELECT n_regionkey, count(*) AS n, any_value(n_regionkey) AS same FROM nation GROUP BY 1")
def _(t: Tables) -> DataFrame:
    return t.nation.groupBy("n_regionkey").agg(F.count("*").alias("n"), F.any_value("n_regionkey").alias("same"))


@query("a08_sorted_sets", "SELECT user_id, array_to_string(list_sort(list(DISTINCT event_type)), ',') AS kinds FROM events GROUP BY 1")
def _(t: Tables) -> DataFrame:
    return t.events.groupBy("user_id").agg(F.array_join(F.sort_array(F.collect_set("event_type")), ",").alias("kinds"))


@query("a09_ordered_strings", "SELECT l_orderkey, string_agg(CAST(l_partkey AS VARCHAR), '|' ORDER BY l_linenumber, l_partkey) AS parts FROM lineitem GROUP BY 1")
def _(t: Tables) -> DataFrame:
    ordered = F.sort_array(F.collect_list(F.struct("l_linenumber", "l_partkey")))
    return t.lineitem.groupBy("l_orderkey").agg(F.array_join(F.transform(ordered, lambda x: x["l_partkey"].cast("string")), "|").alias("parts"))


@query("a10_set_union", "SELECT n_regionkey, string_agg(DISTINCT c_mktsegment, ',' ORDER BY c_mktsegment) AS segments FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1")
def _(t: Tables) -> DataFrame:
    per_nation = t.customer.groupBy("c_nationkey").agg(F.collect_set("c_mktsegment").alias("s"))
    joined = per_nation.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.groupBy("n_regionkey").agg(F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_list("s")))), ",").alias("segments"))


@query("a11_median", "SELECT l_returnflag, median(l_quantity) AS middle, quantile_cont(l_quantity, 0.95) AS high FROM lineitem GROUP BY 1")
def _(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_returnflag").agg(F.median("l_quantity").alias("middle"), F.percentile("l_quantity", 0.95).alias("high"))


@query("a12_streamed_quantile")
def _(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_returnflag").agg(F.percentile_approx("l_extendedprice", 0.95, 10_000).alias("high"))


@query("a13_sum_of_maps", "SELECT event_type, k AS key, CAST(sum(CAST(json_extract(props, '$.' || k) AS BIGINT)) AS BIGINT) AS value FROM (SELECT event_type, props, unnest(json_keys(props)) AS k FROM events) GROUP BY 1, 2")
def _(t: Tables) -> DataFrame:
    maps = t.events.select("event_type", F.from_json("props", "map<string,bigint>").alias("m"))
    return reshape.sum_maps(maps, ["event_type"], "m").select("event_type", F.explode("m").alias("key", "value"))


@query("a14_bool_or", "SELECT user_id, bool_or(event_type = 'purchase') AS bought, bool_and(value > 0) AS positive FROM events GROUP BY 1")
def _(t: Tables) -> DataFrame:
    return t.events.groupBy("user_id").agg(F.bool_or(F.col("event_type") == "purchase").alias("bought"), F.bool_and(F.col("value") > 0).alias("positive"))


_ROLLUP = """WITH per AS (SELECT o_orderkey, l_returnflag AS source, max(o_orderpriority) AS o_orderpriority, max(o_orderstatus) AS o_orderstatus, min(l_suppkey) AS first_winner, count(DISTINCT l_suppkey) AS winners,
    max(CAST(l_shipdate AS DATE)) AS day, coalesce(CAST(sum(CAST(CASE WHEN l_quantity > 5 THEN l_extendedprice END AS DECIMAL(18,4))) AS DOUBLE), -1.0) AS priority FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1, 2),
    best AS (SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY priority DESC, source) AS n FROM per)
    SELECT o_orderkey, source, o_orderpriority, o_orderstatus, first_winner, winners, CAST(day AS VARCHAR) AS day, nullif(priority, -1.0) AS amount FROM best WHERE n = 1"""


def contract_rollup(t: Tables) -> DataFrame:
    lines = t.lineitem.withColumn("amount", F.when(F.col("l_quantity") > 5, F.col("l_extendedprice"))).select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_returnflag").alias("source"), "l_suppkey", F.to_date("l_shipdate").alias("ship"), "amount")
    facts = t.orders.select("o_orderkey", "o_orderpriority", "o_orderstatus").join(lines, "o_orderkey")
    found = rollups.per_source_then_best(facts, "o_orderkey", "source", ["o_orderpriority", "o_orderstatus"], "l_suppkey", "amount", "ship")
    return found.withColumn("day", F.col("day").cast("string"))


query("contract_rollup", _ROLLUP)(contract_rollup)
query("a15_two_level_priority", _ROLLUP)(contract_rollup)


@query("a16_having", "SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1 HAVING n >= 3 AND max(o_totalprice) > 100000")
def _(t: Tables) -> DataFrame:
    return t.orders.groupBy("o_custkey").agg(F.count("*").alias("n"), F.max("o_totalprice").alias("m")).where("n >= 3 and m > 100000").drop("m")


@query(
    "a17_grouping_sets",
    "SELECT l_returnflag, CASE WHEN grouping(l_linestatus) = 1 THEN '' ELSE l_linestatus END AS status, count(DISTINCT l_suppkey) AS suppliers, count(DISTINCT l_suppkey) FILTER (l_quantity > 25) AS bulk FROM lineitem GROUP BY GROUPING SETS ((l_returnflag, l_linestatus), (l_returnflag))",
)
def _(t: Tables) -> DataFrame:
    sets = [[F.col("l_returnflag"), F.col("l_linestatus")], [F.col("l_returnflag")]]
    grouped = t.lineitem.groupingSets(sets, "l_returnflag", "l_linestatus").agg(F.grouping("l_linestatus").alias("g"), F.countDistinct("l_suppkey").alias("suppliers"), F.countDistinct(F.when(F.col("l_quantity") > 25, F.col("l_suppkey"))).alias("bulk"))
    return grouped.select("l_returnflag", F.when(F.col("g") == 1, "").otherwise(F.col("l_linestatus")).alias("status"), "suppliers", "bulk")


@query("a18_distinct_on", "SELECT DISTINCT ON (p_brand) p_brand, p_partkey FROM part ORDER BY p_brand, p_retailprice DESC, p_partkey")
def _(t: Tables) -> DataFrame:
    return t.part.groupBy("p_brand").agg(F.min_by("p_partkey", F.struct(-F.col("p_retailprice"), "p_partkey")).alias("p_partkey"))


@query("a19_conditional_pivot", "SELECT c_nationkey, max(c_acctbal) FILTER (c_mktsegment = 'BUILDING') AS building, max(c_acctbal) FILTER (c_mktsegment = 'MACHINERY') AS machinery FROM customer GROUP BY 1")
def _(t: Tables) -> DataFrame:
    wide = reshape.long_to_wide(t.customer, ["c_nationkey"], "c_mktsegment", "c_acctbal", ["BUILDING", "MACHINERY"])
    return wide.select("c_nationkey", F.col("BUILDING").alias("building"), F.col("MACHINERY").alias("machinery"))


@query("a20_partial_states", "SELECT user_id, min(event_id) AS first_seen, max(event_id) AS last_seen, string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS kinds FROM events GROUP BY 1")
def _(t: Tables) -> DataFrame:
    daily = t.events.groupBy("user_id", F.to_date("ts").alias("d")).agg(F.min("event_id").alias("f"), F.max("event_id").alias("l"), F.collect_set("event_type").alias("k"))
    return daily.groupBy("user_id").agg(F.min("f").alias("first_seen"), F.max("l").alias("last_seen"), F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_list("k")))), ",").alias("kinds"))


@query("a21_idempotent_merge", "SELECT user_id, min(ts) AS first_seen, max(ts) AS last_seen FROM events GROUP BY 1")
def _(t: Tables) -> DataFrame:
    replayed = t.events.unionByName(t.events.where("event_id % 3 = 0"))
    return replayed.groupBy("user_id").agg(F.min("ts").alias("first_seen"), F.max("ts").alias("last_seen"))


@query("a22_group_fingerprint", "SELECT l_orderkey, sha256(string_agg(r, chr(10) ORDER BY r)) AS state FROM (SELECT l_orderkey, concat_ws('|', CAST(l_linenumber AS VARCHAR), CAST(l_partkey AS VARCHAR), l_returnflag) AS r FROM lineitem) GROUP BY 1")
def _(t: Tables) -> DataFrame:
    return rollups.state_hash(t.lineitem, "l_orderkey", ["l_linenumber", "l_partkey", "l_returnflag"])


@query("a23_rarity", "SELECT l_orderkey, l_partkey FROM lineitem WHERE l_partkey IN (SELECT l_partkey FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_suppkey) <= 20) GROUP BY 1, 2")
def _(t: Tables) -> DataFrame:
    rare = t.lineitem.groupBy("l_partkey").agg(F.countDistinct("l_suppkey").alias("n")).where("n <= 20")
    return t.lineitem.join(rare, "l_partkey", "left_semi").select("l_orderkey", "l_partkey").distinct()


@query("a24_group_by_all", "SELECT p_brand, p_type, count(*) AS n FROM part GROUP BY ALL")
def _(t: Tables) -> DataFrame:
    t.part.createOrReplaceTempView("part_group_by_all")
    return t.spark.sql("SELECT p_brand, p_type, count(*) AS n FROM part_group_by_all GROUP BY ALL")


@query("a25_vector_statistics")
def _(t: Tables) -> DataFrame:
    width = len(t.embeddings.select("embedding").first()[0])
    return vectors.spread_statistics(t.embeddings, "embedding", width)


@query("a26_rollup_cube", "SELECT coalesce(l_returnflag, '') AS flag, coalesce(l_linestatus, '') AS status, count(*) AS n FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)")
def _(t: Tables) -> DataFrame:
    return t.lineitem.cube("l_returnflag", "l_linestatus").agg(F.count("*").alias("n")).select(F.coalesce("l_returnflag", F.lit("")).alias("flag"), F.coalesce("l_linestatus", F.lit("")).alias("status"), "n")


# Quality checks


@query(
    "q_checks",
    """SELECT 'not_empty' AS "check", 0::BIGINT AS failures UNION ALL SELECT 'at_least', CAST((SELECT count(*) < 10 FROM supplier) AS BIGINT)
    UNION ALL SELECT 'unique', (SELECT count(*) - count(DISTINCT o_custkey) FROM orders) UNION ALL SELECT 'duplicate_keys', (SELECT count(*) FROM (SELECT o_custkey FROM orders GROUP BY 1 HAVING count(*) > 1))
    UNION ALL SELECT 'orphans', (SELECT count(*) FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier)) UNION ALL SELECT 'not_null_text', (SELECT count(*) FROM documents WHERE text IS NULL)
    UNION ALL SELECT 'accepted_o_orderstatus', (SELECT count(*) FROM orders WHERE o_orderstatus NOT IN ('F', 'O')) UNION ALL SELECT 'positive', (SELECT count(*) FROM events WHERE NOT coalesce(value > 1, false))""",
)
def _(t: Tables) -> DataFrame:
    return checks.all_of(
        checks.not_empty(t.supplier), checks.at_least(t.supplier, 10), checks.unique(t.orders, ["o_custkey"]), checks.duplicate_keys(t.orders, ["o_custkey"]), checks.orphans(t.lineitem, t.supplier, "l_suppkey", "s_suppkey"),
        checks.not_null(t.documents, "text"), checks.accepted(t.orders, "o_orderstatus", ["F", "O"]), checks.holds(t.events, "positive", F.col("value") > 1),
    )


@query("q02_freshness", """SELECT 'fresh' AS "check", CAST((SELECT max(ts) < TIMESTAMP '2024-02-01' - INTERVAL 9 DAYS FROM events) AS BIGINT) AS failures""")
def _(t: Tables) -> DataFrame:
    return checks.fresh(t.events, "ts", F.lit("2024-02-01").cast("timestamp"), 9)


@query("q07_unknown_values", "SELECT DISTINCT event_type FROM events WHERE event_type NOT IN ('click', 'view')")
def _(t: Tables) -> DataFrame:
    return checks.unknown_values(t.events, "event_type", ["click", "view"])


@query("q08_shape_invariants", "SELECT count(*) AS customers, count(DISTINCT c_custkey) AS keys, count(*) FILTER (c_mktsegment IS NULL) AS blanks, count(DISTINCT c_mktsegment) AS segments FROM customer")
def _(t: Tables) -> DataFrame:
    return t.customer.agg(F.count("*").alias("customers"), F.countDistinct("c_custkey").alias("keys"), F.count_if(F.col("c_mktsegment").isNull()).alias("blanks"), F.countDistinct("c_mktsegment").alias("segments"))


@query("q09_p18_assertions", "SELECT count(*) AS n FROM orders")
def _(t: Tables) -> DataFrame:
    return checks.require(t.orders, F.col("o_totalprice").isNotNull(), "an order has no price").agg(F.count("*").alias("n"))


@query("p19_row_constraints", "SELECT count(*) FILTER (NOT json_valid(props) OR event_type = '') AS violations FROM events")
def _(t: Tables) -> DataFrame:
    bad = F.try_parse_json("props").isNull() | (F.col("event_type") == "")
    return t.events.agg(F.count_if(bad).alias("violations"))


@query("v12_table_checksum", "SELECT count(*) AS rows, true AS equal FROM orders")
def _(t: Tables) -> DataFrame:
    source, target = checks.fingerprint(t.orders), checks.fingerprint(t.orders.repartition(5))
    return source.alias("s").crossJoin(target.alias("t")).select(F.col("s.rows").alias("rows"), ((F.col("s.sum") == F.col("t.sum")) & (F.col("s.xor") == F.col("t.xor"))).alias("equal"))
