"""The scalar functions that queries are made of, each beside another engine's answer, and publication as queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources import publish
from .catalog import Tables, query


@query(
    "x_string_functions",
    """SELECT p_partkey, concat_ws('-', p_brand, p_type) AS joined, upper(p_name) AS up, lower(p_name) AS low, length(p_name) AS chars, left(p_name, 3) AS head, right(p_name, 3) AS tail, substr(p_name, 2, 4) AS middle,
    lpad(CAST(p_size AS VARCHAR), 4, '0') AS padded, trim('  ' || p_brand || ' ') AS trimmed, rtrim(p_brand || '  ') AS rtrimmed, split_part(p_name, ' ', 1) AS first_word, repeat('ab', 2) AS twice, reverse(p_brand) AS backwards,
    CAST(strpos(p_name, 'a') AS BIGINT) AS at, regexp_replace(p_name, '[aeiou]', '', 'g') AS no_vowels, regexp_extract(p_brand, '([0-9]+)', 1) AS digits FROM part""",
)
def _(t: Tables) -> DataFrame:
    name, brand = F.col("p_name"), F.col("p_brand")
    return t.part.select(
        "p_partkey", F.concat_ws("-", "p_brand", "p_type").alias("joined"), F.upper(name).alias("up"), F.lower(name).alias("low"), F.char_length(name).cast("bigint").alias("chars"), F.left(name, F.lit(3)).alias("head"), F.right(name, F.lit(3)).alias("tail"),
        F.substring(name, 2, 4).alias("middle"), F.lpad(F.col("p_size").cast("string"), 4, "0").alias("padded"), F.trim(F.concat(F.lit("  "), brand, F.lit(" "))).alias("trimmed"), F.rtrim(F.concat(brand, F.lit("  "))).alias("rtrimmed"),
        F.split_part(name, F.lit(" "), F.lit(1)).alias("first_word"), F.repeat(F.lit("ab"), 2).alias("twice"), F.reverse(brand).alias("backwards"), F.instr(name, "a").cast("bigint").alias("at"), F.regexp_replace(name, "[aeiou]", "").alias("no_vowels"),
        F.regexp_extract(brand, "([0-9]+)", 1).alias("digits"),
    )


@query(
    "x_array_functions",
    """WITH a AS (SELECT user_id, list_sort(list(event_id % 7)) AS xs, list_sort(list(DISTINCT event_id % 5)) AS ys FROM events GROUP BY 1)
    SELECT user_id, list_contains(xs, 3) AS has3, len(xs) AS n, array_to_string(list_distinct_sorted, ',') AS uniq, CAST(list_sum(xs) AS BIGINT) AS total, len(list_filter(xs, lambda x: x > 3)) AS big, xs[1] AS first, xs[-1] AS last,
    array_to_string(list_sort(list_intersect(xs, ys)), ',') AS common, array_to_string(list_transform(ys, lambda y: y * 2), ',') AS doubled, len(list_filter(ys, lambda y: y < 0)) = 0 AS all_positive, array_to_string(list_reverse(ys), ',') AS backwards, array_to_string(list_slice(xs, 1, 2), ',') AS head
    FROM (SELECT *, list_sort(list_distinct(xs)) AS list_distinct_sorted FROM a)""",
)
def _(t: Tables) -> DataFrame:
    xs, ys = F.col("xs"), F.col("ys")
    sets = t.events.groupBy("user_id").agg(F.array_sort(F.collect_list(F.col("event_id") % 7)).alias("xs"), F.array_sort(F.collect_set(F.col("event_id") % 5)).alias("ys"))
    text = lambda a: F.array_join(F.transform(a, lambda x: x.cast("string")), ",")
    return sets.select(
        "user_id", F.array_contains(xs, 3).alias("has3"), F.size(xs).cast("bigint").alias("n"), text(F.array_sort(F.array_distinct(xs))).alias("uniq"), F.aggregate(xs, F.lit(0).cast("bigint"), lambda a, b: a + b).alias("total"), F.size(F.filter(xs, lambda x: x > 3)).cast("bigint").alias("big"),
        F.element_at(xs, 1).alias("first"), F.element_at(xs, -1).alias("last"), text(F.array_sort(F.array_intersect(xs, ys))).alias("common"), text(F.transform(ys, lambda y: y * 2)).alias("doubled"), F.forall(ys, lambda y: y >= 0).alias("all_positive"), text(F.reverse(ys)).alias("backwards"), text(F.slice(xs, 1, 2)).alias("head"),
    )


@query(
    "x_date_functions",
    """SELECT o_orderkey, CAST(extract(year FROM o_orderdate) AS BIGINT) AS y, strftime(o_orderdate, '%Y%m') AS ym, CAST(CAST(date_trunc('month', o_orderdate) AS DATE) AS VARCHAR) AS month_start, CAST(CAST(o_orderdate AS DATE) + 10 AS VARCHAR) AS later,
    CAST(date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) AS BIGINT) AS days, CAST(epoch(o_orderdate) AS BIGINT) AS seconds, CAST(make_date(CAST(extract(year FROM o_orderdate) AS INTEGER), 12, 31) AS VARCHAR) AS year_end, TRY_CAST('not a date' AS DATE) IS NULL AS bad,
    CAST(coalesce(TRY_CAST('x' AS DATE), DATE '1970-01-01') AS VARCHAR) AS or_zero FROM orders""",
)
def _(t: Tables) -> DataFrame:
    at = F.col("o_orderdate")
    day = F.to_date(at)
    return t.orders.select(
        "o_orderkey", F.year(at).cast("bigint").alias("y"), F.date_format(at, "yyyyMM").alias("ym"), F.trunc(day, "MM").cast("string").alias("month_start"), F.date_add(day, 10).cast("string").alias("later"), F.date_diff(day, F.lit("1995-01-01").cast("date")).cast("bigint").alias("days"),
        F.unix_timestamp(at.cast("timestamp")).alias("seconds"), F.make_date(F.year(at), F.lit(12), F.lit(31)).cast("string").alias("year_end"), F.lit("not a date").try_cast("date").isNull().alias("bad"), F.coalesce(F.lit("x").try_cast("date"), F.lit("1970-01-01").cast("date")).cast("string").alias("or_zero"),
    )


@query(
    "x_conversion_functions",
    """SELECT c_custkey, TRY_CAST(c_mktsegment AS INTEGER) IS NULL AS no_number, CAST(c_acctbal AS DECIMAL(18,2))::DOUBLE AS money, CAST(CAST(c_acctbal AS BIGINT) AS VARCHAR) AS whole, greatest(c_acctbal, 0) AS floored, least(c_nationkey, 10) AS capped,
    md5(c_name) AS m, sha256(c_name) AS s, upper(hex(c_name)) AS h, c_custkey % 7 AS remainder, round(sqrt(abs(c_acctbal)), 6) AS root, round(pow(c_nationkey, 2), 0) AS square, (CASE WHEN c_name IS NOT NULL THEN 1 ELSE 0 END) + (CASE WHEN nullif(c_nationkey, 3) IS NOT NULL THEN 1 ELSE 0 END) AS known FROM customer""",
)
def _(t: Tables) -> DataFrame:
    name, money = F.col("c_name"), F.col("c_acctbal")
    return t.customer.select(
        "c_custkey", F.col("c_mktsegment").try_cast("int").isNull().alias("no_number"), money.cast("decimal(18,2)").cast("double").alias("money"), F.rint(money).cast("bigint").cast("string").alias("whole"), F.greatest(money, F.lit(0.0)).alias("floored"), F.least("c_nationkey", F.lit(10)).alias("capped"),
        F.md5(name).alias("m"), F.sha2(name, 256).alias("s"), F.hex(name).alias("h"), (F.col("c_custkey") % 7).alias("remainder"), F.round(F.sqrt(F.abs(money)), 6).alias("root"), F.round(F.pow("c_nationkey", F.lit(2)), 0).alias("square"),
        (name.isNotNull().cast("int") + F.nullif("c_nationkey", F.lit(3)).isNotNull().cast("int")).alias("known"),
    )


@query(
    "x_json_functions",
    """SELECT event_id, json_valid(props) AS valid, json_type(props) AS kind, CAST(len(json_keys(props)) AS BIGINT) AS keys, json_extract_string(props, '$.k') AS k, CAST(json_extract(props, '$.k') AS BIGINT) AS number, json_exists(props, '$.k') AS has, '{"type":"' || event_type || '","user":' || user_id || '}' AS built FROM events""",
)
def _(t: Tables) -> DataFrame:
    p = F.col("props")
    value = F.get_json_object(p, "$.k")
    kind = F.when(F.schema_of_variant(F.try_parse_json(p)).startswith("OBJECT"), "OBJECT")
    return t.events.select("event_id", F.try_parse_json(p).isNotNull().alias("valid"), kind.alias("kind"), F.size(F.from_json(p, "map<string,string>")).cast("bigint").alias("keys"), value.alias("k"), value.try_cast("bigint").alias("number"), value.isNotNull().alias("has"), F.to_json(F.struct(F.col("event_type").alias("type"), F.col("user_id").alias("user"))).alias("built"))


@query("x_url_functions", "SELECT page_id, regexp_extract(url, '^([a-z]+)://', 1) AS protocol, lower(regexp_extract(url, '^[a-z]+://([^/?#:]*)', 1)) AS host, regexp_replace(url, '#.*$', '') AS plain, contains(url, '?') AS has_query FROM pages")
def _(t: Tables) -> DataFrame:
    u = F.col("url")
    return t.pages.select("page_id", F.parse_url(u, F.lit("PROTOCOL")).alias("protocol"), F.lower(F.parse_url(u, F.lit("HOST"))).alias("host"), F.regexp_replace(u, "#.*$", "").alias("plain"), F.parse_url(u, F.lit("QUERY")).isNotNull().alias("has_query"))


@query("x_lookup_default", "SELECT s_suppkey, coalesce(n_name, 'unknown') AS nation FROM supplier LEFT JOIN (SELECT * FROM nation WHERE n_nationkey < 12) n ON s_nationkey = n_nationkey")
def _(t: Tables) -> DataFrame:
    return t.supplier.join(F.broadcast(t.nation.where("n_nationkey < 12")), F.col("s_nationkey") == F.col("n_nationkey"), "left").select("s_suppkey", F.coalesce("n_name", F.lit("unknown")).alias("nation"))


# Publication


def loads(t: Tables) -> tuple[DataFrame, DataFrame]:
    """A table as it was and a later load of it."""
    k = F.col("c_custkey")
    old = t.customer.where(k % 10 != 0).select(k.alias("k"), F.col("c_mktsegment").alias("v"), F.lit(1).alias("at"))
    new = t.customer.where(k % 7 != 0).select(k.alias("k"), F.when(k % 3 == 0, F.lit("changed")).otherwise(F.col("c_mktsegment")).alias("v"), F.lit(2).alias("at"))
    return old, new


_LOADS = "WITH o AS (SELECT c_custkey AS k, c_mktsegment AS v, 1 AS at_ FROM customer WHERE c_custkey % 10 <> 0), n AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 3 = 0 THEN 'changed' ELSE c_mktsegment END AS v, 2 AS at_ FROM customer WHERE c_custkey % 7 <> 0) "


@query("k04_window_reload", _LOADS + 'SELECT k, v, at_ AS "at" FROM o WHERE NOT k BETWEEN 20 AND 60 UNION ALL SELECT k, v, at_ FROM n WHERE k BETWEEN 20 AND 60')
def _(t: Tables) -> DataFrame:
    old, new = loads(t)
    return publish.replace_window(old, new, F.col("k").between(20, 60))


@query("k05_upsert", _LOADS + 'SELECT coalesce(n.k, o.k) AS k, CASE WHEN n.k IS NULL THEN o.v ELSE n.v END AS v, CASE WHEN n.k IS NULL OR n.v IS NOT DISTINCT FROM o.v AND o.k IS NOT NULL THEN o.at_ ELSE n.at_ END AS "at" FROM n FULL JOIN o ON n.k = o.k')
def _(t: Tables) -> DataFrame:
    return publish.upsert(*loads(t), ["k"], "at")


@query("k06_absent_rows", _LOADS + "SELECT k, v FROM o WHERE k NOT IN (SELECT k FROM n)")
def _(t: Tables) -> DataFrame:
    return publish.absent(*loads(t), ["k"]).select("k", "v")


@query("k07_missing_keys", _LOADS + "SELECT k, v FROM n WHERE k NOT IN (SELECT k FROM o)")
def _(t: Tables) -> DataFrame:
    return publish.missing_keys(*loads(t), ["k"]).select("k", "v")


@query("k12_retention", "SELECT o_orderkey FROM orders WHERE CAST(o_orderdate AS DATE) + 90 >= DATE '1998-01-01'")
def _(t: Tables) -> DataFrame:
    return publish.unexpired(t.orders.withColumn("until", F.to_date("o_orderdate")), "until", 90, F.lit("1998-01-01").cast("date")).select("o_orderkey")


@query("v14_delta_load", _LOADS + "SELECT count(*) AS rows, count(*) FILTER (v = 'changed') AS changed FROM (SELECT coalesce(n.k, o.k) AS k, coalesce(n.v, o.v) AS v FROM n FULL JOIN o ON n.k = o.k)")
def _(t: Tables) -> DataFrame:
    return publish.upsert(*loads(t), ["k"], "at").agg(F.count("*").alias("rows"), F.count_if(F.col("v") == "changed").alias("changed"))


@query("w11_other_windows", "SELECT o_orderkey, rank() OVER w AS r, dense_rank() OVER w AS d, ntile(4) OVER w AS quarter, lag(o_orderkey) OVER w AS before, lead(o_orderkey) OVER w AS after, first_value(o_orderkey) OVER w AS first FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)")
def _(t: Tables) -> DataFrame:
    w = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")
    return t.orders.select("o_orderkey", F.rank().over(w).cast("bigint").alias("r"), F.dense_rank().over(w).cast("bigint").alias("d"), F.ntile(4).over(w).cast("bigint").alias("quarter"), F.lag("o_orderkey").over(w).alias("before"), F.lead("o_orderkey").over(w).alias("after"), F.first("o_orderkey").over(w).alias("first"))
