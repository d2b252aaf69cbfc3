"""Matching rules against values, best rule selection, DNS record routing and parsing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import net


def plain(value: Column) -> Column:
    """Trimmed, lower case, without a final dot."""
    return F.regexp_replace(F.lower(F.trim(value)), r"\.$", "")


def glob_regex(pattern: Column) -> Column:
    """A glob (* stands for anything) as a regular expression over the whole value."""
    return F.concat(F.lit("^"), F.regexp_replace(F.regexp_replace(pattern, r"([.\\+?^$()\[\]{}|])", r"\\$1"), r"\*", ".*"), F.lit("$"))


def matches(value: Column, kind: Column, pattern: Column) -> Column:
    """Whether a value satisfies a rule of kind exact, prefix, suffix (by whole labels), contains, glob (*), regex or exists."""
    v, p = plain(value), plain(pattern)
    suffix = F.regexp_replace(p, r"^\.", "")
    found = F.when(kind == "exact", v == p).when(kind == "prefix", v.startswith(p)).when(kind == "suffix", (v == suffix) | v.endswith(F.concat(F.lit("."), suffix))).when(kind == "contains", F.contains(v, p)).when(kind == "glob", F.regexp_like(v, glob_regex(p)))
    return F.when(kind == "exists", F.lit(True)).when(kind == "regex", F.regexp_like(F.regexp_replace(F.trim(value), r"\.$", ""), F.concat(F.lit("(?i)"), F.trim(pattern)))).otherwise(F.coalesce(found, F.lit(False)) & (v != ""))


#: Rules that must be tried one by one are sent to every task up to this number; beyond, Spark chooses how they meet.
MOST_SENT = 10_000


def best_rule(values: DataFrame, rules: DataFrame, value: str, keys: list[str]) -> DataFrame:
    """Each value's best matching rule: highest priority, then confidence, then the lowest rule id.

    Distinct values meet rules of kind exact, prefix and suffix by equality: with themselves, their beginnings of the
    lengths that rules have, and their label suffixes. Only contains, glob, regex and exists are tried one by one."""
    distinct = values.select(F.col(value).alias("__value")).distinct().withColumn("__plain", plain(F.col("__value")))
    known = rules.withColumn("__pattern", plain(F.col("pattern")))
    some = distinct.where("__plain <> ''")
    lengths = [r[0] for r in known.where("kind = 'prefix'").select(F.length("__pattern")).distinct().collect()]  # as many as patterns have lengths
    labels = F.split("__plain", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."))
    starts = F.array(*[F.when(F.length("__plain") >= n, F.left("__plain", F.lit(n))) for n in lengths]).cast("array<string>")
    ways = {"exact": F.array("__plain"), "prefix": F.array_compact(starts), "suffix": F.array_distinct(suffixes)}
    named = lambda kind, found: F.transform(found, lambda x: F.struct(F.lit(kind).alias("kind"), x.alias("pattern")))
    each = F.explode(F.concat(*[named(kind, found) for kind, found in ways.items()]))
    keyed = some.select("__value", each.alias("way")).select("__value", "way.kind", F.col("way.pattern").alias("__pattern"))
    equal = known.where(F.col("kind").isin("exact", "prefix", "suffix")).withColumn("__pattern", F.when(F.col("kind") == "suffix", F.regexp_replace("__pattern", r"^\.", "")).otherwise(F.col("__pattern")))
    tried = known.where(~F.col("kind").isin("exact", "prefix", "suffix"))
    one_by_one = F.broadcast(tried) if tried.limit(MOST_SENT + 1).count() <= MOST_SENT else tried
    columns = ["__value", *rules.columns]
    hits = keyed.join(equal, ["kind", "__pattern"]).select(*columns).unionByName(distinct.drop("__plain").join(one_by_one, matches(F.col("__value"), F.col("kind"), F.col("pattern"))).select(*columns))
    order = F.struct((-F.col("priority")).alias("p"), (-F.col("confidence")).alias("c"), F.col("rule_id").alias("r"))
    best = hits.groupBy("__value").agg(F.min_by(F.struct(*rules.columns), order).alias("__best")).select("__value", "__best.*")
    return values.join(best, values[value].eqNullSafe(best["__value"]), "left").drop("__value")


#: Which analyzer reads records of which types in which places; `spf` asks for a text that is such a policy.
ROUTES = (
    (("A", "AAAA"), ("apex", "www"), "ip"),
    (("CNAME",), ("apex", "www"), "cname"),
    (("CNAME", "TXT"), ("dkim",), "dkim"),
    (("MX",), ("apex",), "mx"),
    (("NS",), ("apex",), "ns"),
    (("SOA",), ("apex",), "soa"),
    (("TXT",), ("dmarc",), "dmarc"),
    (("TXT spf",), ("apex", "www", "service", "host"), "spf"),
    (("TXT",), ("apex", "service"), "txt"),
    (("TXT spf",), ("dkim",), "dkim"),
    (("TXT spf",), ("dmarc",), "dmarc"),
)


def place(name: Column, root: Column) -> Column:
    """Where a record's name stands under its domain: apex, www, dmarc, dkim (a key's name), service (another name that
    starts with an underscore), host (any other below) or outside."""
    inside = F.left(name, F.length(name) - F.length(root) - 1)
    first = F.split(inside, r"\.")[0]
    return F.when(name == root, "apex").when(~F.endswith(name, F.concat(F.lit("."), root)), "outside").when(F.endswith(inside, F.lit("._domainkey")), "dkim").when(inside == "_dmarc", "dmarc").when(inside == "www", "www").when(first.startswith("_") & (first != "_dmarc"), "service").otherwise("host")


def analyzer(name: Column, kind: Column, root: Column, value: Column) -> Column:
    """Which analyzer reads a DNS record, by its type, its place and, for texts, whether it is a sender policy; null if none."""
    table = F.create_map(*[F.lit(x) for kinds, places, to in ROUTES for k in kinds for p in places for x in (f"{k} {p}", to)])
    policy = F.regexp_like(F.regexp_replace(value, '"', ""), F.lit("(?i)^v=spf1(?: |$)"))
    typed = F.when((kind == "TXT") & F.coalesce(policy, F.lit(False)), "TXT spf").otherwise(kind)
    return F.element_at(table, F.concat_ws(" ", typed, place(name, root)))


def spf_terms(value: Column) -> Column:
    """Array of (name, argument) of an SPF record's terms after the version, qualifiers stripped."""
    terms = F.filter(F.split(F.lower(F.regexp_replace(value, '"', "")), r"\s+"), lambda t: t != "")
    bare = F.transform(F.slice(terms, 2, F.greatest(F.size(terms), F.lit(1))), lambda t: F.regexp_replace(t, r"^[+\-~?]+", ""))
    return F.transform(bare, lambda t: F.struct(F.regexp_extract(t, "^([^:=]*)", 1).alias("name"), F.regexp_extract(t, "^[^:=]*[:=](.*)$", 1).alias("argument")))


def spf_lookups(value: Column) -> Column:
    return F.size(F.filter(spf_terms(value), lambda t: t["name"].isin("include", "redirect", "a", "mx", "ptr", "exists")))


def spf_findings(value: Column, root: Column, budget: int = 10) -> Column:
    terms = spf_terms(value)
    macros = F.transform(F.filter(terms, lambda t: F.contains(t["argument"], F.lit("%{"))), lambda t: F.lit("spf_macro"))
    within = F.transform(F.filter(terms, lambda t: t["name"].isin("include", "redirect") & ~F.contains(t["argument"], F.lit("%{")) & net.under(t["argument"], root)), lambda t: F.lit("spf_include_within_domain"))
    over = F.when(spf_lookups(value) > budget, F.array(F.lit("spf_lookup_budget_exceeded"))).otherwise(F.array().cast("array<string>"))
    return F.concat(macros, within, over)


def dmarc_hosts(value: Column, root: Column) -> Column:
    """Hosts outside the domain that a DMARC record reports to; null if it isn't a DMARC record."""
    tags = F.split(F.regexp_replace(value, '"', ""), ";")
    good = F.regexp_like(tags[0], F.lit(r"(?i)^\s*v\s*=\s*dmarc1\s*$"))
    wanted = F.filter(tags, lambda t: F.regexp_like(t, F.lit(r"(?i)^\s*ru[af]\s*=")))
    uris = F.flatten(F.transform(wanted, lambda t: F.split(F.regexp_replace(t, r"^[^=]*=", ""), ",")))
    mail = F.transform(F.filter(uris, lambda u: F.regexp_like(u, F.lit(r"(?i)^\s*mailto:"))), lambda u: F.regexp_replace(F.regexp_replace(F.trim(u), "(?i)^mailto:", ""), "[!?].*$", ""))
    hosts = F.transform(F.filter(mail, lambda a: F.contains(a, F.lit("@"))), lambda a: plain(F.element_at(F.split(a, "@"), -1)))
    return F.when(good, F.filter(hosts, lambda h: F.regexp_like(h, F.lit(r"^[a-z0-9_](?:[a-z0-9_-]*[a-z0-9_])?(?:\.[a-z0-9_](?:[a-z0-9_-]*[a-z0-9_])?)+$")) & ~net.under(h, root)))


def lifecycle(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """What happened to each item between two snapshots (key, status, content): one kind of change, or none."""
    joined = before.select(key, F.col("status").alias("was"), F.col("content").alias("had"), F.lit(1).alias("in_before")).join(after.select(key, F.col("status").alias("now"), F.col("content").alias("has"), F.lit(1).alias("in_after")), key, "full")
    new, gone = F.col("in_before").isNull(), F.col("in_after").isNull()
    kind = F.when(gone, "purged").when(new & (F.col("now") == "removed"), "removed").when(new, "added").when((F.col("was") != "missing") & (F.col("now") == "missing"), "missing").when((F.col("was") == "missing") & (F.col("now") == "active"), "reappeared").when((F.col("was") == "removed") & (F.col("now") == "active"), "restored").when((F.col("was") != "removed") & (F.col("now") == "removed"), "removed").when(~F.col("had").eqNullSafe(F.col("has")), "updated")
    return joined.select(key, kind.alias("change")).where(F.col("change").isNotNull())
