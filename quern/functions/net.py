"""Addresses, hosts and URLs."""

from __future__ import annotations

import ipaddress
import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import types as T
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

# Suffixes of two labels under which domains are registered; a small part of the public suffix list.
TWO_LABEL_SUFFIXES = ["co.uk", "org.uk", "ac.uk", "gov.uk", "com.br", "com.au", "net.au", "org.au", "co.jp", "co.nz", "co.za", "com.mx", "com.tr", "com.ar", "co.in", "com.cn"]


def ipv4_number(address: Column) -> Column:
    """An IPv4 address as a number; null if it isn't one."""
    octet = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
    part = F.split(address, r"\.")
    number = sum((F.element_at(part, k + 1).cast("bigint") * (1 << (24 - 8 * k)) for k in range(4)), F.lit(0))
    return F.when(address.rlike(rf"^{octet}(?:\.{octet}){{3}}$"), number)


def ipv4_text(number: Column) -> Column:
    return F.concat_ws(".", *[F.shiftright(number, s).bitwiseAND(F.lit(255)).cast("string") for s in (24, 16, 8, 0)])


def _size(bits: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), 32 - bits)


def cidr_first(cidr: Column) -> Column:
    bits = F.split(cidr, "/")[1].cast("int")
    size = _size(bits)
    number = ipv4_number(F.split(cidr, "/")[0])
    return number - F.pmod(number, size)


def cidr_last(cidr: Column) -> Column:
    bits = F.split(cidr, "/")[1].cast("int")
    return cidr_first(cidr) + _size(bits) - 1


@pandas_udf(T.StructType([T.StructField("first", T.StringType()), T.StructField("last", T.StringType())]))
def ipv6_range(cidrs: pd.Series) -> pd.DataFrame:
    """First and last address of an IPv6 network as 32 hexadecimal digits, which order like the addresses; nulls if it isn't one."""
    def bounds(cidr: str | None) -> tuple[str | None, str | None]:
        try:
            net = ipaddress.IPv6Network(cidr, strict=False)
        except (ValueError, TypeError):
            return None, None
        return f"{int(net[0]):032x}", f"{int(net[-1]):032x}"

    return pd.DataFrame([bounds(c) for c in cidrs], columns=["first", "last"])


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def reversed_labels(host: Column) -> Column:
    return F.array_join(F.reverse(F.split(host, r"\.")), ".")


def registrable(host: Column) -> Column:
    """The domain one label below the public suffix; empty for an address or a bare label."""
    part = F.split(F.regexp_replace(F.lower(host), r"\.$", ""), r"\.")
    two = F.array_join(F.slice(part, -2, 2), ".")
    deep = two.isin(TWO_LABEL_SUFFIXES)
    named = F.when(deep & (F.size(part) >= 3), F.array_join(F.slice(part, F.greatest(F.size(part) - 2, F.lit(1)), F.lit(3)), ".")).when(~deep & (F.size(part) >= 2), two)
    return F.when(ipv4_number(host).isNotNull() | (F.size(part) < 2), "").otherwise(F.coalesce(named, F.lit("")))


def registrable_by(hosts: DataFrame, host: str, suffixes: DataFrame, suffix: str) -> DataFrame:
    """hosts with `registrable`: the domain one label below the public suffix by a list of them, a table with a rule a row.

    Rules are as in the public suffix list: a plain suffix, `*.` before one for any label below it, `!` before a name that
    such a rule doesn't hold for. An exception prevails, else the longest rule, else the last label is the suffix. Empty for
    addresses, bare suffixes and nulls. Each distinct host meets the rules by equality on its own label suffixes."""
    part = F.split(F.regexp_replace(F.lower(F.col("__host")), r"\.$", ""), r"\.")
    distinct = hosts.select(F.col(host).alias("__host")).where(F.col(host).isNotNull()).distinct().withColumn("__part", part)
    last = lambda n: F.array_join(F.slice("__part", -n, n), ".")
    ways = F.flatten(F.transform(F.sequence(F.lit(1), F.size("__part")), lambda n: F.array(F.struct(last(n).alias("rule"), n.alias("n"), F.lit(None).cast("int").alias("not")), F.struct(F.concat(F.lit("!"), last(n)).alias("rule"), F.lit(None).cast("int").alias("n"), (n - 1).alias("not")), F.struct(F.when(n > 1, F.concat(F.lit("*."), last(n - 1))).alias("rule"), n.alias("n"), F.lit(None).cast("int").alias("not")))))
    met = distinct.select("__host", F.explode(ways).alias("way")).select("__host", "way.*").join(suffixes.select(F.lower(F.col(suffix)).alias("rule")).distinct(), "rule")
    found = met.groupBy("__host").agg(F.coalesce(F.max("not"), F.max("n")).alias("__n"))
    known = distinct.join(found, "__host", "left").withColumn("__n", F.coalesce("__n", F.lit(1)))
    name = F.when(ipv4_number(F.col("__host")).isNull() & ~F.contains("__host", F.lit(":")) & (F.size("__part") > F.col("__n")), F.array_join(F.slice("__part", -(F.col("__n") + 1), F.col("__n") + 1), "."))
    return hosts.join(known.select("__host", name.alias("registrable")), hosts[host] == F.col("__host"), "left").drop("__host").withColumn("registrable", F.coalesce("registrable", F.lit("")))


def identifier(name: str) -> str:
    """A name that may be put into SQL as it stands; anything else is refused."""
    if not re.fullmatch(r"[A-Za-z_][A-Za-z0-9_]{0,127}", name):
        raise ValueError(f"{name!r} is no identifier")
    return name


def under(host: Column, root: Column) -> Column:
    return (host == root) | host.endswith(F.concat(F.lit("."), root))


@pandas_udf(T.StringType())
def idna(hosts: pd.Series) -> pd.Series:
    """Punycode form of a host; null where it has none."""
    def encode(host: str | None) -> str | None:
        try:
            return None if host is None else host.encode("idna").decode("ascii")
        except UnicodeError:
            return None

    return hosts.map(encode)


def canonical_url(raw: Column, ascii_only: bool = True) -> dict[str, Column]:
    """domain and url of a website as entered: https unless a scheme is given, the host in lower case (and in IDNA form,
    unless hosts are known to be ASCII), without a final dot or a fragment; domain also without www. Both are null where
    the text has white space, another scheme, a host that no name can have, or a port out of range."""
    raw = F.trim(F.coalesce(raw, F.lit("")))
    seed = F.when(raw.rlike(r"(?i)^[a-z][a-z0-9+.-]*://"), F.concat(F.lower(F.regexp_extract(raw, r"^([^:]*)", 1)), F.regexp_extract(raw, r"^[^:]*(.*)$", 1))).when(raw.startswith("//"), F.concat(F.lit("https:"), raw)).otherwise(F.concat(F.lit("https://"), raw))
    authority = F.regexp_extract(seed, r"^https?://([^/?#]*)", 1)
    host = F.lower(F.regexp_replace(F.regexp_extract(authority, r"^([^:@]+)(?::[0-9]+)?$", 1), r"\.$", ""))
    host = host if ascii_only else idna(host)
    port = F.regexp_extract(authority, r":([0-9]+)$", 1)
    good = (raw != "") & seed.rlike("^https?://") & ~raw.rlike(r"[\s\p{Cntrl}]") & (F.length(host) <= 253) & host.rlike(r"^[a-z0-9](?:[a-z0-9-]{0,61}[a-z0-9])?(?:\.[a-z0-9](?:[a-z0-9-]{0,61}[a-z0-9])?)+$") & ((port == "") | port.try_cast("int").between(1, 65535))
    rest = F.regexp_replace(F.regexp_extract(seed, r"^https?://[^/?#]*(.*)$", 1), "#.*$", "")
    scheme = F.regexp_extract(seed, r"^(https?)://", 1)
    url = F.concat(scheme, F.lit("://"), host, F.when(port == "", "").otherwise(F.concat(F.lit(":"), port)), rest)
    return {"domain": F.when(good, F.regexp_replace(host, r"^www\.", "")), "url": F.when(good, url)}
