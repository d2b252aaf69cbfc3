"""Joins beyond the plain equi-join, all as equi-joins, windows or prunings that Spark can distribute."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def any_left(left: DataFrame, right: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Left join with at most one match: the first right row of each key in the order given."""
    w = Window.partitionBy(*keys).orderBy(*order)
    one = right.withColumn("__rank", F.row_number().over(w)).where("__rank = 1").drop("__rank")
    return left.join(one, keys, "left")


def member_flag(left: DataFrame, right: DataFrame, keys: list[str], flag: str) -> DataFrame:
    """left with a boolean: whether the right side has the key tuple. Null keys are no members."""
    marks = right.select(*keys).distinct().withColumn("__in", F.lit(True))
    return left.join(marks, keys, "left").withColumn(flag, F.coalesce("__in", F.lit(False))).drop("__in")


def as_of(left: DataFrame, right: DataFrame, keys: list[str], left_time: str, right_time: str, values: list[str]) -> DataFrame:
    """For each left row, the values of the last right row of the same keys at or before its time; nulls if none.

    Both sides meet in one sort by key and time, right rows before left ones of the same time, and the last right row
    is carried forward: one shuffle, no pairs, whatever the number of right rows."""
    carried = F.struct(F.col(right_time).alias("__at"), *values)
    lefts = left.withColumns({"__time": F.col(left_time), "__side": F.lit(1), "__value": F.lit(None).cast(right.select(carried.alias("v")).schema["v"].dataType)})
    rights = right.select(*keys, F.col(right_time).alias("__time"), F.lit(0).alias("__side"), carried.alias("__value"))
    both = lefts.unionByName(rights, allowMissingColumns=True)
    w = Window.partitionBy(*keys).orderBy("__time", "__side").rowsBetween(Window.unboundedPreceding, 0)
    out = both.withColumn("__value", F.last("__value", ignorenulls=True).over(w)).where("__side = 1")
    return out.select(*left.columns, F.col("__value.__at").alias(right_time), *[F.col(f"__value.{v}").alias(v) for v in values])


def nearest_common_date(requests: DataFrame, facts: DataFrame, request_date: str, fact_date: str, member: str, required: int) -> DataFrame:
    """For each requested date, the nearest date on which `required` distinct members exist: the last one at or before,
    else the first one after. Only distinct dates meet, of which a calendar has a few thousand whatever the number of
    facts, in two sorts whose frames only grow."""
    complete = facts.groupBy(fact_date).agg(F.countDistinct(member).alias("__n")).where(F.col("__n") >= required).select(F.col(fact_date).alias("__date"))
    asked = requests.select(request_date).distinct()
    points = asked.select(F.col(request_date).alias("__at"), F.lit(None).cast("date").alias("__have"), F.lit(1).alias("__side")).unionByName(complete.select(F.col("__date").alias("__at"), F.col("__date").alias("__have"), F.lit(0).alias("__side")))
    so_far = lambda *order: F.last("__have", ignorenulls=True).over(Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    back, ahead = so_far("__at", "__side"), so_far(F.col("__at").desc(), "__side")
    return points.withColumn("rate_date", F.coalesce(back, ahead)).where("__side = 1").select(F.col("__at").alias(request_date), "rate_date")


def any_of_keys(left: DataFrame, right: DataFrame, pairs: list[tuple[Column, Column]], identity: list[str]) -> DataFrame:
    """Rows that agree on at least one of several keys: an equi-join for each key, joined rows kept once by identity."""
    joined = [left.join(right, (a == b) & a.isNotNull(), "inner") for a, b in pairs]
    return reduce(DataFrame.unionByName, joined).dropDuplicates(identity)


def within_ranges(points: DataFrame, ranges: DataFrame, point: str, low: str, high: str, width: int) -> DataFrame:
    """Points joined to the closed ranges that hold them. Ranges are spread over the buckets of `width` that they touch,
    so that the join is on a bucket number and compares only neighbours."""
    span = ranges.withColumn("__bucket", F.explode(F.sequence(F.floor(F.col(low) / width), F.floor(F.col(high) / width))))
    dealt = points.withColumn("__bucket", F.floor(F.col(point) / width))
    return dealt.join(span, "__bucket").where((F.col(point) >= F.col(low)) & (F.col(point) <= F.col(high))).drop("__bucket")


def longest_prefix(addresses: DataFrame, rules: DataFrame, address: str, network: str, bits: str, lengths: Iterable[int], all_matches: bool = False, tie: str | None = None) -> DataFrame:
    """Addresses (as 32-bit longs) joined to the rules whose network covers them; the longest only, unless all are asked
    for, which come with `nth` counted from the longest. Each address meets its own masked prefixes by equality."""
    masked = F.explode(F.array(*[F.struct(F.lit(n).alias(bits), F.col(address).bitwiseAND(F.lit((0xFFFFFFFF << (32 - n)) & 0xFFFFFFFF)).alias(network)) for n in lengths]))
    hits = addresses.withColumn("__p", masked).select(*addresses.columns, f"__p.{bits}", f"__p.{network}").join(rules, [bits, network])
    w = Window.partitionBy(*addresses.columns).orderBy(F.col(bits).desc(), *([tie] if tie else []))
    ranked = hits.withColumn("nth", F.row_number().over(w))
    return ranked if all_matches else ranked.where("nth = 1").drop("nth")


def reciprocal(edges: DataFrame, source: str, target: str) -> DataFrame:
    """Pairs linked both ways, the smaller end first, once each."""
    both = edges.where(F.col(source) != F.col(target)).select(F.least(source, target).alias("a"), F.greatest(source, target).alias("b"), (F.col(source) < F.col(target)).alias("up"))
    return both.groupBy("a", "b").agg(F.bool_or("up").alias("u"), F.bool_or(~F.col("up")).alias("d")).where("u and d").select("a", "b")


def neighbours(edges: DataFrame, seeds: DataFrame, source: str, target: str) -> DataFrame:
    """Nodes one hop from the seeds (one column, seed), with whether an edge leads in, out or both ways."""
    ends = lambda near, far, inbound: edges.select(F.col(near).alias("seed"), F.col(far).alias("node"), F.lit(inbound).alias("inbound"), F.lit(1 - inbound).alias("outbound")).join(seeds, "seed", "left_semi")
    found = ends(source, target, 0).unionByName(ends(target, source, 1)).groupBy("seed", "node").agg(F.max("inbound").alias("inbound"), F.max("outbound").alias("outbound"))
    return found.withColumn("reciprocal", F.col("inbound") * F.col("outbound"))


def pairs_within(df: DataFrame, group: str, item: str) -> DataFrame:
    """Unordered pairs of different items that share a group, once each, the smaller first. Meant for small groups."""
    x, y = df.select(group, F.col(item).alias("a")).distinct(), df.select(group, F.col(item).alias("b")).distinct()
    return x.join(y, group).where("a < b").select("a", "b").distinct()


def one_edit_apart(names: DataFrame, block: list[str], name: str) -> DataFrame:
    """The block's columns, x, y: pairs of different names of a block that one insertion, deletion, replacement or swap of
    neighbours turns into each other, once each, in either order. names has distinct rows without nulls.

    Each name is dealt whole and with one character left out, at every place. Two names meet only where what is left is
    equal, whatever the size of their block: replaced at one place, swapped at two neighbouring ones with the same
    character left out, or one of them whole. The place tells these cases apart, so that no pair comes twice."""
    cut = names.select(*block, F.col(name).alias("name"), F.explode(F.sequence(F.lit(0), F.length(name))).alias("at"))
    kept = F.when(F.col("at") == 0, F.col("name")).otherwise(F.concat(F.expr("left(name, at - 1)"), F.expr("substring(name, at + 1)")))
    cut = cut.select(*block, kept.alias("kept"), "at", "name")
    x, y = (cut.select(*block, "kept", F.col("at").alias(f"at_{s}"), F.col("name").alias(s)) for s in "xy")
    met = x.join(y.hint("merge"), [*block, "kept"])  # a name's places make it many times larger than its file
    replaced = F.expr("at_x > 0 and at_x = at_y and x < y")
    swapped = F.expr("at_x > 0 and at_y = at_x + 1 and x < y and substring(x, at_x, 1) = substring(y, at_y, 1)")
    longer = F.expr("at_x = 0 and at_y > 0 and (at_y = 1 or substring(y, at_y, 1) <> substring(y, at_y - 1, 1))")
    return met.where(replaced | swapped | longer).select(*block, "x", "y")


def pairs_apart(members: DataFrame, seen: DataFrame, group: list[str], item: str, seen_group: list[str], seen_item: str, part: int = 1000) -> DataFrame:
    """a, b: unordered pairs of different items that share a group of members and none of seen, once each, the smaller first.
    A null in a group's columns equals nothing.

    No pair that is returned is ever dealt out or kept: a group's items are cut into parts of about `part`, and an item
    meets each part beside the list of those in it that it was seen with. Only pairs seen are shuffled, and of these only
    the ones that share a group of members. A pair with several groups is returned by the least."""
    rows = members.dropna(subset=[*group, item]).select(F.struct(*group).alias("g"), F.col(item).alias("i")).distinct()
    several = rows.groupBy("i").agg(F.collect_set("g").alias("gs")).select("i", F.when(F.size("gs") > 1, F.col("gs")).alias("gs"))
    sizes = rows.groupBy("g").agg(F.ceil(F.count("*") / part).cast("int").alias("parts"))
    rows = rows.join(several, "i").join(sizes, "g").withColumn("part", F.pmod(F.xxhash64("i"), F.col("parts")).cast("int"))
    met = seen.dropna(subset=[*seen_group, seen_item]).select(F.struct(*seen_group).alias("s"), F.col(seen_item).alias("i")).distinct()
    met = met.join(rows.select("i", "g", "part").hint("merge"), "i")
    known = met.select("g", "s", F.col("i").alias("a")).join(met.select("g", "s", F.col("i").alias("b"), "part").hint("merge"), ["g", "s"]).where("a < b")
    known = known.groupBy("g", "a", "part").agg(F.collect_set("b").alias("known"))
    lefts = rows.select("g", F.col("i").alias("a"), F.col("gs").alias("gs_a"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    lefts = lefts.join(known.hint("merge"), ["g", "a", "part"], "left")
    rights = rows.select("g", F.col("i").alias("b"), F.col("gs").alias("gs_b"), "part")
    least = F.expr("gs_a is null or gs_b is null or g = array_min(array_intersect(gs_a, gs_b))")
    return lefts.join(rights.hint("merge"), ["g", "part"]).where(F.expr("a < b and (known is null or not array_contains(known, b))") & least).select("a", "b")
