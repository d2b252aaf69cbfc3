"""Queries on odd inputs against their SQL in the other engine."""

import datetime
import itertools
import random

import duckdb
import pytest

import __spark_entry__ as entry
from quern.operators import joins


@pytest.fixture
def both(spark, tmp_path):
    """Rows of a query and of its SQL over the tables given as (rows, schema)."""

    def run(name, **tables):
        c = duckdb.connect()
        for table, (rows, schema) in tables.items():
            spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{table}.parquet")
            c.execute(f"CREATE VIEW {table} AS SELECT * FROM '{tmp_path}/{table}.parquet/*.parquet'")
        df = entry.queries()[name](spark, str(tmp_path))
        other = c.execute(entry.oracle_sql()[name])
        names = [x[0] for x in other.description]
        return sorted(tuple(r) for r in df.select(names).collect()), sorted(other.fetchall())

    return run


def test_title_ends_in_a_cut_reference(both):
    titles = ["a&amp;b and&amp", "x &lt y&gt; &am", "&quot;q&quot", "&amp;lt; &amp;amp;", "a & b &#"]
    rows = [(k, f"https://a.org/?x={k}&amp=1", f'<html><head><meta charset="utf-8"><title> {t} </title></head></html>') for k, t in enumerate(titles)]
    got, want = both("d05_head_metadata", pages=(rows, "page_id bigint, url string, html string"))
    assert got == want and any("a&b and&amp" in r for r in got)


def test_names_one_edit_apart(both):
    """Every name of up to four letters of two, runs and swaps among them, some twice; two blocks and nulls."""
    names = ["".join(x) for n in range(5) for x in itertools.product("ab", repeat=n)] + ["abcd", "abdc", "bacd", "acd", "abccd", "abab", "baba", "abab", None]
    rows = [(k, x, 1 if k % 3 else 2, None if k % 11 == 5 else "M") for k, x in enumerate(names)] + [(99, "ab", None, "M"), (98, "ab", None, "M")]
    got, want = both("j21_block_fuzzy", customer=(rows, "c_custkey bigint, c_name string, c_nationkey int, c_mktsegment string"))
    assert got == want and len(got) > 50


def test_no_block_is_crossed(spark, tmp_path):
    """Names meet by what is left of them, not by their block, and what they are dealt into isn't broadcast."""
    spark.range(9).selectExpr("id as c_custkey", "md5(cast(id as string)) as c_name", "1 as c_nationkey", "'M' as c_mktsegment").write.parquet(f"{tmp_path}/customer.parquet")
    df = entry.queries()["j21_block_fuzzy"](spark, str(tmp_path))
    joined = [x for x in df._jdf.queryExecution().sparkPlan().toString().split("\n") if "Join" in x]
    assert df.collect() == [] and len(joined) == 3
    assert all("SortMergeJoin" in x and any(name in x for name in ("kept#", "x#", "y#")) for x in joined), joined


def test_pairs_apart(both):
    """Customers of several blocks, repeated rows and orders, and nulls, which equal nothing."""
    rng = random.Random(7)
    customers = [(rng.randrange(60), rng.choice([1, 2, None]), rng.choice(["M", "N", None])) for _ in range(150)]
    orders = [(rng.randrange(70), rng.choice(["1", "2", None]), rng.choice([None, *[datetime.datetime(2020, 1, d) for d in range(1, 25)]])) for _ in range(160)]
    got, want = both("d35_match_gap", customer=(customers, "c_custkey bigint, c_nationkey int, c_mktsegment string"), orders=(orders, "o_custkey bigint, o_orderpriority string, o_orderdate timestamp"))
    assert got == want and len(got) > 300


def test_pairs_apart_in_parts(spark):
    members, seen = spark.range(90).selectExpr("id % 2 as g", "id as i"), spark.range(300).selectExpr("id % 97 as s", "id * id % 90 as i")
    of = {}
    for r in seen.collect():
        of.setdefault(r.i, set()).add(r.s)
    got = sorted(tuple(r) for r in joins.pairs_apart(members, seen, ["g"], "i", ["s"], "i", part=7).collect())
    assert got == [(a, b) for a in range(90) for b in range(a + 2, 90, 2) if not of.get(a, set()) & of.get(b, set())]
