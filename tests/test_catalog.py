"""Every query with SQL against an independent engine, over the smallest tables."""

import glob
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    c.sql("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        c.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return c


def plain(v):
    if isinstance(v, bool) or v is None:
        return v
    if hasattr(v, "isoformat"):
        return v.replace(tzinfo=None).isoformat() if hasattr(v, "hour") else v.isoformat()
    try:
        x = float(v) if not isinstance(v, str) else None
    except (TypeError, ValueError):
        x = None
    return v if x is None else "nan" if math.isnan(x) else float(f"{x:.9g}")


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    key = lambda r: tuple((x is not None, str(x)) for x in r)
    return sorted(columns), sorted((tuple(plain(r[k]) for k in order) for r in rows), key=key)


@pytest.mark.parametrize("name", sorted(n for n in entry.oracle_sql() if not n.startswith("op")))
def test_same_rows_as_the_other_engine(spark, duck, name):
    df = entry.queries()[name](spark, FOLDER)
    got = table(df.columns, df.collect())
    other = duck.execute(entry.oracle_sql()[name])
    assert got == table([c[0] for c in other.description], other.fetchall())


@pytest.mark.parametrize("name", sorted(n for n in set(entry.queries()) - set(entry.oracle_sql()) if not n.startswith("op") and n != "pipeline"))
def test_other_queries_give_rows(spark, name):
    assert entry.queries()[name](spark, FOLDER).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 1000
