"""Every registered query against its DuckDB statement on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from playpulse import registry
from tools.check_oracle import duck_rows, ordered_maps, rows_of

SF = "/root/testdata/sf0.001"
TABLES = ["events"]

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_entry(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert "dau" in df.columns and "revenue_usd" in df.columns


def test_every_query_has_an_oracle():
    assert set(registry.SPARK) == set(registry.SQL)
    assert set(registry.SPARK) <= set(E.queries()) and set(registry.SQL) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(registry.SPARK))
def test_query_matches_duckdb(spark, con, name):
    df = registry.SPARK[name](spark, SF)
    cols, got = df.columns, [tuple(r) for r in ordered_maps(df).collect()]
    cur = con.execute(registry.SQL[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(cols) == sorted(dcols)
    assert rows_of(cols, got) == rows_of(dcols, duck_rows(cur))


def test_maps_are_compared_in_order(spark, con):
    """The comparison itself: the same entries in another order are a difference."""
    cur = con.execute("SELECT MAP {'b': 1, 'a': 2} AS m")
    want = rows_of(["m"], duck_rows(cur))
    for sql, same in (("map('b', 1, 'a', 2)", True), ("map('a', 2, 'b', 1)", False)):
        got = [tuple(r) for r in ordered_maps(spark.sql(f"SELECT {sql} AS m")).collect()]
        assert (rows_of(["m"], got) == want) == same
