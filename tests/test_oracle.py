"""Every query with oracle SQL, all ledger queries among them, equals it on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as E
from check_oracle import rows_of
from tallybook.plans import registry
from tallybook.sources.fixtures import SOURCE_TABLES

SMALL = "/root/testdata/sf0.001"

QUERIES = E.queries()
SQL = E.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.sql("SET TimeZone='UTC'")
    for t in SOURCE_TABLES:
        con.sql(f"create view {t} as select * from read_parquet('{SMALL}/{t}.parquet')")
    return con


def test_every_ledger_query_has_oracle_sql():
    assert set(SQL) <= set(QUERIES)
    missing = sorted(set(registry.queries()) - set(SQL))
    assert not missing, f"queries without oracle SQL: {missing}"


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    s_cols, s_rows = df.columns, df.collect()
    rel = duck.sql(SQL[name])
    d_cols, d_rows = rel.columns, rel.fetchall()
    assert sorted(s_cols) == sorted(d_cols)
    assert rows_of(s_cols, s_rows) == rows_of(d_cols, d_rows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["month", "income", "expense", "net"]
    assert df.count() > 0
