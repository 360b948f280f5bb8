"""Driver contract, and a few exact queries against DuckDB at sf0.001."""

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF001


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["uid", "pos", "mid"]
    assert df.count() > 0


def test_oracle_keys_are_queries():
    assert set(E.oracle_sql()) <= set(E.queries())


#: the training-data queries have tests of their own, in tests/llm
EXACT = sorted(set(E.oracle_sql()) - set(E.LLM_QUERIES))


@pytest.mark.parametrize("name", EXACT)
def test_matches_duckdb(spark, name):
    con = duckdb.connect()
    for t in ("customer", "supplier", "part", "orders", "lineitem", "events"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    res = con.execute(E.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    expect = sorted(tuple(str(v) for v in r) for r in res.fetchall())
    got_df = E.queries()[name](spark, SF001).select(*cols)
    got = sorted(tuple(str(v) for v in r) for r in got_df.collect())
    assert got == expect
