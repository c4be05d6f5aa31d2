"""The registered queries against their SQL on the smallest tables, one of each
family; tools/check.py runs all of them."""

import os

import pytest

import __spark_entry__ as entry

DATA = "/root/testdata/sf0.001"
SAMPLE = ["vendor_summary", "merge_clauses", "keep_latest_per_key", "lag_metrics", "effective_grants", "metrics_of_two_tables", "answer_scores"]


def test_every_sql_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.skipif(not os.path.isdir(DATA), reason="test tables are not here")
@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_sql(spark, name):
    import duckdb

    from tools.check import TABLES, compare

    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
    problem, count = compare(entry.queries()[name](spark, DATA), entry.oracle_sql()[name], con)
    assert problem is None and count > 0


@pytest.mark.skipif(not os.path.isdir(DATA), reason="test tables are not here")
def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0
