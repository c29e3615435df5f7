"""Every registered query with SQL gives the same rows as the SQL."""

import pytest
from compare import compare

import __spark_entry__ as entry


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_sql(spark, sf, con, name):
    verdict, _ = compare(spark, sf, name, con)
    assert verdict.startswith("ok "), verdict


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.oracle_sql())))
def test_query_without_sql_returns_rows(spark, sf, name):
    assert entry.queries()[name](spark, sf).count() > 0


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert len(rows) == 4 and all(r["tokens"] >= r["texts"] for r in rows)
