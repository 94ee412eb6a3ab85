"""Every registered query equals its DuckDB oracle (order-insensitive, exact values)."""

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from oracle_compare import compare
from tarmac.plans import QUERIES, SQL

NAMES = sorted(QUERIES)  # the optional queries have tests of their own


def test_every_query_has_an_oracle():
    assert set(SQL) == set(QUERIES)
    assert set(QUERIES) <= set(E.queries()) and set(SQL) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, name):
    r = compare(spark, name, QUERIES[name], SQL[name], SF_SMALL)
    assert r["cols_match"], r
    assert r["spark_rows"] == r["oracle_rows"], r
    assert r["values_match"], r


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["airport", "num_flights"]
    assert len(rows) > 0
    counts = [r["num_flights"] for r in rows]
    assert counts == sorted(counts, reverse=True)
