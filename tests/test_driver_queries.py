"""Every registered query against its DuckDB SQL on the smallest driver tables."""

import pytest

import __spark_entry__ as entry
from tests.oracle_util import compare, duck

SF = "/root/testdata/sf0.001"
# The training-data queries are tested in tests/llm.
QUERIES = {k: f for k, f in entry.queries().items() if not (k.startswith("op") and k[2].isdigit()) and k != "pipeline"}
SQL = {k: s for k, s in entry.oracle_sql().items() if k in QUERIES}


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(QUERIES[name](spark, SF), con, SQL[name])
    assert ok, msg


def test_entry_runs_with_stable_schema(spark):
    df = entry.entry(spark)
    assert df.columns == ["nation", "region", "year", "month", "n_arrivals", "total_price"]
    assert df.count() > 0
