"""Every registered query against its DuckDB twin (the driver's gate), at sf0.001."""

import pytest

from engram.plans.registry import all_queries, all_sql
from tools.oracle_check import compare, duck

SF = "/root/testdata/sf0.001"
KEYS = sorted(all_queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    r = compare(spark, con, key, all_queries()[key], all_sql().get(key), SF)
    assert r["status"] in ("ok", "rows-only"), r


def test_entry_smoke(spark):
    import __spark_entry__ as e

    df = e.entry(spark)
    assert df.columns == ["uuid", "fact", "valid_from", "invalidated"]
    assert df.count() >= 0
    assert set(e.oracle_sql()) <= set(e.queries())
