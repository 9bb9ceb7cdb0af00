"""Every registered query against its DuckDB SQL on the smallest test tables."""

import os

import pytest

from oracle_check import compare, duck

SF = os.environ.get("ROSBAND_TEST_SF", "/root/testdata/sf0.001")


def _names():
    from __spark_entry__ import oracle_sql, queries

    q, o = queries(), oracle_sql()
    assert set(o) <= set(q)
    return sorted(o)


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
@pytest.mark.parametrize("name", _names())
def test_query_matches_oracle(spark, con, name):
    from __spark_entry__ import oracle_sql, queries

    r = compare(spark, con, name, queries()[name], oracle_sql()[name], SF)
    assert "error" not in r, r["error"]
    assert r["spark_rows"] == r["oracle_rows"]


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not present")
def test_entry_runs(spark):
    from __spark_entry__ import entry

    df = entry(spark)
    assert df.count() > 0
    assert "avg_price" in df.columns
