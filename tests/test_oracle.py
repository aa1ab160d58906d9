"""Every registered query against its DuckDB twin (sf0.001: small and fast).

The driver runs the same comparison at sf0.01; ``tools/oracle_check.py``
runs it locally at any scale factor.
"""

import pytest

from given_tables import SF_SMALL
from tools.oracle_check import compare, duck_con
from orderlake.registry import all_oracles, all_queries

QUERIES = all_queries()
ORACLES = all_oracles()


@pytest.fixture(scope="module")
def con():
    return duck_con(SF_SMALL)


def test_every_query_has_an_oracle():
    missing = sorted(set(QUERIES) - set(ORACLES))
    assert missing == []


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    res = compare(spark, name, QUERIES[name], ORACLES.get(name), SF_SMALL, con)
    assert res["status"] == "OK", res


def test_entry_runs(spark):
    from __spark_entry__ import entry
    df = entry(spark)
    assert df.count() >= 0
    assert "carrier" in df.columns
