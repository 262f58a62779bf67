"""Every catalogue query against its DuckDB oracle on the driver tables
(sf0.001 here for speed; ``python tests/oracle.py`` runs sf0.01)."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries

from .oracle import compare, duck
from .conftest import SF001


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


@pytest.mark.parametrize("name", sorted(queries()))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, name, SF001, con)
    if name in oracle_sql():
        assert r["cols_match"] and r["values_match"], r


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.count() > 0
    assert set(df.columns) >= {"conv_id", "text", "split"}
