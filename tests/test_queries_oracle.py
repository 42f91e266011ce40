"""Every registered query against its DuckDB oracle on the driver's sf0.001 tables
(the driver itself gates at sf0.01; ``python tests/oracle_compare.py`` runs that)."""

from __future__ import annotations

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from oracle_compare import compare, duck_connection

QUERIES = E.core_queries()
ORACLE = E.oracle_sql()


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(ORACLE)


@pytest.fixture(scope="module")
def con():
    return duck_connection(SF_SMALL)


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, con, key):
    res = compare(spark, con, key, QUERIES[key], ORACLE[key], SF_SMALL)
    assert res["status"] == "ok", res


def test_entry_flagship(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["channel", "attribution_method", "attributed_conversions",
                          "attributed_revenue"]
    assert len(rows) == 6 and {r.attribution_method for r in rows} == {"time_decay"}
