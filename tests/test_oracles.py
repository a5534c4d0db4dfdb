"""Every harness query against its DuckDB oracle (the driver's gate, locally)."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from deltarecon.harness.queries import QUERIES
from deltarecon.harness.compare import compare, duck

from .conftest import SF_SMALL

NAMES = sorted(QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(queries()) and set(QUERIES) <= set(oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    res = compare(spark, con, name, queries()[name], oracle_sql()[name], SF_SMALL)
    assert res["cols_match"], res
    assert res["spark_rows"] == res["oracle_rows"], res
    assert res["values_match"], res
    assert res["types_match"], res


def test_entry_smoke(spark):
    df = entry(spark)
    assert df.count() > 0
    assert "diff_side" in df.columns
