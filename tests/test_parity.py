"""Every registered query against its DuckDB statement (sf0.001; the driver
repeats this at sf0.01)."""

import pytest

from conftest import SF_SMALL

import __spark_entry__ as entry
from lakemart.registry import QUERIES

ORACLES = entry.oracle_sql()
NAMES = sorted(ORACLES)


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(ORACLES) <= set(entry.queries())


@pytest.fixture(scope="module")
def con(duck):
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    from check_oracle import compare
    res = compare(spark, con, name, entry.queries()[name], ORACLES[name], SF_SMALL)
    assert res["cols"], res
    assert res["rows"] == res["oracle_rows"], res
    assert res["exact"], res


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert "rank_in_country" in df.columns and "avg_global_income" in df.columns
