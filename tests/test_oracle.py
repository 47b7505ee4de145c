"""Every registered query against its DuckDB oracle at sf0.001."""

import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from oracle_check import compare, duck_connect
from playmart.plans import registry

NAMES = sorted(registry.ORACLE)


@pytest.fixture(scope="module")
def con():
    return duck_connect(SF_SMALL)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    problems, _, _ = compare(spark, con, name, entry.queries()[name], entry.oracle_sql()[name], SF_SMALL)
    assert not problems, problems


def test_every_query_has_an_oracle():
    assert set(registry.QUERIES) == set(registry.ORACLE)
    assert set(registry.QUERIES) <= set(entry.queries())


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "user_diff" in df.columns
