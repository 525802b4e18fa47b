"""Every registered query against its DuckDB oracle at sf0.01 (the driver's
correctness gate), and the smoke entry at sf0.001."""

import pytest
from conftest import SF01

import __spark_entry__ as entry_mod
from rivulet.plans import catalog
from oracle import compare, duck

# The training-data operators have tests of their own, in tests/llm.
NAMES = sorted(catalog.QUERIES)


@pytest.fixture(scope="module")
def con():
    return duck(SF01)


def test_every_query_has_an_oracle():
    assert set(catalog.ORACLE_SQL) == set(catalog.QUERIES)
    assert set(catalog.QUERIES) <= set(entry_mod.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = entry_mod.queries()[name](spark, SF01)
    r = compare(df, con, entry_mod.oracle_sql()[name])
    assert r["ok"], r


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    assert df.columns == ["event_time", "data", "enrichment", "key", "partition"]
    assert df.count() == 1000
