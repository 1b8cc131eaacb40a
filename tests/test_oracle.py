"""Every SQL-checkable query against its DuckDB oracle on the sf0.001 tables
(the driver runs the same comparison at sf0.01)."""

import pytest

import __spark_entry__ as entry
from creditspark.plans import catalog
from tests.oracle_harness import compare, duck

SF = "/root/testdata/sf0.001"
catalog.load_all()
ORACLES, QUERIES = catalog.ORACLES, catalog.QUERIES


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_matches_oracle(spark, con, key):
    res = compare(QUERIES[key](spark, SF), con, ORACLES[key])
    assert res["cols_match"], res
    assert not res["type_diffs"], res
    assert res["rows_match"], res
    assert res["hash_match"], res


def test_every_key_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
    assert len(QUERIES) >= 99
    assert set(QUERIES) <= set(entry.queries())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) == 10
    assert [r["rank"] for r in sorted(rows, key=lambda r: r["rank"])] == list(range(1, 11))
